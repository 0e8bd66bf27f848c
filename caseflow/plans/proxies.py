"""Court-shaped views over the benchmark tables.

Every view is row-local or one equi-join: documents, XML bodies, trees and
sentences are built from the columns of a single row, so their number grows with
the tables and no group is ever collected into one value.  The SQL fragments
below define the same views for the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import timestamps as ts

SPEC = (1, 3, 5, 8)  # "specialised courts": four nations


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Orders whose documents one task makes or parses.
DEALT = 20_000


def dealt(spark: SparkSession, orders: DataFrame, by: str) -> DataFrame:
    """orders, dealt by a column to tasks of ``DEALT`` rows, however few row groups hold them."""
    tasks = max(spark.sparkContext.defaultParallelism, orders.count() // DEALT + 1)
    return orders.repartition(tasks, by)


def orders_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders, dealt to as many tasks as their number or the session setting ``caseflow.read.tasks`` asks for.

    Parsing a document costs far more than moving its row, and a table may keep all its rows in one row group.
    """
    orders = table(spark, sf_dir, "orders")
    tasks = spark.conf.get("caseflow.read.tasks", None)
    return dealt(spark, orders, "o_orderkey") if tasks is None else orders.repartition(int(tasks), "o_orderkey")


def case_number(key: Column | str) -> Column:
    return F.lpad(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), 20, "0")


def counter(n: Column) -> Column:
    """[1..n], empty for n = 0 (``sequence`` would count down)."""
    return F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---- cases and movements -----------------------------------------------------------------

CASES_SQL = """cases AS (
  SELECT 'T1_' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS id,
         lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS processo,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS classe_codigo,
         o_orderpriority AS classe_nome,
         o_orderdate AS data_ajuizamento,
         CAST(year(o_orderdate) AS BIGINT) AS ano_ajuizamento,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_ajuizamento,
         CAST(nullif(n_nationkey, 7) AS BIGINT) AS orgao_julgador_codigo,
         n_name AS orgao_julgador_nome,
         CAST(n_regionkey AS BIGINT) AS orgao_julgador_municipio_ibge,
         r_name AS municipio_nome,
         c_mktsegment AS tribunal,
         o_orderstatus AS grau
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

MOVES_L_SQL = """moves_l AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 20, '0') AS processo,
         l_returnflag || l_linestatus AS movimento_codigo,
         l_shipdate AS movimento_data_hora
  FROM lineitem)"""

MOVES_E_SQL = """moves_e AS (
  SELECT CAST(user_id AS VARCHAR) AS processo, event_type AS movimento_codigo,
         ts AS movimento_data_hora, event_id, value
  FROM events)"""


def cases(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """orders with customer, nation and region; court 7 has no code.

    In a stored case table a filter on the filing month reaches the scan.  Here
    the month is computed, so ``since`` (a month start) is put on the raw column.
    """
    orders = table(spark, sf_dir, "orders")
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    courts = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    owners = table(spark, sf_dir, "customer").join(courts, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"))
    number = case_number("o_orderkey")
    filed = F.col("o_orderdate").cast("timestamp")
    return joined.select(
        F.concat(F.lit("T1_"), number).alias("id"),
        number.alias("processo"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("classe_codigo"),
        F.col("o_orderpriority").alias("classe_nome"),
        filed.alias("data_ajuizamento"),
        F.year(filed).cast("bigint").alias("ano_ajuizamento"),
        ts.month_start(filed).alias("mes_ajuizamento"),
        F.nullif(F.col("n_nationkey"), F.lit(7)).cast("bigint").alias("orgao_julgador_codigo"),
        F.col("n_name").alias("orgao_julgador_nome"),
        F.col("n_regionkey").cast("bigint").alias("orgao_julgador_municipio_ibge"),
        F.col("r_name").alias("municipio_nome"),
        F.col("c_mktsegment").alias("tribunal"),
        F.col("o_orderstatus").alias("grau"),
    )


def moves_l(spark: SparkSession, sf_dir: str, code: str | None = None) -> DataFrame:
    """lineitem rows as movements: return flag and status make the code.

    ``code`` puts the code test on the two raw columns, where the scan can use it.
    """
    lines = table(spark, sf_dir, "lineitem")
    if code:
        lines = lines.filter((F.col("l_returnflag") == code[0]) & (F.col("l_linestatus") == code[1]))
    return lines.select(
        case_number("l_orderkey").alias("processo"),
        F.concat("l_returnflag", "l_linestatus").alias("movimento_codigo"),
        F.col("l_shipdate").cast("timestamp").alias("movimento_data_hora"),
    )


def moves_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as movements of their user; ties are broken by event_id."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("processo"),
        F.col("event_type").alias("movimento_codigo"),
        F.col("ts").cast("timestamp").alias("movimento_data_hora"),
        "event_id", "value",
    )



# ---- raw case documents (orders) -----------------------------------------------------------

CASE_NUMBER_SQL = "lpad(CAST(o_orderkey AS VARCHAR), 20, '0')"

# times printed in eight ways, with blanks, junk and an impossible month among them
TIME_TEXT_SQL = """time_texts AS (
  SELECT o_orderkey, moment, CASE o_orderkey % 8
    WHEN 0 THEN strftime(moment, '%Y-%m-%dT%H:%M:%S') || '.000Z'
    WHEN 1 THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 2 THEN strftime(moment, '%Y%m%d%H%M%S')
    WHEN 3 THEN CASE WHEN o_custkey % 2 = 0 THEN ' ' || strftime(o_orderdate, '%Y%m%d%H%M%S') || ' '
                     ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S') END
    WHEN 4 THEN strftime(moment, '%Y%m%d%H%M')
    WHEN 5 THEN CASE WHEN o_custkey % 2 = 0 THEN strftime(moment, '%Y%m%d')
                     ELSE strftime(moment, '%Y') || '13' || strftime(moment, '%d%H%M%S') END
    WHEN 6 THEN CASE o_custkey % 3 WHEN 0 THEN 'abc' WHEN 1 THEN '' ELSE NULL END
    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS texto
  FROM (SELECT *, o_orderdate + to_seconds((o_custkey * 977) % 86400) AS moment FROM orders))"""


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    filed = F.col("o_orderdate").cast("timestamp")
    seconds = (F.col("o_custkey") * 977) % 86400
    moment = F.timestamp_micros(F.unix_micros(filed) + seconds * 1_000_000)
    kind, half = F.col("o_orderkey") % 8, F.col("o_custkey") % 2 == 0

    def show(c: Column, pattern: str) -> Column:
        return F.date_format(c, pattern)

    iso, digits = "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMddHHmmss"
    third = F.col("o_custkey") % 3
    text = (
        F.when(kind == 0, F.concat(show(moment, iso), F.lit(".000Z")))
        .when(kind == 1, F.concat(show(moment, iso), F.lit("Z")))
        .when(kind == 2, show(moment, digits))
        .when(kind == 3, F.when(half, F.concat(F.lit(" "), show(filed, digits), F.lit(" ")))
              .otherwise(show(moment, iso)))
        .when(kind == 4, show(moment, "yyyyMMddHHmm"))
        .when(kind == 5, F.when(half, show(moment, "yyyyMMdd"))
              .otherwise(F.concat(show(moment, "yyyy"), F.lit("13"), show(moment, "ddHHmmss"))))
        .when(kind == 6, F.when(third == 0, "abc").when(third == 1, "").otherwise(F.lit(None)))
        .otherwise(F.concat(show(filed, iso), F.lit("Z")))
    )
    return orders_spread(spark, sf_dir).select("o_orderkey", moment.alias("moment"), text.alias("texto"))


def case_documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order: 0-2 subjects, 0-3 movements, 0-2 complements each."""
    number = case_number("o_orderkey")
    filed = F.col("o_orderdate").cast("timestamp")
    key, owner = F.col("o_orderkey"), F.col("o_custkey")

    def text(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    def complement(j: Column, c: Column) -> Column:
        return F.struct(
            (c * 10).cast("bigint").alias("codigo"), text('tipo "', c, '"').alias("nome"),
            F.when((key + j + c) % 2 == 0, text(j * c)).otherwise("{}").alias("valor"),
            text("valor_", c).alias("descricao"))

    def movement(j: Column) -> Column:
        when = F.timestamp_micros(F.unix_micros(filed) + j.cast("bigint") * 90_061_000_000)
        n = (key + j) % 3
        return F.struct(
            F.when((key + j) % 11 == 0, "{}").otherwise(text(j + 100)).alias("codigo"),
            text('Mov "', j, '"').alias("nome"),
            F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")).alias("dataHora"),
            F.transform(counter(n), lambda c: complement(j, c)).alias("complementosTabelados"))

    document = F.struct(
        F.concat(F.lit("T1_"), number).alias("id"),
        number.alias("numeroProcesso"),
        F.struct(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("codigo"),
                 F.col("o_orderpriority").alias("nome")).alias("classe"),
        F.date_format(filed, "yyyyMMddHHmmss").alias("dataAjuizamento"),
        F.struct((owner % 25).alias("codigo"), text("Vara ", owner % 25).alias("nome"),
                 (owner % 5).alias("codigoMunicipioIBGE")).alias("orgaoJulgador"),
        F.lit("T1").alias("tribunal"),
        F.when(key % 2 == 0, "G1").otherwise("G2").alias("grau"),
        F.date_format(filed, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp"),
        F.transform(counter(owner % 3), lambda j: F.struct(
            (j * 1000 + owner % 100).alias("codigo"), text('Assunto "', j, '"').alias("nome"))).alias("assuntos"),
        F.transform(counter(key % 4), movement).alias("movimentos"),
    )
    return orders_spread(spark, sf_dir).select(
        "o_orderkey", F.to_json(document, {"ignoreNullFields": "false"}).alias("texto"))


# ---- trees, sentences and service documents (orders) ----------------------------------------

def _tree_text() -> Column:
    """[root -> 0-2 children -> 0-2 each -> sometimes one more], as JSON text."""
    key = F.col("o_orderkey")

    def node(number: Column, seq: Column, level: Column, children: Column) -> Column:
        return F.concat(
            F.lit('{"numeroUnico":"'), case_number(number), F.lit('","sequencial":'), seq.cast("string"),
            F.lit(',"instancia":"'), level, F.lit('","processos":['), children, F.lit("]}"))

    def grandchild(c: Column, g: Column) -> Column:
        number = key + c * 7 + g * 100
        tail = F.when((key + c + g) % 4 == 0, node(number + 1000, F.lit(1), F.lit("3"), F.lit(""))).otherwise("")
        return node(number, g, F.lit("2"), tail)

    def child(c: Column) -> Column:
        return node(key + c * 7, c, F.lit("2"),
                    F.array_join(F.transform(counter((key + c) % 3), lambda g: grandchild(c, g)), ","))

    children = F.array_join(F.transform(counter(F.col("o_custkey") % 3), child), ",")
    return F.concat(F.lit("["), node(key, F.lit(0), F.lit("1"), children), F.lit("]"))


def trees_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree text per order; every 13th order has none, as some real cases."""
    return orders_spread(spark, sf_dir).select(
        case_number("o_orderkey").alias("numero_processo"),
        F.when(F.col("o_orderkey") % 13 != 0, _tree_text()).alias("arvore"))


TREES_SQL = """
  planted AS (SELECT * FROM orders WHERE o_orderkey % 13 <> 0),
  c1 AS (SELECT o_orderkey, c, o_orderkey + 7 * c AS num
         FROM planted, unnest(generate_series(1, o_custkey % 3)) AS t(c)),
  c2 AS (SELECT o_orderkey, c, g, num AS pai, num + 100 * g AS num
         FROM c1, unnest(generate_series(1, (o_orderkey + c) % 3)) AS t(g)),
  c3 AS (SELECT o_orderkey, num AS pai, num + 1000 AS num FROM c2 WHERE (o_orderkey + c + g) % 4 = 0),
  raw_nodes AS (
    SELECT o_orderkey AS raiz, o_orderkey AS num, NULL AS pai, 0 AS profundidade, 1 AS ordem,
           '1' AS instancia, 0 AS sequencial, o_custkey % 3 = 0 AS eh_folha FROM planted
    UNION ALL
    SELECT o_orderkey, num, o_orderkey, 1, c, '2', c, (o_orderkey + c) % 3 = 0 FROM c1
    UNION ALL
    SELECT o_orderkey, num, pai, 2, g, '2', g, (o_orderkey + c + g) % 4 <> 0 FROM c2
    UNION ALL
    SELECT o_orderkey, num, pai, 3, 1, '3', 1, TRUE FROM c3),
  nodes AS (
    SELECT lpad(CAST(raiz AS VARCHAR), 20, '0') AS processo_raiz,
           lpad(CAST(num AS VARCHAR), 20, '0') AS numero_processo,
           lpad(CAST(pai AS VARCHAR), 20, '0') AS numero_pai,
           CAST(profundidade AS BIGINT) AS profundidade, CAST(ordem AS BIGINT) AS ordem_entre_irmaos,
           instancia, CASE WHEN instancia = '1' THEN 'G1' ELSE 'G2' END AS grau,
           CAST(sequencial AS BIGINT) AS sequencial, pai IS NULL AS eh_raiz, eh_folha
    FROM raw_nodes)"""


# sentence templates: {p} person, {e} company
_TEMPLATES = (
    "HABILITAÇÃO DE PARTE EM PROCESSO - Parte: ADMINISTRADOR JUDICIAL ({p}) (Terceiro)",
    "HABILITAÇÃO DE PARTE EM PROCESSO - Parte: (ADMINISTRADOR JUDICIAL) {p} (Terceiro)",
    "DESABILITAÇÃO DE PARTE EM PROCESSO - Parte: {p} (SÍNDICO DO(A) {e}) (Terceiro)",
    "DESHABILITAÇÃO DE PARTE EM PROCESSO - Parte: {p} (Administrador Judicial) (Réu)",
    "HABILITAÇÃO DE PARTE EM PROCESSO - Parte: MASSA FALIDA DE {e} (Promovido)",
    "Para advogados/curador/defensor de {e} com prazo de 5 dias",
    "P/ advgs. de {p} (SÍNDICO DO(A) {e}) com prazo de 10 dias",
    "HABILITAÇÃO DE PARTE EM PROCESSO - Parte: {p} (Outro)",
    "Pelo advogado/curador/defensor de MASSA FALIDA - {e} em 12/03/2020",
    "Juntada de petição de {e}",
    "habilitação de parte em processo - Parte:  {e} (Exequente) ",
)
_COMPANIES = ("Acme{k} & Cia Ltda.", "Beta{k} S/A", "Gama, Delta{k}  Ltda.", "Omega{k} & Cia. S.A.")


def _fill(template: str, person: Column, company: Column) -> Column:
    pieces: list[Column] = []
    rest = template
    while rest:
        cut = min((i for i in (rest.find("{p}"), rest.find("{e}"), len(rest)) if i >= 0))
        if cut:
            pieces.append(F.lit(rest[:cut]))
        if cut < len(rest):
            pieces.append(person if rest[cut + 1] == "p" else company)
        rest = rest[cut + 3:]
    return F.concat(*pieces)


def company_name() -> Column:
    key = F.col("o_custkey").cast("string")
    company = F.lit(None).cast("string")
    for i, name in enumerate(_COMPANIES):
        head, tail = name.split("{k}")
        company = F.when(F.col("o_custkey") % len(_COMPANIES) == i,
                         F.concat(F.lit(head), key, F.lit(tail))).otherwise(company)
    return company


def _sentence() -> Column:
    person = F.concat(F.lit("Ana Lima "), F.col("o_custkey").cast("string"))
    company = company_name()
    text = F.lit(None).cast("string")
    for i, template in enumerate(_TEMPLATES):
        text = F.when(F.col("o_orderkey") % (len(_TEMPLATES) + 1) == i,
                      _fill(template, person, company)).otherwise(text)
    return text


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movement per order whose detail text follows one of the templates, or is NULL.

    Exploding a one-element list makes the text a plain input column, as in a
    stored table; otherwise the optimizer rebuilds it inside every pattern test.
    """
    key = F.col("o_orderkey")
    stored = orders_spread(spark, sf_dir).select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus",
        F.explode(F.array(_sentence())).alias("_sentence"))
    return stored.select(
        case_number("o_orderkey").alias("numero_processo"),
        F.substring("o_orderpriority", 1, 1).alias("classe_processual"),
        key.cast("string").alias("movimento_sequencia"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "dd/MM/yyyy HH:mm:ss").alias("movimento_data_hora"),
        (key % 100).cast("string").alias("movimento_codigo"),
        F.lit("Mov").alias("movimento_nome"),
        F.col("_sentence").alias("complemento_projudi_descricao"),
        F.lower("o_orderstatus").alias("complemento_projudi_movimentado_por_nome"),
        F.lit("juiz").alias("complemento_projudi_movimentado_por_cargo"),
    )


def _sql_sentence() -> str:
    company = "CASE o_custkey % 4 " + " ".join(
        "WHEN {} THEN '{}' || CAST(o_custkey AS VARCHAR) || '{}'".format(i, *name.split("{k}"))
        for i, name in enumerate(_COMPANIES)) + " END"
    person = "'Ana Lima ' || CAST(o_custkey AS VARCHAR)"
    filled = [
        "'" + t.replace("{p}", "' || pessoa || '").replace("{e}", "' || empresa || '") + "'"
        for t in _TEMPLATES]
    cases_ = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(filled))
    return f"""sentences AS (
  SELECT *, CASE o_orderkey % {len(_TEMPLATES) + 1} {cases_} END AS texto
  FROM (SELECT *, {person} AS pessoa, {company} AS empresa FROM orders))"""


SENTENCES_SQL = _sql_sentence()


def organised_documents_text(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One organised service document per order: 0-3 movements with 0-4 complements.

    ``orders``: those rows dealt otherwise; their other columns are kept.
    """
    extra = [] if orders is None else [c for c in orders.columns if not c.startswith("o_")]
    number = case_number("o_orderkey")
    filed = F.col("o_orderdate").cast("timestamp")
    key, owner = F.col("o_orderkey"), F.col("o_custkey")

    def movement(j: Column) -> Column:
        when = F.timestamp_micros(F.unix_micros(filed) + j.cast("bigint") * 90_061_000_000)
        n = (key + j) % 5
        last = (
            F.when(owner % 3 == 0, F.concat(F.lit("Movimentada Por: Ana "), owner.cast("string"), F.lit(" - Juiz")))
            .when(owner % 3 == 1, F.lit("Por: SISTEMA")).otherwise("sem autor"))
        items = F.transform(counter(n), lambda i: F.when((i == n) & (n > 1), last).otherwise(
            F.concat(F.lit("item "), i.cast("string"))))
        return F.struct(
            F.struct(j.cast("string").alias("identificadorMovimento"),
                     F.date_format(when, "yyyyMMddHHmmss").alias("dataHora"),
                     F.lit("108").alias("classeProcessual")).alias("atributos"),
            F.date_format(when, "dd/MM/yyyy HH:mm:ss").alias("dataHoraFormatada"),
            items.alias("complementos"),
            F.struct(F.struct((j + 50).cast("string").alias("codigoNacional")).alias("atributos"),
                     F.array(F.concat(F.lit("Nac "), j.cast("string"))).alias("complementos"))
            .alias("movimentoNacional"))

    price = F.col("o_totalprice").cast("string")
    blank_code = F.when(owner % 4 == 0, " ").otherwise((owner % 50).cast("string"))
    document = F.struct(
        F.struct(number.alias("numero_processo"), F.date_format(filed, "yyyyMMdd_HHmmss").alias("data_consulta"),
                 F.date_format(filed, "dd/MM/yyyy HH:mm:ss").alias("data_formatada"),
                 F.concat(number, F.lit("_raw.json")).alias("arquivo_origem")).alias("metadados"),
        F.struct(F.lit(True).alias("sucesso"), F.lit("ok").alias("mensagem")).alias("resposta"),
        F.struct(
            number.alias("numero_processo"),
            F.substring("o_orderpriority", 1, 1).alias("classe_processual"),
            F.date_format(filed, "dd/MM/yyyy HH:mm:ss").alias("data_ajuizamento"),
            F.when(key % 5 == 0, "R$ 10").when(key % 7 == 0, F.lit(None)).otherwise(price).alias("valor_causa"),
            F.concat(F.lit("Vara "), (owner % 25).cast("string")).alias("orgao_julgador"),
            F.col("o_orderstatus").alias("situacao"),
            F.when(owner % 2 == 0, "").otherwise("ativo").alias("status"),
            F.when(key % 9 == 0, "muitos").otherwise((key % 4).cast("string")).alias("total_movimentos"),
            F.struct(F.when(key % 4 > 0, F.date_format(filed, "dd/MM/yyyy HH:mm:ss")).alias("data"),
                     F.when(key % 4 > 0, F.lit("fim")).alias("descricao")).alias("ultimo_movimento"),
        ).alias("resumo"),
        F.struct(
            F.struct(
                (owner % 3).cast("string").alias("competencia"),
                (owner % 7).cast("string").alias("codigoLocalidade"),
                F.when(key % 3 == 0, "true").when(key % 3 == 1, "false").otherwise("TRUE").alias("juizo100Digital"),
                F.when(key % 4 == 0, "x").otherwise((key % 6).cast("string")).alias("nivelSigilo"),
                F.when(key % 6 == 0, "").otherwise((key % 1000 / 8).cast("string")).alias("custasRecolhidas"),
                F.transform(counter(owner % 3), lambda j: F.struct(
                    F.when(j == 1, blank_code).otherwise((owner % 50 + 100).cast("string")).alias("codigoNacional"))
                ).alias("assuntos"),
                F.struct(F.struct(
                    (owner % 25).cast("string").alias("codigoOrgao"),
                    (owner % 5).cast("string").alias("codigoMunicipioIBGE"),
                    F.lit("1").alias("instancia")).alias("atributos")).alias("orgaoJulgador"),
            ).alias("dados_basicos"),
            F.transform(counter(key % 4), movement).alias("movimentos"),
        ).alias("processo"),
    )
    return (orders_spread(spark, sf_dir) if orders is None else orders).select(
        *extra, F.concat(number, F.lit("_organized.json")).alias("_arquivo"),
        F.to_json(document).alias("texto"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML response per order, in a stored envelope; movements come in reverse order."""
    number = case_number("o_orderkey")
    filed = F.col("o_orderdate").cast("timestamp")
    key, owner = F.col("o_orderkey"), F.col("o_custkey")

    def text(*parts) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    n = key % 4

    def movement(i: Column) -> Column:
        j = n - i + 1
        when = F.timestamp_micros(F.unix_micros(filed) + j.cast("bigint") * 90_061_000_000)
        complements = F.array_join(F.transform(counter((key + j) % 3), lambda c: text(
            "<ns2:complemento>comp ", j, ".", c, "</ns2:complemento>")), "")
        return text(
            '<ns2:movimento identificadorMovimento="', j, '" dataHora="',
            F.date_format(when, "yyyyMMddHHmmss"), '">',
            F.when(j % 2 == 1, text('<ns2:movimentoNacional codigoNacional="', j + 50,
                                    '"><ns2:complemento>Nac ', j,
                                    "</ns2:complemento></ns2:movimentoNacional>")).otherwise(""),
            complements, "<ns2:complemento></ns2:complemento></ns2:movimento>")

    tree = F.replace(F.replace(text('{"arvoreProcessual":', _tree_text(), "}"),
                               F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&amp;quot;"))
    body = text(
        '<soap:Envelope xmlns:soap="urn:s" xmlns:ns2="urn:n2" xmlns:ns4="urn:n4"><soap:Body>'
        "<ns4:consultarProcessoResposta><sucesso>", F.when(key % 10 == 0, "False").otherwise("TRUE"),
        "</sucesso><mensagem>m", key % 3, '</mensagem><processo><ns2:dadosBasicos numero="', number,
        '" competencia="', owner % 3, '" classeProcessual="', F.substring("o_orderpriority", 1, 1),
        '" codigoLocalidade="', owner % 7, '" nivelSigilo="0" dataAjuizamento="',
        F.date_format(filed, "yyyyMMddHHmmss"), '">',
        F.array_join(F.transform(counter(owner % 3), lambda j: text(
            '<ns2:assunto principal="true"><ns2:codigoNacional>', owner % 50 + j,
            "</ns2:codigoNacional></ns2:assunto>")), ""),
        '<ns2:outroParametro nome="situacao" valor="antiga"/>',
        '<ns2:outroParametro nome="situacao" valor="', F.col("o_orderstatus"), '"/>',
        F.when(key % 13 != 0, text('<ns2:outroParametro nome="ARVORE_PROCESSUAL" valor="', tree, '"/>')).otherwise(""),
        '<ns2:orgaoJulgador codigoOrgao="', owner % 25, '" nomeOrgao="Vara &amp; ', owner % 25,
        '" codigoMunicipioIBGE="', owner % 5, '" instancia="1"/>',
        "<ns2:valorCausa>", F.col("o_totalprice").cast("decimal(18,2)"), "</ns2:valorCausa></ns2:dadosBasicos>",
        F.array_join(F.transform(counter(n), movement), ""),
        "</processo></ns4:consultarProcessoResposta></soap:Body></soap:Envelope>",
    )
    return orders_spread(spark, sf_dir).select(
        number.alias("numero"), filed.alias("recebido"), body.alias("corpo"))


# ---- dimensions ------------------------------------------------------------------------------

TAXONOMY_SQL = """taxonomy AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey > 3 THEN p_partkey // 2 END AS cod_item_pai,
         p_name AS nome, p_brand AS norma
  FROM part WHERE p_size <> 50)"""


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part keys as codes: parent = key div 2, so chains get deep; roots 1-3; parts of size 50 are unknown nodes."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").filter(F.col("p_size") != 50).select(
        key.alias("id"), F.when(key > 3, F.expr("p_partkey div 2")).alias("cod_item_pai"),
        F.col("p_name").alias("nome"), F.col("p_brand").alias("norma"))
