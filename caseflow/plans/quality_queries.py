"""Timestamp checks, quality gates, profiles and run reports (TS*, AG6-AG26, Q20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import timestamps as ts
from caseflow.operators import nested, profile, quality
from caseflow.plans import proxies as px
from caseflow.plans.ingest_queries import RECORDS_SQL, summary_records
from caseflow.plans.registry import query
from caseflow.session import shared_dir
from caseflow.sources import readers, writers

# patterns of the two accepted formats, and one value per row parsed from them
_PARSED_SQL = rf"""{px.TIME_TEXT_SQL}, parsed AS (
  SELECT o_orderkey, texto, trim(texto) AS t, CASE
    WHEN regexp_matches(trim(texto), '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}})?Z$')
      THEN try_cast(replace(replace(trim(texto), 'T', ' '), 'Z', '') AS TIMESTAMP)
    WHEN regexp_matches(trim(texto), '^\d{{14}}$') THEN try_strptime(trim(texto), '%Y%m%d%H%M%S')
    END AS quando
  FROM time_texts)"""


def _parsed(spark, sf_dir) -> DataFrame:
    return px.time_texts(spark, sf_dir).withColumn("quando", ts.parse_timestamp(F.col("texto")))


@query("ts_normalise", f"""
WITH {_PARSED_SQL}
SELECT o_orderkey, texto, strftime(quando, '%Y-%m-%d %H:%M:%S') AS quando,
       strftime(quando, '%Y-%m-01') AS mes, CAST(year(quando) AS BIGINT) AS ano
FROM parsed""")
def ts_normalise(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "o_orderkey", "texto", F.date_format("quando", "yyyy-MM-dd HH:mm:ss").alias("quando"),
        px.day(ts.month_start(F.col("quando"))).alias("mes"), F.year("quando").cast("bigint").alias("ano"))


@query("ts_prefix", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS data,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS instante,
       strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS exibicao,
       CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') ELSE '2020' END AS compacto
FROM orders""")
def ts_prefix(spark, sf_dir):
    """TS7, TS10, TS11 on printed order dates."""
    filed = F.col("o_orderdate").cast("timestamp")
    iso = F.date_format(filed, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    digits = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(filed, "yyyyMMddHHmmss")).otherwise("2020")
    return px.table(spark, sf_dir, "orders").select(
        "o_orderkey", px.day(ts.parse_date_prefix(iso)).alias("data"),
        F.date_format(ts.parse_iso_prefix(iso), "yyyy-MM-dd HH:mm:ss").alias("instante"),
        ts.query_time_to_display(F.date_format(filed, "yyyyMMdd_HHmmss")).alias("exibicao"),
        ts.compact_to_display(digits).alias("compacto"))


@query("ts_profile", rf"""
WITH {px.TIME_TEXT_SQL}, classed AS (
  SELECT trim(texto) AS v, CASE
    WHEN texto IS NULL OR trim(texto) = '' THEN 'vazio/NA'
    WHEN regexp_matches(trim(texto), '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}})?Z$') THEN 'iso8601_Z'
    WHEN regexp_matches(trim(texto), '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}})?$') THEN 'iso8601_semZ'
    WHEN regexp_matches(trim(texto), '^\d{{14}}$') THEN 'num_yyyymmddhhmmss'
    WHEN regexp_matches(trim(texto), '^\d{{12}}$') THEN 'num_yyyymmddhhmm'
    WHEN regexp_matches(trim(texto), '^\d{{8}}$') THEN 'num_yyyymmdd'
    ELSE 'outro' END AS perfil
  FROM time_texts)
SELECT perfil, CAST(count(*) AS BIGINT) AS n,
       coalesce(array_to_string(list_sort(list_distinct(list(v)))[1:5], ' | '), '') AS exemplos
FROM classed GROUP BY perfil""")
def ts_profile(spark, sf_dir):
    return quality.format_profile(px.time_texts(spark, sf_dir), "texto")


@query("ts_report", f"""
WITH {_PARSED_SQL}
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(quando) AS BIGINT) AS parse_ok,
  CAST(count(*) - count(quando) AS BIGINT) AS parse_erro,
  strftime(min(quando), '%Y-%m-%d %H:%M:%S') AS min_data, strftime(max(quando), '%Y-%m-%d %H:%M:%S') AS max_data
FROM parsed""")
def ts_report(spark, sf_dir):
    report = quality.parse_report(_parsed(spark, sf_dir), "quando")
    return report.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("min_data", "max_data")})


@query("ts_midnight", rf"""
WITH {_PARSED_SQL}, flags AS (
  SELECT strftime(quando, '%H%M%S') = '000000' AS eh_meianoite,
         regexp_matches(texto, 'T00:00:00(\.000)?Z$') AS raw_meianoite
  FROM parsed WHERE quando IS NOT NULL),
counts AS (SELECT eh_meianoite, raw_meianoite, count(*) AS qtd FROM flags GROUP BY ALL)
SELECT eh_meianoite, raw_meianoite, format('{{:,}}', qtd) AS n,
       format('{{:.1f}}%', round(qtd * 100.0 / sum(qtd) OVER (), 1)) AS percentual,
       CASE WHEN NOT eh_meianoite AND NOT raw_meianoite THEN 'Data com hora na origem (datetime completo)'
            WHEN eh_meianoite AND raw_meianoite THEN 'Data sem hora na origem (formato raw ISO com 00:00:00)'
            WHEN eh_meianoite THEN 'Data sem hora na origem (formato raw YYYYMMDD000000)'
            ELSE 'Outro caso' END AS significado
FROM counts""")
def ts_midnight(spark, sf_dir):
    return quality.midnight_audit(_parsed(spark, sf_dir), "quando", "texto")


# ---- quality: lineitem as movements with planted NULLs and {} codes -------------------------


def planted_movements(spark, sf_dir, holes: bool = True) -> DataFrame:
    key, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    code = F.when(part % 19 == 0, "{}").otherwise(F.concat("l_returnflag", "l_linestatus"))
    if holes:
        code = F.when(part % 23 == 0, F.lit(None)).otherwise(code)
    with_complement = F.col("l_suppkey") % 3 == 0
    return px.table(spark, sf_dir, "lineitem").select(
        F.concat(key.cast("string"), F.lit("_"), line.cast("string")).alias("id"),
        px.case_number("l_orderkey").alias("processo"),
        code.alias("movimento_codigo"),
        F.lit("Mov").alias("movimento_nome"),
        F.col("l_shipdate").cast("timestamp").alias("movimento_data_hora"),
        F.when(with_complement, part).alias("complemento_codigo"),
        F.when(with_complement, "nome").alias("complemento_nome"),
        F.when(with_complement & (line > 1), "valor").alias("complemento_valor"),
        F.when(with_complement, "descricao").alias("complemento_descricao"),
    )


_PLANTED_SQL = """planted AS (
  SELECT l_orderkey || '_' || l_linenumber AS id, lpad(CAST(l_orderkey AS VARCHAR), 20, '0') AS processo,
    CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN '{}'
         ELSE l_returnflag || l_linestatus END AS movimento_codigo,
    l_shipdate AS movimento_data_hora, l_suppkey % 3 = 0 AS com, l_suppkey % 3 = 0 AND l_linenumber > 1 AS com_valor,
    CASE WHEN l_suppkey % 3 = 0 THEN l_partkey END AS complemento_codigo
  FROM lineitem),
cells AS (SELECT *, CAST(movimento_codigo IS NULL AS BIGINT) AS code_null,
  CAST(NOT com AS BIGINT) * 3 + CAST(NOT com_valor AS BIGINT) AS comp_null FROM planted)"""


@query("qa_nulls", f"""
WITH {_PLANTED_SQL}
SELECT 'df_movimentos' AS dataframe, CAST(count(*) AS BIGINT) AS n_linhas, CAST(9 AS BIGINT) AS n_colunas,
  CAST(sum(code_null + comp_null) AS BIGINT) AS n_celulas_na,
  round(sum(code_null + comp_null) / (count(*) * 9), 6) AS pct_celulas_na,
  CAST(max(code_null) + max(CAST(NOT com AS BIGINT)) * 3 + max(CAST(NOT com_valor AS BIGINT)) AS BIGINT) AS n_colunas_com_na
FROM cells
UNION ALL
SELECT 'df_processos', CAST(count(*) AS BIGINT), CAST(6 AS BIGINT), CAST(0 AS BIGINT), 0.0, CAST(0 AS BIGINT) FROM orders""")
def qa_nulls(spark, sf_dir):
    report = quality.stack(
        quality.null_profile(planted_movements(spark, sf_dir), "df_movimentos"),
        quality.null_profile(px.table(spark, sf_dir, "orders"), "df_processos"))
    return report.withColumn("pct_celulas_na", F.round("pct_celulas_na", 6))


@query("qa_strict", f"""
WITH {_PLANTED_SQL}
SELECT 'df_movimentos' AS dataframe, CAST(count(*) AS BIGINT) AS linhas, CAST(9 AS BIGINT) AS colunas,
  CAST(count(*) FILTER (WHERE code_null + comp_null > 0) AS BIGINT) AS linhas_com_na,
  CAST(max(code_null) + max(CAST(NOT com AS BIGINT)) * 3 + max(CAST(NOT com_valor AS BIGINT)) AS BIGINT) AS colunas_com_na,
  CAST(sum(code_null + comp_null) AS BIGINT) AS celulas_na, 'ERRO' AS status
FROM cells
UNION ALL
SELECT 'df_processos', CAST(count(*) AS BIGINT), CAST(6 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'OK' FROM orders""")
def qa_strict(spark, sf_dir):
    clean = quality.quality_gate(quality.strict_quality(px.table(spark, sf_dir, "orders"), "df_processos"))
    return quality.stack(quality.strict_quality(planted_movements(spark, sf_dir), "df_movimentos"), clean)


@query("qa_roles", f"""
WITH {_PLANTED_SQL}, counted AS (
  SELECT count(*) AS linhas, sum(code_null) AS bad, count(*) FILTER (WHERE NOT com) AS bare, sum(comp_null) AS comp_cells
  FROM cells)
SELECT 'com_falhas' AS dataframe, CAST(linhas AS BIGINT) AS linhas, CAST(bad AS BIGINT) AS linhas_com_na_obrigatorio,
  CAST(bad AS BIGINT) AS celulas_na_obrigatorio, 'ERRO' AS status_obrigatorio, CAST(bare AS BIGINT) AS linhas_sem_complemento,
  CAST(comp_cells AS BIGINT) AS celulas_na_complemento, 'OK' AS status_complemento,
  'ERRO: ' || bad || ' linhas com NA em obrigatórias' AS mensagem FROM counted
UNION ALL
SELECT 'sem_falhas', CAST(linhas AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'OK', CAST(bare AS BIGINT),
  CAST(comp_cells AS BIGINT), 'OK', 'Obrigatórias OK; ' || bare || ' linhas sem complemento' FROM counted""")
def qa_roles(spark, sf_dir):
    return quality.stack(
        quality.movement_quality(planted_movements(spark, sf_dir), "com_falhas"),
        quality.movement_quality(planted_movements(spark, sf_dir, holes=False), "sem_falhas"))


@query("qa_gate", f"""
WITH {_PLANTED_SQL}
SELECT 'df_movimentos' AS dataframe, CAST(count(*) AS BIGINT) AS linhas, 'ERRO' AS status,
  CAST(count(*) FILTER (WHERE code_null > 0) AS BIGINT) AS linhas_com_na,
  'NULLs in critical tables: df_movimentos' AS mensagem
FROM cells
UNION ALL
SELECT 'df_processos', CAST(count(*) AS BIGINT), 'OK', CAST(0 AS BIGINT), '' FROM orders""")
def qa_gate(spark, sf_dir):
    """AG14: tables written through the gate; the one with missing codes stops it, the other passes."""
    tables = {"df_movimentos": planted_movements(spark, sf_dir).select("id", "processo", "movimento_codigo"),
              "df_processos": px.table(spark, sf_dir, "orders")}
    reports = []
    for name, frame in tables.items():
        written = writers.write_checked(frame, shared_dir(spark), gate=quality.null_gate(frame.columns))
        try:
            quality.gate_written(written, name)
            status, message = "OK", ""
        except quality.QualityError as error:
            status, message = "ERRO", str(error)
        reports.append(written.select(
            F.lit(name).alias("dataframe"), "linhas", F.lit(status).alias("status"), F.col("linhas_com_na").cast("bigint"),
            F.lit(message).alias("mensagem")))
    return quality.stack(*reports)


@query("required_inputs", """
SELECT 'orders.parquet' AS arquivo, TRUE AS existe, 'OK' AS status, CAST(count(*) AS BIGINT) AS linhas FROM orders
UNION ALL SELECT 'lineitem.parquet', TRUE, 'OK', CAST(count(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'processos.parquet', FALSE, 'ERRO', NULL""")
def required_inputs(spark, sf_dir):
    """SC4: which expected tables are there, and the rows of those that are."""
    names = ["orders.parquet", "lineitem.parquet", "processos.parquet"]
    status = readers.required_inputs(spark, sf_dir, names)
    found = [r.arquivo for r in status.collect() if r.existe]  # one row per expected name
    rows = quality.stack(*[spark.read.parquet(f"{sf_dir}/{n}").agg(F.count("*").alias("linhas")).withColumn(
        "arquivo", F.lit(n)) for n in found])
    return status.join(rows, "arquivo", "left").select("arquivo", "existe", "status", "linhas")


@query("numeric_times", """
SELECT 'texto' AS coluna, 'string' AS tipo, CAST(count(*) AS BIGINT) AS valores, CAST(0 AS BIGINT) AS perdidos, 'OK' AS status FROM orders
UNION ALL SELECT 'duplo', 'double', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), 'AVISO' FROM orders
UNION ALL SELECT 'milis', 'double', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), 'AVISO' FROM orders
UNION ALL SELECT 'simples', 'float', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), 'AVISO' FROM orders
UNION ALL SELECT 'dia', 'int', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), 'AVISO' FROM orders""")
def numeric_times(spark, sf_dir):
    """AG25: order dates as digit stamps, kept as text and as numbers of several widths."""
    text = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMddHHmmss")
    stamps = px.table(spark, sf_dir, "orders").select(
        text.alias("texto"), text.cast("double").alias("duplo"), (text.cast("double") * 1000).alias("milis"),
        text.cast("float").alias("simples"), F.substring(text, 1, 8).cast("int").alias("dia"))
    return quality.numeric_time_losses(stamps, stamps.columns)


@query("qa_empty_codes", f"""
WITH {_PLANTED_SQL}
SELECT id, processo, movimento_codigo FROM planted WHERE movimento_codigo IS NULL OR movimento_codigo = '{{}}'""")
def qa_empty_codes(spark, sf_dir):
    return quality.empty_code_movements(planted_movements(spark, sf_dir)).select("id", "processo", "movimento_codigo")


# ---- profiles ---------------------------------------------------------------------------------


@query("profile_cases", f"""
WITH {px.CASES_SQL}, totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_processos, CAST(count(DISTINCT processo) AS BIGINT) AS n_processos_uniq,
    CAST(count(DISTINCT tribunal) AS BIGINT) AS n_tribunais, CAST(count(DISTINCT classe_nome) AS BIGINT) AS n_classes,
    CAST(count(DISTINCT orgao_julgador_municipio_ibge) AS BIGINT) AS n_municipios,
    min(ano_ajuizamento) AS ano_min, max(ano_ajuizamento) AS ano_max,
    strftime(min(data_ajuizamento), '%Y-%m-%d') AS data_min, strftime(max(data_ajuizamento), '%Y-%m-%d') AS data_max,
    avg(CAST(strftime(data_ajuizamento, '%H%M%S') = '000000' AS DOUBLE)) AS pct_sem_hora
  FROM cases)
SELECT DISTINCT c.tribunal, t.* FROM cases c, totals t""")
def profile_cases(spark, sf_dir):
    rows = profile.case_profile(px.cases(spark, sf_dir))
    return rows.withColumns({c: px.day(F.col(c)) for c in ("data_min", "data_max")})


@query("profile_moves", f"""
WITH {_PLANTED_SQL}
SELECT CAST(count(DISTINCT processo) AS BIGINT) AS n_processos_uniq, CAST(count(*) AS BIGINT) AS n_movimentos,
  CAST(count(DISTINCT movimento_codigo) AS BIGINT) AS n_tipos_movimento,
  strftime(min(movimento_data_hora), '%Y-%m-%d') AS data_min, strftime(max(movimento_data_hora), '%Y-%m-%d') AS data_max,
  round(count(*) / count(DISTINCT processo), 6) AS media_mov_processo,
  round(avg(CAST(complemento_codigo IS NOT NULL AS DOUBLE)), 6) AS pct_com_complemento
FROM planted""")
def profile_moves(spark, sf_dir):
    rows = profile.movement_profile(planted_movements(spark, sf_dir))
    return rows.withColumns({
        **{c: px.day(F.col(c)) for c in ("data_min", "data_max")},
        **{c: F.round(c, 6) for c in ("media_mov_processo", "pct_com_complemento")}})


@query("profile_subjects", """
SELECT CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_processos_uniq, CAST(count(*) AS BIGINT) AS n_assuntos,
  CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_assuntos_uniq,
  round(count(*) / count(DISTINCT l_orderkey), 6) AS media_assuntos_processo
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def profile_subjects(spark, sf_dir):
    lines = px.table(spark, sf_dir, "lineitem").join(
        px.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    subjects = lines.select(px.case_number("l_orderkey").alias("processo"),
                            F.col("l_partkey").alias("assunto_codigo"), F.col("p_type").alias("assunto_nome"))
    rows = profile.subject_profile(subjects)
    return rows.withColumn("media_assuntos_processo", F.round("media_assuntos_processo", 6))


@query("dim_enrich", """
SELECT c_custkey, c_name, n_name AS municipio_nome, r_name AS municipio_mesorregiao
FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 4)
  ON c_nationkey = n_nationkey""")
def dim_enrich(spark, sf_dir):
    """JN1: nations as municipalities; one of them is unknown to the dimension."""
    nation = px.table(spark, sf_dir, "nation").filter(F.col("n_nationkey") != 4)
    dimension = nation.join(px.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("municipio_nome"),
        F.col("r_name").alias("municipio_mesorregiao"))
    customers = px.table(spark, sf_dir, "customer")
    return nested.add_municipality(customers, dimension, "c_nationkey").select(
        "c_custkey", "c_name", "municipio_nome", "municipio_mesorregiao")


_SUMMARY_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

# eight places: the means of two-decimal values over 60,000 rows fall on halves of the sixth


@query("table_summary", " UNION ALL ".join(f"""
SELECT '{c}' AS coluna, CAST(count({c}) AS BIGINT) AS n, round(min({c}), 8) AS minimo,
  round(quantile_cont({c}, 0.25), 8) AS q1, round(quantile_cont({c}, 0.5), 8) AS mediana, round(avg({c}), 8) AS media,
  round(quantile_cont({c}, 0.75), 8) AS q3, round(max({c}), 8) AS maximo FROM lineitem""" for c in _SUMMARY_COLUMNS))
def table_summary(spark, sf_dir):
    summary = profile.column_summary(px.table(spark, sf_dir, "lineitem"), list(_SUMMARY_COLUMNS))
    return summary.select("coluna", "n", *[F.round(c, 8).alias(c) for c in
                                           ("minimo", "q1", "mediana", "media", "q3", "maximo")])


# ---- case lists and duplicates ---------------------------------------------------------------


@query("q20_case_list", "SELECT DISTINCT lpad(CAST(l_orderkey AS VARCHAR), 20, '0') AS processo FROM lineitem")
def q20_case_list(spark, sf_dir):
    return profile.distinct_keys(px.moves_l(spark, sf_dir), "processo")


@query("dup_report", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dup_report(spark, sf_dir):
    return profile.duplicate_report(px.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("dup_summary", """
SELECT CAST(count(*) AS BIGINT) AS total_registros, CAST(count(DISTINCT text) AS BIGINT) AS processos_unicos,
       CAST(count(*) - count(DISTINCT text) AS BIGINT) AS duplicatas FROM documents""")
def dup_summary(spark, sf_dir):
    return profile.duplicate_summary(px.table(spark, sf_dir, "documents"), "text")


# ---- run reports ------------------------------------------------------------------------------

_CODES_SQL = f"""{RECORDS_SQL}, codes AS (
  SELECT trim(unnest(string_split(codigos_nacionais, ','))) AS codigo FROM records WHERE codigos_nacionais <> '')"""


@query("code_top5", f"""
WITH {_CODES_SQL}
SELECT codigo, CAST(count(*) AS BIGINT) AS frequencia,
       round(count(*) * 100 / (SELECT count(*) FROM records), 6) AS percentual
FROM codes GROUP BY codigo ORDER BY frequencia DESC, codigo LIMIT 5""")
def code_top5(spark, sf_dir):
    top = profile.code_frequency(summary_records(spark, sf_dir), "codigos_nacionais")
    return top.withColumn("percentual", F.round("percentual", 6))


@query("code_presence", f"""
WITH {_CODES_SQL}
SELECT CAST(count(*) FILTER (WHERE codigos_nacionais <> '') AS BIGINT) AS com_codigos,
       CAST(count(*) FILTER (WHERE codigos_nacionais = '') AS BIGINT) AS sem_codigos,
       (SELECT CAST(count(DISTINCT codigo) AS BIGINT) FROM codes) AS codigos_unicos
FROM records""")
def code_presence(spark, sf_dir):
    return profile.code_presence(summary_records(spark, sf_dir), "codigos_nacionais")


_FILL_FIELDS = ("_arquivo_origem", "codigos_nacionais", "total_codigos_nacionais", "classe_processual",
                "data_ajuizamento", "numero_processo", "orgao_julgador", "situacao", "status", "total_movimentos",
                "ultimo_movimento_data", "ultimo_movimento_descricao", "valor_causa")


@query("field_fill", f"""
WITH {RECORDS_SQL}, fills AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS campo, count(*) FILTER (WHERE coalesce(CAST({c} AS VARCHAR), '') <> '') AS k, count(*) AS total "
    "FROM records" for c in _FILL_FIELDS) + """)
SELECT campo, CAST(k AS BIGINT) AS preenchidos, round(k * 100 / total, 6) AS percentual
FROM fills ORDER BY k DESC, campo LIMIT 10""")
def field_fill(spark, sf_dir):
    fill = profile.field_fill(summary_records(spark, sf_dir))
    return fill.withColumn("percentual", F.round("percentual", 6))


@query("run_report", """
WITH log AS (SELECT ts, event_type <> 'error' AS baixado,
  CASE WHEN event_type IN ('view', 'purchase') THEN 'ok' WHEN event_type = 'error' THEN 'erro' ELSE 'parcial' END AS status
  FROM events)
SELECT CAST(count(*) AS BIGINT) AS processos_totais, CAST(count(*) FILTER (WHERE baixado) AS BIGINT) AS downloads,
  CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS processados,
  CAST(count(*) FILTER (WHERE status = 'erro') AS BIGINT) AS erros,
  round(count(*) FILTER (WHERE status = 'ok') * 100.0 / count(*), 6) AS taxa_sucesso,
  round(count(*) FILTER (WHERE status = 'ok') / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6), 6) AS processos_por_segundo
FROM log""")
def run_report(spark, sf_dir):
    """AG18: events as the per-case log of a run."""
    kind, when = F.col("event_type"), F.col("ts").cast("timestamp")
    log = px.table(spark, sf_dir, "events").select(
        when.alias("inicio"), when.alias("fim"), (kind != "error").alias("baixado"),
        F.when(kind.isin("view", "purchase"), "ok").when(kind == "error", "erro").otherwise("parcial").alias("status"))
    report = profile.run_report(log)
    return report.withColumns({c: F.round(c, 6) for c in ("taxa_sucesso", "processos_por_segundo")})
