"""Taxonomy, case trees and parties (HR*, JN2, JN9, RX*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators import hierarchy, nested, parties, profile, responses, tree
from caseflow.plans import proxies as px
from caseflow.plans.registry import query
from caseflow.session import settle
from caseflow.sources import readers

# ---- taxonomy ----------------------------------------------------------------------------------

_CHAIN_SQL = f"""WITH RECURSIVE {px.TAXONOMY_SQL},
climb AS (
  SELECT id AS codigo, id, nome, cod_item_pai, 1 AS passo FROM taxonomy
  UNION ALL
  SELECT c.codigo, t.id, t.nome, t.cod_item_pai, c.passo + 1
  FROM climb c JOIN taxonomy t ON t.id = c.cod_item_pai),
chains AS (
  SELECT codigo, list(id ORDER BY passo DESC) AS ids, list(nome ORDER BY passo DESC) AS nomes,
         bool_or(cod_item_pai IS NULL) AS chain_complete
  FROM climb GROUP BY codigo)"""
_LEVELS_SQL = ", ".join(
    [f"ids[{i}] AS movimento_codigo_{i}" for i in range(1, 6)]
    + [f"nomes[{i}] AS movimento_nome_{i}" for i in range(1, 6)])


@query("code_hierarchy", f"""{_CHAIN_SQL}
SELECT codigo AS movimento_codigo, {_LEVELS_SQL}, ids[1] AS codigo_raiz, CAST(len(ids) AS BIGINT) AS nivel_folha,
  array_to_string(ids, '>') AS cadeia, chain_complete FROM chains""")
def code_hierarchy(spark, sf_dir):
    levels = hierarchy.ancestor_levels(px.taxonomy(spark, sf_dir))
    return levels.withColumns({
        "nivel_folha": F.col("nivel_folha").cast("bigint"), "cadeia": F.array_join(F.col("cadeia").cast("array<string>"), ">")})


def _enriched(spark, sf_dir) -> DataFrame:
    """lineitem part keys as movement codes; some are unknown, some are {}."""
    moves = px.table(spark, sf_dir, "lineitem").select(
        px.case_number("l_orderkey").alias("processo"), "l_linenumber",
        F.when(F.col("l_quantity") == 50, "{}").otherwise(F.col("l_partkey").cast("string")).alias("movimento_codigo"))
    lookup = hierarchy.code_lookup(px.taxonomy(spark, sf_dir))
    return hierarchy.enrich_movements(moves, lookup)


@query("hierarchy_join", f"""{_CHAIN_SQL}
SELECT lpad(CAST(l_orderkey AS VARCHAR), 20, '0') AS processo, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  l_partkey AS movimento_codigo, ids[1] AS movimento_codigo_1, ids[3] AS movimento_codigo_3, nomes[5] AS movimento_nome_5,
  t.id AS tpu_id, t.cod_item_pai AS tpu_cod_item_pai, t.nome AS tpu_nome, t.norma AS tpu_norma,
  CAST(NULL AS VARCHAR) AS tpu_glossario
FROM lineitem LEFT JOIN chains ON codigo = l_partkey LEFT JOIN taxonomy t ON t.id = l_partkey
WHERE l_quantity <> 50""")
def hierarchy_join(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "processo", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "movimento_codigo",
        "movimento_codigo_1", "movimento_codigo_3", "movimento_nome_5",
        "tpu_id", "tpu_cod_item_pai", "tpu_nome", "tpu_norma", "tpu_glossario")


@query("root_report", f"""{_CHAIN_SQL},
counts AS (SELECT ids[1] AS movimento_codigo_1, count(*) AS n
           FROM lineitem LEFT JOIN chains ON codigo = l_partkey WHERE l_quantity <> 50 GROUP BY 1)
SELECT movimento_codigo_1, CAST(n AS BIGINT) AS n, round(n * 100 / sum(n) OVER (), 1) AS percentual FROM counts""")
def root_report(spark, sf_dir):
    return hierarchy.root_report(_enriched(spark, sf_dir))


# ---- case trees --------------------------------------------------------------------------------


def _nodes(spark, sf_dir) -> DataFrame:
    return tree.flatten_trees(px.trees_text(spark, sf_dir))


def _wide_ints(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("bigint") for c in columns})


@query("tree_flatten", f"WITH {px.TREES_SQL} SELECT * FROM nodes")
def tree_flatten(spark, sf_dir):
    return _wide_ints(_nodes(spark, sf_dir), "profundidade", "ordem_entre_irmaos", "sequencial")


@query("tree_from_xml", f"WITH {px.TREES_SQL} SELECT * FROM nodes")
def tree_from_xml(spark, sf_dir):
    """The same nodes, from the entity-escaped parameter of the XML responses."""
    raw = responses.wrap_response(px.responses(spark, sf_dir), "numero", "corpo", F.col("recebido"), "SERVICE")
    # flattening looks at the text twice (depth, then nodes): parse the XML once
    trees = settle(responses.tree_text(responses.parse_responses(raw)))
    return _wide_ints(tree.flatten_trees(trees), "profundidade", "ordem_entre_irmaos", "sequencial")


@query("tree_totals", f"""WITH {px.TREES_SQL}
SELECT CAST(count(DISTINCT processo_raiz) AS BIGINT) AS processos_raiz, CAST(count(*) AS BIGINT) AS nos,
  CAST(count(*) FILTER (WHERE profundidade = 1) AS BIGINT) AS recursos_diretos, max(profundidade) AS profundidade_maxima
FROM nodes""")
def tree_totals(spark, sf_dir):
    return _wide_ints(tree.tree_totals(_nodes(spark, sf_dir)), "profundidade_maxima")


@query("tree_depths", f"""WITH {px.TREES_SQL}
SELECT profundidade, grau, CAST(count(*) AS BIGINT) AS n FROM nodes GROUP BY ALL""")
def tree_depths(spark, sf_dir):
    return _wide_ints(tree.depth_distribution(_nodes(spark, sf_dir)), "profundidade")


@query("tree_trivial", f"""WITH {px.TREES_SQL}
SELECT processo_raiz FROM nodes GROUP BY 1 HAVING max(profundidade) = 0""")
def tree_trivial(spark, sf_dir):
    return tree.trivial_trees(_nodes(spark, sf_dir))


@query("tree_rejects", f"""
SELECT {px.CASE_NUMBER_SQL} AS numero_processo, 'sem arvore' AS motivo FROM orders WHERE o_orderkey % 13 = 0""")
def tree_rejects(spark, sf_dir):
    return tree.tree_rejects(px.trees_text(spark, sf_dir)).select("numero_processo", "motivo")


@query("litigiousness", f"""WITH {px.TREES_SQL}
SELECT processo_raiz, CAST(count(*) FILTER (WHERE profundidade = 1) AS BIGINT) AS recursos_diretos,
  max(profundidade) AS profundidade_maxima FROM nodes GROUP BY 1""")
def litigiousness(spark, sf_dir):
    return _wide_ints(tree.litigiousness(_nodes(spark, sf_dir)), "profundidade_maxima")


@query("tree_outcomes", f"""WITH {px.TREES_SQL}, {px.MOVES_L_SQL}
SELECT n.processo_raiz, m.movimento_codigo, CAST(count(*) AS BIGINT) AS n
FROM nodes n JOIN moves_l m ON m.processo = n.numero_processo
WHERE m.movimento_codigo IN ('RF', 'AF') GROUP BY 1, 2""")
def tree_outcomes(spark, sf_dir):
    return tree.outcomes_by_root(_nodes(spark, sf_dir), px.moves_l(spark, sf_dir), ["RF", "AF"])


@query("tree_cases", f"""WITH {px.TREES_SQL}
SELECT processo_raiz, numero_processo, profundidade, o_orderstatus AS situacao, o_orderpriority AS classe_nome
FROM nodes LEFT JOIN orders ON {px.CASE_NUMBER_SQL} = numero_processo""")
def tree_cases(spark, sf_dir):
    cases = px.table(spark, sf_dir, "orders").select(
        px.case_number("o_orderkey").alias("processo"), F.col("o_orderstatus").alias("situacao"),
        F.col("o_orderpriority").alias("classe_nome"))
    rows = tree.nodes_with_cases(_nodes(spark, sf_dir), cases)
    return _wide_ints(rows.select("processo_raiz", "numero_processo", "profundidade", "situacao", "classe_nome"),
                      "profundidade")


# ---- parties -------------------------------------------------------------------------------------

# What each sentence template says, stated by template number: the person {p} or the company {e} as party, the role, and
# whether the person is the administrator. Sentences of other numbers say nothing.
_SAYS = {
    0: ("{p}", "terceiro", True), 1: ("{p}", "terceiro", True), 2: ("{p}", "terceiro", True), 3: ("{p}", "réu", True),
    4: ("{e}", "promovido", False), 5: ("{e}", None, False), 6: ("{p}", None, True), 7: (None, "", False),
    8: ("{e}", None, False), 10: ("{e}", "exequente", False),
}
# The companies as a sentence's party name, and with one spelling per suffix, by customer key mod 4.
_PLAIN = ("acme{k} & cia ltda.", "beta{k} s/a", "gama, delta{k} ltda.", "omega{k} & cia. s.a.")
_ONE_SPELLING = ("acme{k} e cia ltda", "beta{k} sa", "gama delta{k} ltda", "omega{k} e cia sa")


def _text_sql(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("{k}", "' || o_custkey || '") + "'"


def _company_sql(names: tuple[str, ...]) -> str:
    return "CASE o_custkey % 4 " + " ".join(f"WHEN {i} THEN {_text_sql(n)}" for i, n in enumerate(names)) + " END"


def _by_template(of) -> str:
    return "CASE o_orderkey % 12 " + " ".join(f"WHEN {i} THEN {of(x)}" for i, x in _SAYS.items()) + " END"


_PERSON_SQL = "'ana lima ' || o_custkey"
_PARTY = {"{p}": "person", "{e}": "company", None: "NULL"}
_EXTRACT_SQL = f"""{px.SENTENCES_SQL}, named AS (
  SELECT *, {_PERSON_SQL} AS person, {_company_sql(_PLAIN)} AS company, {_company_sql(_ONE_SPELLING)} AS spelled
  FROM sentences), extracted AS (
  SELECT *, {_by_template(lambda x: _PARTY[x[0]])} AS nome,
    {_by_template(lambda x: _PARTY[x[0]].replace("company", "spelled"))} AS nome_grafia,
    {_by_template(lambda x: _text_sql(x[1]))} AS especie,
    {_by_template(lambda x: "person" if x[2] else "NULL")} AS administrador
  FROM named)"""


def _enriched_sentences(spark, sf_dir) -> DataFrame:
    return parties.enrich_movements(px.sentences(spark, sf_dir))


@query("party_extract", f"""WITH {_EXTRACT_SQL}
SELECT {px.CASE_NUMBER_SQL} AS numero_processo, texto AS complemento_projudi_descricao,
  nome AS complemento_projudi_descricao_parte_nome, especie AS complemento_projudi_descricao_parte_especie,
  administrador AS complemento_projudi_descricao_administrador_judicial
FROM extracted""")
def party_extract(spark, sf_dir):
    return _enriched_sentences(spark, sf_dir).select(
        "numero_processo", parties.TEXT, parties.NAME, parties.ROLE, parties.ADMINISTRATOR)


_PARTIES_SQL = f"""{_EXTRACT_SQL}, parties AS (
  SELECT {px.CASE_NUMBER_SQL} AS numero_processo, substr(o_orderpriority, 1, 1) AS classe_codigo,
    CAST(o_orderkey AS VARCHAR) AS movimento_sequencia,
    strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS movimento_data_hora,
    CAST(o_orderkey % 100 AS VARCHAR) AS movimento_codigo, 'Mov' AS movimento_nome,
    nome_grafia AS parte_nome, especie AS parte_especie, administrador AS administrador_judicial,
    texto AS complemento_projudi_descricao, lower(o_orderstatus) AS complemento_projudi_movimentado_por_nome,
    'juiz' AS complemento_projudi_movimentado_por_cargo
  FROM extracted WHERE coalesce(nome, especie, administrador) IS NOT NULL)"""


@query("party_table", f"WITH {_PARTIES_SQL} SELECT * FROM parties")
def party_table(spark, sf_dir):
    return parties.party_table(_enriched_sentences(spark, sf_dir))


@query("suffix_norm", f"""WITH {px.SENTENCES_SQL}
SELECT o_orderkey, {_company_sql(_ONE_SPELLING)} AS empresa FROM sentences""")
def suffix_norm(spark, sf_dir):
    """RX8 on every company name of the sentences."""
    from caseflow.functions import party_text

    company = F.lower(px.company_name())
    return px.table(spark, sf_dir, "orders").select(
        "o_orderkey", party_text.normalise_suffix(company).alias("empresa"))


@query("fill_rates", f"""WITH {_EXTRACT_SQL}
SELECT CAST(count(*) AS BIGINT) AS linhas,
  CAST(count(*) FILTER (WHERE coalesce(nome, '') <> '') AS BIGINT) AS n_parte_nome,
  CAST(count(*) FILTER (WHERE coalesce(especie, '') <> '') AS BIGINT) AS n_parte_especie,
  CAST(count(administrador) AS BIGINT) AS n_administrador_judicial,
  round(count(*) FILTER (WHERE coalesce(nome, '') <> '') * 100 / count(*), 1) AS pct_parte_nome,
  round(count(*) FILTER (WHERE coalesce(especie, '') <> '') * 100 / count(*), 1) AS pct_parte_especie,
  round(count(administrador) * 100 / count(*), 1) AS pct_administrador_judicial
FROM extracted""")
def fill_rates(spark, sf_dir):
    return profile.fill_rates(_enriched_sentences(spark, sf_dir))


@query("tree_by_class", f"""WITH {px.TREES_SQL}, {_PARTIES_SQL}
SELECT o_orderpriority AS classe_nome, CAST(count(*) AS BIGINT) AS n
FROM nodes JOIN parties USING (numero_processo) JOIN orders ON {px.CASE_NUMBER_SQL} = numero_processo
WHERE eh_raiz GROUP BY 1""")
def tree_by_class(spark, sf_dir):
    documents = readers.parse_case_text(px.case_documents_text(spark, sf_dir), "texto")
    return tree.parties_by_class(
        _nodes(spark, sf_dir), parties.party_table(_enriched_sentences(spark, sf_dir)),
        nested.case_table(documents))
