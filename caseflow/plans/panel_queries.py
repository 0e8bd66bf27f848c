"""Filing panels, backlog and flow (Q1-Q10, Q13, Q16)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators import events, panel
from caseflow.plans import proxies as px
from caseflow.plans.registry import query

GRID_FIRST, GRID_LAST = "1995-02-01", "2001-06-01"
SINCE = "2001-01-01"
SPEC_SQL = "(1, 3, 5, 8)"


def _months(first: str, last: str) -> list[str]:
    a, b = date.fromisoformat(first), date.fromisoformat(last)
    return [date(i // 12, i % 12 + 1, 1).isoformat()
            for i in range(a.year * 12 + a.month - 1, b.year * 12 + b.month)]


_IS_SPEC = f"coalesce(orgao_julgador_codigo IN {SPEC_SQL}, FALSE)"

_LABELLED = f"""labelled AS (
  SELECT CASE WHEN {_IS_SPEC} THEN 'especializada' ELSE 'nao_especializada' END AS grupo,
         CASE WHEN {_IS_SPEC} THEN orgao_julgador_nome ELSE 'nao_especializada (agrupadas)' END AS orgao_label,
         mes_ajuizamento AS mes
  FROM cases WHERE mes_ajuizamento >= DATE '{GRID_FIRST}')"""


def _wide(spark, sf_dir) -> DataFrame:
    return panel.filings_wide(px.cases(spark, sf_dir, GRID_FIRST), px.SPEC, GRID_FIRST, GRID_LAST)


def _pivot_sql(months: list[str]) -> str:
    return ", ".join(f"CAST(count(*) FILTER (WHERE mes = DATE '{m}') AS BIGINT) AS \"{m}\"" for m in months)


@query("q1_panel_wide", f"""
WITH {px.CASES_SQL}, {_LABELLED}
SELECT grupo, orgao_label, {_pivot_sql(_months(GRID_FIRST, "2001-08-01"))}
FROM labelled GROUP BY grupo, orgao_label""")
def q1(spark, sf_dir):
    return _wide(spark, sf_dir)


def _long_sql(key: str) -> str:
    return f"""
WITH {px.CASES_SQL}, {_LABELLED},
grid AS (SELECT DISTINCT {key}, CAST(m AS DATE) AS mes FROM labelled,
         unnest(generate_series(TIMESTAMP '{GRID_FIRST}', TIMESTAMP '{GRID_LAST}', INTERVAL 1 MONTH)) AS t(m)),
counts AS (SELECT {key}, mes, count(*) AS n FROM labelled GROUP BY {key}, mes)
SELECT g.{key}, strftime(g.mes, '%Y-%m-%d') AS mes, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN counts c ON g.{key} = c.{key} AND g.mes = c.mes"""


@query("q2_panel_group", _long_sql("grupo"))
def q2(spark, sf_dir):
    long = panel.filings_long(_wide(spark, sf_dir), "grupo", GRID_FIRST, GRID_LAST)
    return long.select("grupo", F.col("mes").cast("string").alias("mes"), "n")


@query("q3_panel_label", _long_sql("orgao_label"))
def q3(spark, sf_dir):
    long = panel.filings_long(_wide(spark, sf_dir), "orgao_label", GRID_FIRST, GRID_LAST)
    return long.select("orgao_label", F.col("mes").cast("string").alias("mes"), "n")


@query("q4_nonspec_wide", f"""
WITH {px.CASES_SQL}, others AS (SELECT orgao_julgador_nome, mes_ajuizamento AS mes FROM cases
  WHERE NOT {_IS_SPEC} AND mes_ajuizamento >= DATE '{SINCE}')
SELECT orgao_julgador_nome, {_pivot_sql(_months(SINCE, "2001-08-01"))}
FROM others GROUP BY orgao_julgador_nome""")
def q4(spark, sf_dir):
    return panel.other_courts_wide(px.cases(spark, sf_dir, SINCE), px.SPEC, SINCE, "2001-08-01")


@query("q5_nonspec_list", f"""
WITH {px.CASES_SQL}
SELECT processo, orgao_julgador_codigo, orgao_julgador_nome, classe_nome, tribunal,
       strftime(data_ajuizamento, '%Y-%m-%d') AS data_ajuizamento
FROM cases WHERE NOT {_IS_SPEC} AND mes_ajuizamento >= DATE '{SINCE}'""")
def q5(spark, sf_dir):
    rows = panel.other_courts_list(px.cases(spark, sf_dir, SINCE), px.SPEC, SINCE)
    return rows.select("processo", "orgao_julgador_codigo", "orgao_julgador_nome", "classe_nome", "tribunal",
                       px.day(F.col("data_ajuizamento")).alias("data_ajuizamento"))


_FLAGGED_SQL = f"""{px.CASES_SQL}, {px.MOVES_L_SQL}, flagged AS (
  SELECT c.*, m.movimento_data_hora AS data_movimento_incompetencia
  FROM moves_l m JOIN cases c ON m.processo = c.processo
  WHERE m.movimento_codigo = 'RF' AND c.mes_ajuizamento >= DATE '{SINCE}')"""


def _flagged(spark, sf_dir) -> DataFrame:
    return events.cases_with_movement(
        px.moves_l(spark, sf_dir, "RF"), px.cases(spark, sf_dir, SINCE), code="RF", since=SINCE)


@query("q6_flagged_cases", f"""
WITH {_FLAGGED_SQL}
SELECT processo, strftime(data_movimento_incompetencia, '%Y-%m-%d') AS data_movimento_incompetencia,
       classe_codigo, classe_nome, strftime(data_ajuizamento, '%Y-%m-%d') AS data_ajuizamento,
       orgao_julgador_codigo, orgao_julgador_nome, ano_ajuizamento,
       strftime(mes_ajuizamento, '%Y-%m-%d') AS mes_ajuizamento, municipio_nome
FROM flagged""")
def q6(spark, sf_dir):
    rows = _flagged(spark, sf_dir).orderBy("processo", "data_movimento_incompetencia")
    dropped = rows.drop("id", "orgao_julgador_municipio_ibge", "tribunal", "grau")
    return dropped.withColumns({
        c: px.day(F.col(c)) for c in ("data_movimento_incompetencia", "data_ajuizamento", "mes_ajuizamento")})


@query("q7_flagged_by_month", f"""
WITH {_FLAGGED_SQL}
SELECT municipio_nome, strftime(date_trunc('month', data_movimento_incompetencia), '%Y-%m-%d') AS mes,
       CAST(count(*) AS BIGINT) AS n
FROM flagged GROUP BY ALL""")
def q7(spark, sf_dir):
    return panel.flagged_by_month(_flagged(spark, sf_dir)).withColumn("mes", px.day(F.col("mes")))


_ARCHIVED_SQL = f"""{px.CASES_SQL}, {px.MOVES_L_SQL}, flags AS (
  SELECT c.*, EXISTS (SELECT 1 FROM moves_l m WHERE m.processo = c.processo AND m.movimento_codigo = 'AF')
         AS status_arquivamento_definitivo FROM cases c)"""


def _archived(spark, sf_dir) -> DataFrame:
    return events.with_existence_flag(px.cases(spark, sf_dir), px.moves_l(spark, sf_dir, "AF"), code="AF")


@query("q8_archive_flag", f"""
WITH {_ARCHIVED_SQL}
SELECT status_arquivamento_definitivo, CAST(count(*) AS BIGINT) AS n FROM flags GROUP BY ALL""")
def q8(spark, sf_dir):
    return _archived(spark, sf_dir).groupBy("status_arquivamento_definitivo").agg(F.count("*").alias("n"))


@query("q9_backlog_by_court", f"""
WITH {_ARCHIVED_SQL}
SELECT orgao_julgador_nome, CAST(count(*) AS BIGINT) AS quantidade_processos_ajuizados,
  CAST(count(*) FILTER (WHERE status_arquivamento_definitivo) AS BIGINT)
    AS quantidade_processos_arquivamento_definitivo,
  CAST(count(*) FILTER (WHERE NOT status_arquivamento_definitivo) AS BIGINT) AS quantidade_processos_ativos
FROM flags WHERE NOT {_IS_SPEC} GROUP BY orgao_julgador_nome""")
def q9(spark, sf_dir):
    return panel.backlog_by_court(_archived(spark, sf_dir), px.SPEC)


def _flow_sql(source: str) -> str:
    return f"""{px.CASES_SQL}, {px.MOVES_L_SQL},
others AS (SELECT * FROM cases WHERE NOT {_IS_SPEC}),
hits AS ({source}),
flow AS (
  SELECT orgao_julgador_codigo, orgao_julgador_nome, mes_ajuizamento AS mes,
         CAST(count(*) AS BIGINT) AS n, 'ajuizamento' AS tipo
  FROM others GROUP BY ALL
  UNION ALL
  SELECT o.orgao_julgador_codigo, o.orgao_julgador_nome, CAST(date_trunc('month', h.movimento_data_hora) AS DATE),
         CAST(-count(*) AS BIGINT), 'arquivamento'
  FROM hits h JOIN others o ON h.processo = o.processo
  GROUP BY ALL),
windowed AS (SELECT * FROM flow WHERE mes BETWEEN DATE '{GRID_FIRST}' AND DATE '{GRID_LAST}')"""


_HITS = "SELECT processo, movimento_data_hora FROM moves_l WHERE movimento_codigo = 'AF'"
_FLOW_COLUMNS = """orgao_julgador_codigo, orgao_julgador_nome, strftime(mes, '%Y-%m-%d') AS mes, n, tipo"""


def _flow(spark, sf_dir, **options) -> DataFrame:
    return panel.monthly_flow(px.cases(spark, sf_dir), px.moves_l(spark, sf_dir, "AF"), px.SPEC,
                              GRID_FIRST, GRID_LAST, archive_code="AF", **options)


@query("q10_flow", f"WITH {_flow_sql(_HITS)} SELECT {_FLOW_COLUMNS} FROM windowed")
def q10(spark, sf_dir):
    return _flow(spark, sf_dir).withColumn("mes", px.day(F.col("mes")))


@query("q10_flow_distinct",
       f"WITH {_flow_sql(_HITS.replace('SELECT', 'SELECT DISTINCT'))} SELECT {_FLOW_COLUMNS} FROM windowed")
def q10_distinct(spark, sf_dir):
    return _flow(spark, sf_dir, distinct_movements=True).withColumn("mes", px.day(F.col("mes")))


@query("q10_flow_check", f"""
WITH {_flow_sql(_HITS)}
SELECT tipo, CAST(count(*) AS BIGINT) AS linhas, strftime(min(mes), '%Y-%m-%d') AS min_mes,
       strftime(max(mes), '%Y-%m-%d') AS max_mes
FROM windowed GROUP BY tipo""")
def q10_check(spark, sf_dir):
    return panel.flow_check(_flow(spark, sf_dir)).withColumns({
        "min_mes": px.day(F.col("min_mes")), "max_mes": px.day(F.col("max_mes"))})


@query("q13_monthly_complete", """
WITH counts AS (SELECT date_trunc('month', l_shipdate) AS mes, count(*) AS n FROM lineitem GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(CAST(mes AS TIMESTAMP)), max(CAST(mes AS TIMESTAMP)), INTERVAL 1 MONTH)) AS mes FROM counts)
SELECT strftime(g.mes, '%Y-%m-%d') AS mes, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN counts c ON CAST(c.mes AS TIMESTAMP) = g.mes""")
def q13(spark, sf_dir):
    counts = panel.monthly_counts(px.moves_l(spark, sf_dir), "movimento_data_hora")
    return panel.complete_series(counts, "mes").withColumn("mes", px.day(F.col("mes"))).orderBy("mes")


@query("q13_complete_by_supplier", """
WITH counts AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS mes, count(*) AS n
                FROM lineitem GROUP BY 1, 2),
grid AS (SELECT l_suppkey, unnest(generate_series(min(mes), max(mes), INTERVAL 1 MONTH)) AS mes
         FROM counts GROUP BY l_suppkey)
SELECT g.l_suppkey, strftime(g.mes, '%Y-%m-%d') AS mes, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN counts c ON c.l_suppkey = g.l_suppkey AND c.mes = g.mes""")
def q13_by_supplier(spark, sf_dir):
    counts = panel.monthly_counts(px.table(spark, sf_dir, "lineitem"), "l_shipdate", ["l_suppkey"])
    return panel.complete_series(counts, "mes", ["l_suppkey"]).withColumn("mes", px.day(F.col("mes")))


@query("q16_share_by_month", """
WITH counts AS (SELECT date_trunc('month', o_orderdate) AS m, o_orderstatus AS status, count(*) AS n
                FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2)
SELECT strftime(m, '%Y-%m-%d') AS mes, status, CAST(n AS BIGINT) AS n,
       CAST(sum(n) OVER (PARTITION BY m) AS BIGINT) AS total,
       round(n / sum(n) OVER (PARTITION BY m), 6) AS prop
FROM counts QUALIFY status = 'F'""")
def q16(spark, sf_dir):
    decisions = px.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("data_decisao"))
    rate = panel.status_rate(decisions, "F", "1996-01-01")
    return rate.withColumns({"mes": px.day(F.col("mes")), "prop": F.round("prop", 6)})
