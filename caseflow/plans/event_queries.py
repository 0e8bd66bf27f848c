"""Latest-event, as-of, duration and judge-time queries (Q11, Q12, Q14, Q15, Q19, SC7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import timestamps as ts
from caseflow.operators import events, panel, profile, viscosity
from caseflow.plans import proxies as px
from caseflow.plans.panel_queries import SPEC_SQL
from caseflow.plans.registry import query
from caseflow.session import shared_dir
from caseflow.sources import writers

STAMP_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def _ties():
    return [F.col("event_id")]


@query("q11_last_status", f"""
WITH {px.MOVES_E_SQL}
SELECT processo, CASE WHEN movimento_codigo = 'purchase' THEN 'sem_transito' ELSE 'com_transito' END
         AS transito_status, strftime(movimento_data_hora, {STAMP_SQL}) AS transito_data
FROM moves_e
QUALIFY row_number() OVER (PARTITION BY processo ORDER BY movimento_data_hora DESC NULLS LAST, event_id) = 1""")
def q11(spark, sf_dir):
    status = events.last_status(px.moves_e(spark, sf_dir), _ties(), final_code="purchase")
    return status.withColumn("transito_data", px.stamp(F.col("transito_data")))


_DECISIONS_SQL = f"""{px.MOVES_E_SQL}, decisions AS (
  SELECT processo, CASE WHEN movimento_codigo = 'purchase' THEN 'Admitido' ELSE 'Não admitido' END AS status,
         movimento_data_hora AS data_decisao
  FROM moves_e WHERE movimento_codigo IN ('purchase', 'error')
  QUALIFY row_number() OVER (PARTITION BY processo ORDER BY movimento_data_hora DESC NULLS LAST, event_id) = 1)"""


def _latest_decisions(spark, sf_dir) -> DataFrame:
    return events.latest_decisions(
        px.moves_e(spark, sf_dir), _ties(), admitted="purchase", refused="error")


@query("q12_latest_decision", f"""
WITH {_DECISIONS_SQL}
SELECT processo, status, strftime(data_decisao, {STAMP_SQL}) AS data_decisao FROM decisions""")
def q12(spark, sf_dir):
    return _latest_decisions(spark, sf_dir).withColumn("data_decisao", px.stamp(F.col("data_decisao")))


_DAYS = "(epoch_us({b}) - epoch_us({a})) / 86400000000.0"


@query("q14_latest_asof", f"""
WITH {_DECISIONS_SQL}, matched AS (
  SELECT d.processo, d.status, d.data_decisao, max(m.movimento_data_hora) AS data_recebimento
  FROM decisions d JOIN moves_e m ON m.processo = d.processo
  WHERE m.movimento_codigo = 'view' AND m.movimento_data_hora <= d.data_decisao GROUP BY 1, 2, 3)
SELECT processo, status, strftime(data_decisao, {STAMP_SQL}) AS data_decisao,
       strftime(data_recebimento, {STAMP_SQL}) AS data_recebimento,
       round({_DAYS.format(a='data_recebimento', b='data_decisao')}, 6) AS tempo_dias
FROM matched""")
def q14_latest(spark, sf_dir):
    matched = events.receipt_to_latest_decision(
        px.moves_e(spark, sf_dir), _latest_decisions(spark, sf_dir), received="view")
    return matched.drop("ano_mes_decisao").withColumns({
        "data_decisao": px.stamp(F.col("data_decisao")),
        "data_recebimento": px.stamp(F.col("data_recebimento")),
        "tempo_dias": F.round("tempo_dias", 6)})


def _durations(spark, sf_dir) -> DataFrame:
    """Every purchase with the latest view at or before it; status by value; day as period."""
    matched = events.receipt_to_every_decision(
        px.moves_e(spark, sf_dir), F.col("movimento_codigo") == "purchase",
        F.col("movimento_codigo") == "view", _ties())
    return matched.withColumns({
        "status": F.when(F.col("value") > 50, "Admitido").otherwise("Não admitido"),
        "dia": px.day(F.col("data_decisao"))})


_DURATIONS_SQL = f"""{px.MOVES_E_SQL},
purchases AS (SELECT * FROM moves_e WHERE movimento_codigo = 'purchase'),
views AS (SELECT processo, movimento_data_hora AS data_recebimento FROM moves_e WHERE movimento_codigo = 'view'),
durations AS (
  SELECT p.processo, p.event_id, p.movimento_data_hora AS data_decisao, v.data_recebimento,
         CASE WHEN p.value > 50 THEN 'Admitido' ELSE 'Não admitido' END AS status,
         strftime(p.movimento_data_hora, '%Y-%m-%d') AS dia,
         {_DAYS.format(a='v.data_recebimento', b='p.movimento_data_hora')} AS tempo_dias
  FROM purchases p ASOF JOIN views v
    ON p.processo = v.processo AND p.movimento_data_hora >= v.data_recebimento)"""


@query("q14_asof_duration", f"""
WITH {_DURATIONS_SQL}
SELECT processo, event_id, status, strftime(data_decisao, {STAMP_SQL}) AS data_decisao,
       strftime(data_recebimento, {STAMP_SQL}) AS data_recebimento, round(tempo_dias, 6) AS tempo_dias
FROM durations""")
def q14(spark, sf_dir):
    return _durations(spark, sf_dir).select(
        "processo", "event_id", "status", px.stamp(F.col("data_decisao")).alias("data_decisao"),
        px.stamp(F.col("data_recebimento")).alias("data_recebimento"),
        F.round("tempo_dias", 6).alias("tempo_dias"))


@query("q15_duration_stats", f"""
WITH {_DURATIONS_SQL}
SELECT dia, CAST(count(*) AS BIGINT) AS n, round(avg(tempo_dias), 6) AS media_dias,
       round(quantile_cont(tempo_dias, 0.5), 6) AS mediana_dias, round(quantile_cont(tempo_dias, 0.9), 6) AS p90
FROM durations GROUP BY dia""")
def q15(spark, sf_dir):
    stats = panel.duration_stats(_durations(spark, sf_dir), ["dia"])
    return stats.select("dia", "n", *[F.round(c, 6).alias(c) for c in ("media_dias", "mediana_dias", "p90")])


@query("q15b_duration_by_status", f"""
WITH {_DURATIONS_SQL}
SELECT dia, status, CAST(count(*) AS BIGINT) AS n, round(avg(tempo_dias), 6) AS media_dias,
       round(quantile_cont(tempo_dias, 0.5), 6) AS mediana_dias
FROM durations GROUP BY dia, status""")
def q15b(spark, sf_dir):
    stats = panel.duration_stats(_durations(spark, sf_dir), ["dia", "status"], p90=False)
    return stats.select("dia", "status", "n", *[F.round(c, 6).alias(c) for c in ("media_dias", "mediana_dias")])


@query("duration_summary", f"""
WITH {_DURATIONS_SQL}
SELECT 'tempo_dias' AS coluna, CAST(count(*) AS BIGINT) AS n, round(min(tempo_dias), 6) AS minimo,
       round(quantile_cont(tempo_dias, 0.25), 6) AS q1, round(median(tempo_dias), 6) AS mediana,
       round(avg(tempo_dias), 6) AS media, round(quantile_cont(tempo_dias, 0.75), 6) AS q3,
       round(max(tempo_dias), 6) AS maximo
FROM durations""")
def duration_summary(spark, sf_dir):
    summary = profile.column_summary(_durations(spark, sf_dir), ["tempo_dias"])
    return summary.select("coluna", "n", *[F.round(c, 6).alias(c) for c in
                                           ("minimo", "q1", "mediana", "media", "q3", "maximo")])


@query("coverage_ratio", f"""
WITH {_DURATIONS_SQL}
SELECT (SELECT CAST(count(*) AS BIGINT) FROM durations) AS encontrados,
       (SELECT CAST(count(*) AS BIGINT) FROM purchases) AS total,
       round((SELECT count(*) FROM durations) / (SELECT count(*) FROM purchases), 6) AS cobertura""")
def coverage(spark, sf_dir):
    purchases = px.moves_e(spark, sf_dir).filter(F.col("movimento_codigo") == "purchase")
    ratio = profile.coverage_ratio(_durations(spark, sf_dir), purchases)
    return ratio.withColumn("cobertura", F.round("cobertura", 6))


# ---- judge time: a purchase is a judge movement, a view is a conclusion ---------------------

_USER_CASES_SQL = """user_cases AS (
  SELECT CAST(c_custkey AS VARCHAR) AS processo,
         CAST(DATE '1995-01-01' + INTERVAL (c_custkey % 24) MONTH AS DATE) AS mes_ajuizamento,
         CAST(nullif(c_nationkey, 7) AS BIGINT) AS orgao_julgador_codigo
  FROM customer)"""

DELTAS_SQL = f"""{px.MOVES_E_SQL}, {_USER_CASES_SQL},
scanned AS (
  SELECT *, max(CASE WHEN movimento_codigo = 'view' THEN movimento_data_hora END) OVER (
    PARTITION BY processo ORDER BY movimento_data_hora, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS data_conclusao
  FROM moves_e),
deltas AS (
  SELECT s.processo, s.movimento_data_hora, u.mes_ajuizamento, u.orgao_julgador_codigo,
         {_DAYS.format(a='s.data_conclusao', b='s.movimento_data_hora')} AS delta
  FROM scanned s JOIN user_cases u ON s.processo = u.processo
  WHERE s.movimento_codigo = 'purchase' AND s.data_conclusao IS NOT NULL),
pops AS (
  SELECT 'todos' AS populacao, * FROM deltas
  UNION ALL
  SELECT 'especializadas', * FROM deltas WHERE coalesce(orgao_julgador_codigo IN {SPEC_SQL}, FALSE))"""


def _user_cases(spark, sf_dir) -> DataFrame:
    """Customers as the cases of the event users."""
    return px.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("processo"),
        F.add_months(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 24).cast("int")).alias("mes_ajuizamento"),
        F.nullif(F.col("c_nationkey"), F.lit(7)).cast("bigint").alias("orgao_julgador_codigo"))


def _movements(spark, sf_dir) -> DataFrame:
    """Events as movement rows that repeat per complement, brought to one row per movement."""
    moves = px.moves_e(spark, sf_dir)
    complement = F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")))
    return viscosity.one_per_movement(moves.withColumn("complemento", complement), ["processo", "event_id"])


def judge_time_deltas(spark, sf_dir) -> DataFrame:
    code = F.col("movimento_codigo")
    deltas = viscosity.judge_deltas(
        _movements(spark, sf_dir), _ties(), judge=code == "purchase", conclusion=code == "view")
    cases = _user_cases(spark, sf_dir)
    later = cases.withColumn("mes_ajuizamento", F.add_months("mes_ajuizamento", 5))  # the same case, filed again
    return viscosity.with_case_columns(deltas, cases.union(later))


@query("q19_viscosity_total", f"""
WITH {DELTAS_SQL}
SELECT populacao, CAST(count(DISTINCT processo) AS BIGINT) AS processos, CAST(count(*) AS BIGINT) AS decisoes,
       round(sum(delta), 6) AS viscosidade_dias
FROM pops GROUP BY populacao""")
def q19_total(spark, sf_dir):
    totals = viscosity.viscosity_totals(judge_time_deltas(spark, sf_dir), px.SPEC)
    return totals.withColumn("viscosidade_dias", F.round("viscosidade_dias", 6))


@query("q19_cohort_a", f"""
WITH {DELTAS_SQL}
SELECT populacao, strftime(mes_ajuizamento, '%Y-%m-%d') AS mes, CAST(count(*) AS BIGINT) AS decisoes,
       round(sum(delta), 6) AS viscosidade_dias
FROM pops GROUP BY ALL""")
def q19_a(spark, sf_dir):
    cohort = viscosity.viscosity_by_filing_month(judge_time_deltas(spark, sf_dir), px.SPEC)
    return cohort.withColumns({"mes": px.day(F.col("mes")), "viscosidade_dias": F.round("viscosidade_dias", 6)})


@query("q19_cohort_b", f"""
WITH {DELTAS_SQL}
SELECT populacao, strftime(date_trunc('month', movimento_data_hora), '%Y-%m-%d') AS mes,
       CAST(count(*) AS BIGINT) AS decisoes, round(sum(delta), 6) AS viscosidade_dias
FROM pops GROUP BY ALL""")
def q19_b(spark, sf_dir):
    cohort = viscosity.viscosity_by_decision_month(judge_time_deltas(spark, sf_dir), px.SPEC)
    return cohort.withColumns({"mes": px.day(F.col("mes")), "viscosidade_dias": F.round("viscosidade_dias", 6)})


@query("gap_viscosity", f"""
WITH {px.MOVES_E_SQL}, lagged AS (
  SELECT *, lag(movimento_data_hora) OVER (PARTITION BY processo ORDER BY movimento_data_hora, event_id) AS anterior
  FROM moves_e)
SELECT processo, CAST(count(*) AS BIGINT) AS decisoes,
       round(sum({_DAYS.format(a='anterior', b='movimento_data_hora')}), 6) AS viscosidade_dias
FROM lagged WHERE movimento_codigo = 'purchase' AND anterior IS NOT NULL GROUP BY processo""")
def gap_viscosity(spark, sf_dir):
    gaps = events.gap_to_previous(
        _movements(spark, sf_dir), _ties(), F.col("movimento_codigo") == "purchase")
    return events.case_gap_totals(gaps).withColumn("viscosidade_dias", F.round("viscosidade_dias", 6))


@query("bounded_extract", f"""
SELECT event_type, event_id, strftime(ts, {STAMP_SQL}) AS cursor
FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 100""")
def bounded_extract(spark, sf_dir):
    documents = px.table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    rows = events.bounded_extract(documents, "event_type", "ts", "event_id", limit=100)
    return rows.select("event_type", "event_id", px.stamp(F.col("ts")).alias("cursor"))


@query("extract_resumed", f"""
SELECT event_type, event_id, strftime(ts, {STAMP_SQL}) AS cursor,
  CAST(1 + (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 40 AS BIGINT) AS rodada
FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 120""")
def extract_resumed(spark, sf_dir):
    """SC7: three runs of 40, each reading the published cursors of the one before; hours repeat, so ties cross borders."""
    moment = F.col("ts").cast("timestamp")
    documents = px.table(spark, sf_dir, "events").select("event_type", "event_id", moment.alias("ts"))
    root, rounds = shared_dir(spark), []
    for round_ in range(1, 4):
        state = writers.read_published(spark, root) if round_ > 1 else None
        taken, cursors = events.resumed_extract(documents, "event_type", "ts", "event_id", state, limit=40)
        writers.publish(cursors, root)
        rounds.append(taken.withColumn("rodada", F.lit(round_).cast("bigint")))
    rows = reduce(DataFrame.unionByName, rounds)
    return rows.select("event_type", "event_id", px.stamp(F.col("ts")).alias("cursor"), "rodada")


@query("ship_delay", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       round({_DAYS.format(a='o_orderdate', b='l_shipdate')}, 6) AS tempo_dias,
       round({_DAYS.format(a='o_orderdate', b='l_shipdate')} / 365.25, 6) AS anos
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate""")
def ship_delay(spark, sf_dir):
    """TS8, FL6, FL7 on a plain equi-join: non-negative days and years between two tables."""
    orders = px.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("a"))
    lines = px.table(spark, sf_dir, "lineitem").withColumn("b", F.col("l_shipdate").cast("timestamp"))
    joined = lines.join(orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("b") >= F.col("a")))
    days = ts.days_between(F.col("a"), F.col("b"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                         F.round(days, 6).alias("tempo_dias"), F.round(days / 365.25, 6).alias("anos"))
