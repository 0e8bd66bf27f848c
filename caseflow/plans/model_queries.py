"""Admission models and series queries (Q17, Q18, ML8-ML11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import timestamps as ts
from caseflow.operators import models, panel, series, viscosity
from caseflow.operators.quantiles import grouped_quantiles
from caseflow.plans import proxies as px
from caseflow.plans.event_queries import DELTAS_SQL, judge_time_deltas
from caseflow.plans.registry import query
from caseflow.session import settle

ORIGIN = "1995-01-01"


def _response(spark, sf_dir) -> DataFrame:
    """Orders as decisions: status F is the admission."""
    decisions = px.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("data_decisao"))
    return models.binary_response(decisions, "F", ORIGIN)


# ---- the two-parameter fit, as unrolled Newton steps in SQL -----------------------------------

_GROUPED_SQL = f"""grouped AS (
  SELECT (epoch_us(o_orderdate) - epoch_us(TIMESTAMP '{ORIGIN}')) / 86400000000.0 / 365.25 AS t,
         CAST(o_orderstatus = 'F' AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS w
  FROM orders GROUP BY 1, 2)"""


def _sums_sql(state: str) -> str:
    return f"""(SELECT any_value(a) AS a, any_value(b) AS b,
      sum(w * (y * (a + b * t) - greatest(a + b * t, 0) - ln(1 + exp(-abs(a + b * t))))) AS ll,
      sum(w * (y - p)) AS ga, sum(w * t * (y - p)) AS gb,
      sum(w * p * (1 - p)) AS v, sum(w * p * (1 - p) * t) AS vt, sum(w * p * (1 - p) * t * t) AS vtt
    FROM (SELECT *, 1 / (1 + exp(-(a + b * t))) AS p FROM grouped, {state}))"""


def _newton_sql(rounds: int = 8) -> str:
    steps = ["n0 AS (SELECT ln(sum(w * y) / sum(w * (1 - y))) AS a, CAST(0 AS DOUBLE) AS b FROM grouped)"]
    for i in range(rounds):
        steps.append(f"""n{i + 1} AS (SELECT a + (vtt * ga - vt * gb) / (v * vtt - vt * vt) AS a,
      b + (v * gb - vt * ga) / (v * vtt - vt * vt) AS b FROM {_sums_sql(f'n{i}')})""")
    steps.append(f"""fit AS (SELECT a, b, ll, v, vt, sqrt(vtt / (v * vtt - vt * vt)) AS sa,
      sqrt(v / (v * vtt - vt * vt)) AS sb FROM {_sums_sql(f'n{rounds}')})""")
    return ",\n".join(steps)


@query("q17_logit_trend", f"""
WITH {_GROUPED_SQL}, {_newton_sql()}
SELECT '(Intercept)' AS termo, round(a, 6) AS estimativa, round(sa, 6) AS erro_padrao, round(a / sa, 6) AS z,
       round(-2 * ll, 6) AS deviance, round(-2 * ll + 4, 6) AS aic FROM fit
UNION ALL
SELECT 't', round(b, 6), round(sb, 6), round(b / sb, 6), round(-2 * ll, 6), round(-2 * ll + 4, 6) FROM fit""")
def q17_trend(spark, sf_dir):
    fit = models.fit_trend(_response(spark, sf_dir))
    return models.coefficient_table(spark, fit).select(
        "termo", *[F.round(c, 6).alias(c) for c in ("estimativa", "erro_padrao", "z")],
        F.round(F.lit(fit.deviance), 6).alias("deviance"), F.round(F.lit(fit.aic), 6).alias("aic"))


def _profile_sql(end: str, sign: str, rounds: int = 10) -> str:
    target = f"(SELECT ll - {models.CHI2_95 / 2!r} FROM fit)"
    shift = f"({sign} {models.NORMAL_975!r} * sb)"
    steps = [f"{end}0 AS (SELECT a - vt / v * {shift} AS a, b + {shift} AS b FROM fit)"]
    for i in range(rounds):
        # [[-v, -vt], [ga, gb]] * step = -[ga, ll - target]
        steps.append(f"""{end}{i + 1} AS (SELECT
      a + (-ga * gb - vt * (ll - {target})) / (vt * ga - v * gb) AS a,
      b + (v * (ll - {target}) + ga * ga) / (vt * ga - v * gb) AS b FROM {_sums_sql(f'{end}{i}')})""")
    return ",\n".join(steps)


@query("q17_odds_ci", f"""
WITH {_GROUPED_SQL}, {_newton_sql()}, {_profile_sql('low', '-')}, {_profile_sql('high', '')}
SELECT round(exp(f.b), 6) AS razao_chances, round(exp(low10.b), 6) AS perfil_inf, round(exp(high10.b), 6) AS perfil_sup,
  round(exp(f.b - {models.NORMAL_975!r} * sb), 6) AS wald_inf, round(exp(f.b + {models.NORMAL_975!r} * sb), 6) AS wald_sup
FROM fit f, low10, high10""")
def q17_odds(spark, sf_dir):
    data = _response(spark, sf_dir)
    table = models.odds_table(spark, data, models.fit_trend(data))
    return table.select(*[F.round(c, 6).alias(c) for c in table.columns])


@query("q17_response", """
SELECT round((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-01-01')) / 86400000000.0 / 365.25, 6) AS t,
       CAST(o_orderstatus = 'F' AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS peso
FROM orders GROUP BY 1, 2""")
def q17_response(spark, sf_dir):
    return _response(spark, sf_dir).withColumn("t", F.round("t", 6))


@query("q17_spline_knots", f"""
WITH rows_ AS (SELECT (epoch_us(o_orderdate) - epoch_us(TIMESTAMP '{ORIGIN}')) / 86400000000.0 / 365.25 AS t FROM orders)
""" + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS no, round(quantile_cont(t, {i / 5}), 6) AS t FROM rows_" for i in range(6)))
def q17_knots(spark, sf_dir):
    knots = models.spline_knots(_response(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(knots)), "no bigint, t double").withColumn("t", F.round("t", 6))


# the six-parameter and breakpoint fits have no SQL twin; tests check them by brute force


@query("q17_spline")
def q17_spline(spark, sf_dir):
    data = _response(spark, sf_dir)
    return models.coefficient_table(spark, models.fit_spline(data, models.spline_knots(data)))


@query("q17_aic")
def q17_aic(spark, sf_dir):
    data = _response(spark, sf_dir)
    return models.fit_table(spark, models.fit_trend(data), models.fit_spline(data, models.spline_knots(data)))


@query("q17_grid")
def q17_grid(spark, sf_dir):
    data = _response(spark, sf_dir)
    knots = models.spline_knots(data)
    return models.prediction_grid(data, models.fit_spline(data, knots), knots, ORIGIN)


@query("q17_segmented")
def q17_segmented(spark, sf_dir):
    return models.segmented_table(spark, models.fit_segmented(_response(spark, sf_dir)))


# ---- series ------------------------------------------------------------------------------------


def _court_series(spark, sf_dir) -> DataFrame:
    counts = panel.monthly_counts(px.cases(spark, sf_dir), "data_ajuizamento", ["orgao_julgador_nome"])
    return panel.complete_series(counts, "mes", ["orgao_julgador_nome"])


# STL with a fixed yearly pattern as plain joins, for series of two years and more: in every round the loess line of each
# calendar month's own values, less a smoothed triple moving average, is the seasonal part; the loess line of the rest is the trend


def _line_at_sql(out: str, source: str, at: str, group: str, window: str, degree: int) -> str:
    """Local line of degree 0 or 1 of ``source`` (group, i, n, v) at the positions p of ``at``."""
    tilt = """+ CASE WHEN sqrt(greatest(sxx / sw - pow(sx / sw, 2), 0)) > 0.001 * greatest(n - 1, 1)
        THEN (p - sx / sw) / (sxx / sw - pow(sx / sw, 2)) * (sxy / sw - sx / sw * sy / sw) ELSE 0 END""" if degree else ""
    return f"""
{out}_d AS (SELECT {group}, a.p, s.i, s.n, s.v, abs(a.p - s.i) AS d FROM {at} a JOIN {source} s USING ({group})),
{out}_h AS (SELECT {group}, p, list_sort(list(d))[least({window}, any_value(n))::BIGINT]
              + greatest({window} - any_value(n), 0) // 2 AS h FROM {out}_d GROUP BY {group}, p),
{out}_w AS (SELECT {group}, p, i, n, v, CASE WHEN d > 0.999 * h THEN 0 WHEN d <= 0.001 * h THEN 1
              ELSE pow(1 - pow(d / h, 3), 3) END AS w FROM {out}_d JOIN {out}_h USING ({group}, p)),
{out}_s AS (SELECT {group}, p, any_value(n) AS n, sum(w) AS sw, sum(w * i) AS sx, sum(w * i * i) AS sxx, sum(w * v) AS sy,
              sum(w * i * v) AS sxy FROM {out}_w GROUP BY {group}, p),
{out} AS (SELECT {group}, p, sy / sw {tilt} AS f FROM {out}_s)"""


def _stepped_sql(out: str, source: str, window: int) -> str:
    """A line of degree 1 at every second point and the last; the points between are halfway."""
    return f"""
{out}_at AS (SELECT serie, i AS p FROM {source} WHERE i % 2 = 0 OR i = n - 1),
{_line_at_sql(f'{out}_f', source, f'{out}_at', 'serie', str(window), 1)},
{out} AS (SELECT s.serie, s.i, coalesce(f.f, (b.f + a.f) / 2) AS f FROM {source} s
  LEFT JOIN {out}_f f ON f.serie = s.serie AND f.p = s.i
  LEFT JOIN {out}_f b ON b.serie = s.serie AND b.p = s.i - 1 LEFT JOIN {out}_f a ON a.serie = s.serie AND a.p = s.i + 1)"""


def _average_sql(out: str, source: str, length: int) -> str:
    frame = f"OVER (PARTITION BY serie ORDER BY j ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING)"
    return f"""{out} AS (SELECT serie, j, v FROM (
  SELECT serie, j, avg(v) {frame} AS v, count(*) {frame} AS c FROM {source}) WHERE c = {length})"""


def _stl_sql(rows: str, key: str, month: str, value: str) -> str:
    """``parts`` (key, month, observed, trend, seasonal, remainder) of gap-free monthly series of at least two years."""
    steps = [f"""series_ AS (SELECT {key} AS serie, {month} AS mes, {value}::DOUBLE AS y, count(*) OVER (PARTITION BY {key}) AS n,
      row_number() OVER (PARTITION BY {key} ORDER BY {month}) - 1 AS i FROM {rows}),
    trend0 AS (SELECT serie, i, 0::DOUBLE AS f FROM series_)"""]
    for r in (1, 2):
        steps.append(f"""
cycle{r} AS (SELECT s.serie, s.i % 12 AS fase, s.i // 12 AS i, y - t.f AS v, s.n AS total,
               count(*) OVER (PARTITION BY s.serie, s.i % 12) AS n
             FROM series_ s JOIN trend{r - 1} t ON s.serie = t.serie AND s.i = t.i WHERE s.n >= 24),
cycle{r}_at AS (SELECT DISTINCT serie, fase, unnest(range(-1, n + 1)) AS p FROM cycle{r}),
{_line_at_sql(f'cycle{r}_f', f'cycle{r}', f'cycle{r}_at', 'serie, fase', '(10 * any_value(total) + 1)', 0).replace(
    's.n, s.v', 's.n, s.v, s.total')},
wide{r} AS (SELECT serie, fase + 12 * (p + 1) AS j, f AS v FROM cycle{r}_f),
{_average_sql(f'once{r}', f'wide{r}', 12)}, {_average_sql(f'twice{r}', f'once{r}', 12)}, {_average_sql(f'thrice{r}', f'twice{r}', 3)},
slow{r} AS (SELECT serie, j AS i, v, count(*) OVER (PARTITION BY serie) AS n FROM thrice{r}),
{_stepped_sql(f'low{r}', f'slow{r}', 13)},
season{r} AS (SELECT w.serie, l.i, w.v - l.f AS f FROM wide{r} w JOIN low{r} l ON w.serie = l.serie AND w.j = l.i + 12),
rest{r} AS (SELECT s.serie, s.i, s.n, s.y - q.f AS v FROM series_ s JOIN season{r} q ON s.serie = q.serie AND s.i = q.i),
{_stepped_sql(f'trend{r}', f'rest{r}', 19)}""")
    steps.append("""
pattern AS (SELECT serie, i, avg(f) OVER (PARTITION BY serie, i % 12) AS f FROM season2),
parts AS (SELECT s.serie, s.mes, s.y AS observed, t.f AS trend, p.f AS seasonal, s.y - t.f - p.f AS remainder
  FROM series_ s LEFT JOIN trend2 t ON s.serie = t.serie AND s.i = t.i LEFT JOIN pattern p ON s.serie = p.serie AND s.i = p.i)""")
    return ",\n".join(steps)


_LONG_PARTS_SQL = " UNION ALL ".join(
    f"SELECT serie, strftime(mes, '%Y-%m-%d') AS data, '{c}' AS componente, round({c}, 6) AS valor FROM parts"
    for c in ("observed", "trend", "seasonal", "remainder"))

_COURT_SERIES_SQL = f"""{px.CASES_SQL},
counted AS (SELECT orgao_julgador_nome AS vara, CAST(date_trunc('month', data_ajuizamento) AS DATE) AS mes, count(*) AS k
            FROM cases GROUP BY 1, 2),
grid AS (SELECT vara, CAST(unnest(generate_series(min(mes), max(mes), INTERVAL 1 MONTH)) AS DATE) AS mes FROM counted GROUP BY 1),
monthly AS (SELECT vara, mes, coalesce(k, 0) AS k FROM grid LEFT JOIN counted USING (vara, mes))"""


def _long_parts(parts: DataFrame, key: str) -> DataFrame:
    return parts.select(F.col(key).alias("serie"), px.day(F.col("data")).alias("data"), "componente",
                        F.round("valor", 6).alias("valor"))


@query("q18_stl", f"""
WITH {_COURT_SERIES_SQL}, {_stl_sql('monthly', 'vara', 'mes', 'k')}
{_LONG_PARTS_SQL}""")
def q18_stl(spark, sf_dir):
    return _long_parts(series.decompose(_court_series(spark, sf_dir), "orgao_julgador_nome"), "orgao_julgador_nome")


@query("q18_stl_sum", f"""
WITH {px.CASES_SQL}
SELECT orgao_julgador_nome, CAST(count(*) AS DOUBLE) AS observado, CAST(count(*) AS DOUBLE) AS soma_partes
FROM cases GROUP BY 1""")
def q18_stl_sum(spark, sf_dir):
    """Trend, seasonal and remainder add up to the observed series."""
    parts = series.decompose(_court_series(spark, sf_dir), "orgao_julgador_nome")
    observed = F.col("componente") == "observed"
    return parts.groupBy("orgao_julgador_nome").agg(
        F.round(F.sum(F.when(observed, F.col("valor"))), 6).alias("observado"),
        F.round(F.sum(F.when(~observed, F.col("valor"))), 6).alias("soma_partes"))


@query("q19_decomposition", f"""
WITH {DELTAS_SQL},
cohorts AS (
  SELECT 'ajuizamento:' || populacao AS vara, mes_ajuizamento AS mes, sum(delta) AS k FROM pops GROUP BY 1, 2
  UNION ALL
  SELECT 'decisao:' || populacao, CAST(date_trunc('month', movimento_data_hora) AS DATE), sum(delta) FROM pops GROUP BY 1, 2),
grid AS (SELECT vara, CAST(unnest(generate_series(min(mes), max(mes), INTERVAL 1 MONTH)) AS DATE) AS mes FROM cohorts GROUP BY 1),
monthly AS (SELECT vara, mes, coalesce(k, 0) AS k FROM grid LEFT JOIN cohorts USING (vara, mes)),
{_stl_sql('monthly', 'vara', 'mes', 'k')}
{_LONG_PARTS_SQL}""")
def q19_decomposition(spark, sf_dir):
    """Judge time by filing month and by decision month, decomposed."""
    deltas = settle(judge_time_deltas(spark, sf_dir))
    return _long_parts(viscosity.decomposed_cohorts(
        viscosity.viscosity_by_filing_month(deltas, px.SPEC), viscosity.viscosity_by_decision_month(deltas, px.SPEC)), "serie")


def _admission_rate(spark, sf_dir) -> DataFrame:
    decisions = px.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("data_decisao"))
    return panel.status_rate(decisions, "F", "1995-01-01")


# local quadratic fit in SQL: nearest-q bandwidth, tricube weights, 3x3 normal equations
def _loess_sql(rows: str, span: float, out: str) -> str:
    return f"""
q AS (SELECT greatest(least(CAST(floor(count(*) * {span} + 1e-5) AS BIGINT), count(*)), 3) AS q FROM {rows}),
dist AS (SELECT a.serie, a.x AS x0, b.x, b.y, b.w, abs(b.x - a.x) AS d,
                row_number() OVER (PARTITION BY a.serie, a.x ORDER BY abs(b.x - a.x)) AS k
         FROM {rows} a JOIN {rows} b ON a.serie = b.serie),
reach AS (SELECT serie, x0, max(d) FILTER (WHERE k <= (SELECT q FROM q)) AS h FROM dist GROUP BY 1, 2),
weighted AS (SELECT d.serie, d.x0, (d.x - d.x0) / r.h AS u, d.y, d.w * pow(1 - pow(least(d.d / r.h, 1), 3), 3) AS k
             FROM dist d JOIN reach r ON d.serie = r.serie AND d.x0 = r.x0),
m AS (SELECT serie, x0, sum(k) AS s0, sum(k*u) AS s1, sum(k*u*u) AS s2, sum(k*u*u*u) AS s3, sum(k*u*u*u*u) AS s4,
             sum(k*y) AS t0, sum(k*u*y) AS t1, sum(k*u*u*y) AS t2 FROM weighted GROUP BY 1, 2),
{out} AS (SELECT serie, x0, (t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2))
     / (s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2)) AS ajuste FROM m)"""


# rows of the smoother: how each month adds to the fit at another one; their trace and sums of squares give the errors
_LOESS_ERRORS_SQL = """
entries AS (SELECT w.x0, d.x, p.w, w.k * ((s2*s4-s3*s3) + w.u * (s3*s2-s1*s4) + w.u*w.u * (s1*s3-s2*s2))
     / (s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2)) AS l
  FROM (SELECT d.serie, d.x0, d.x, (d.x - d.x0) / r.h AS u, d.w * pow(1 - pow(least(d.d / r.h, 1), 3), 3) AS k
        FROM dist d JOIN reach r ON d.serie = r.serie AND d.x0 = r.x0) w
  JOIN m ON m.x0 = w.x0 JOIN dist d ON d.x0 = w.x0 AND d.x = w.x JOIN pts p ON p.x = w.x),
norms AS (SELECT x0, sum(l * l) AS squares, sum(l * l / w) AS spread, sum(CASE WHEN x = x0 THEN l ELSE 0 END) AS own
          FROM entries GROUP BY x0),
scale2 AS (SELECT sum(p.w * pow(p.y - s.ajuste, 2)) / (count(*) - 2 * sum(n.own) + sum(n.squares)) AS s2
           FROM pts p JOIN smoothed s ON s.x0 = p.x JOIN norms n ON n.x0 = p.x)"""


_RATE_POINTS_SQL = """rate AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) FILTER (WHERE o_orderstatus = 'F') AS k,
                     count(*) AS total FROM orders GROUP BY 1),
pts AS (SELECT 'F' AS serie, CAST(m AS DATE) AS m, CAST(date_diff('day', min(CAST(m AS DATE)) OVER (), CAST(m AS DATE)) AS DOUBLE) AS x,
               k / total AS y, CAST(total AS DOUBLE) AS w FROM rate WHERE k > 0)"""


@query("q18_loess", f"""
WITH {_RATE_POINTS_SQL},
{_loess_sql('pts', 0.3, 'smoothed')}
SELECT 'F' AS status, strftime(p.m, '%Y-%m-%d') AS data, round(p.y, 6) AS observado, round(s.ajuste, 6) AS ajuste
FROM pts p JOIN smoothed s ON s.x0 = p.x""")
def q18_loess(spark, sf_dir):
    """Smoothed monthly admission rate, span 0.3, months weighted by their size."""
    line = series.smooth(_admission_rate(spark, sf_dir), "status", "mes", "prop", span=0.3, weight="total", surface="direct")
    return line.select("status", px.day(F.col("data")).alias("data"), F.round("observado", 6).alias("observado"),
                       F.round("ajuste", 6).alias("ajuste"))


@query("q18_loess_se", f"""
WITH {_RATE_POINTS_SQL},
{_loess_sql('pts', 0.3, 'smoothed')}, {_LOESS_ERRORS_SQL}
SELECT strftime(p.m, '%Y-%m-%d') AS data, round(s.ajuste, 6) AS ajuste, round(sqrt(s2 * n.spread), 6) AS erro_padrao
FROM pts p JOIN smoothed s ON s.x0 = p.x JOIN norms n ON n.x0 = p.x, scale2""")
def q18_loess_se(spark, sf_dir):
    """The line fitted at every month, with its standard errors."""
    line = series.smooth(_admission_rate(spark, sf_dir), "status", "mes", "prop", span=0.3, weight="total", surface="direct")
    return line.select(px.day(F.col("data")).alias("data"), F.round("ajuste", 6).alias("ajuste"),
                       F.round("erro_padrao", 6).alias("erro_padrao"))


@query("q18_loess_errors")
def q18_loess_errors(spark, sf_dir):
    """The same line with its standard errors, and one line per court at the default span."""
    rate = series.smooth(_admission_rate(spark, sf_dir), "status", "mes", "prop", span=0.3, weight="total")
    courts = series.smooth(_court_series(spark, sf_dir), "orgao_julgador_nome", "mes", "n")
    return rate.withColumnRenamed("status", "serie").unionByName(
        courts.withColumnRenamed("orgao_julgador_nome", "serie"))


# ---- distributions of event times ----------------------------------------------------------------

_DAYS_SQL = "points_ AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 86400000000.0 AS x FROM events)"


def _event_days(spark, sf_dir) -> DataFrame:
    start = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    return px.table(spark, sf_dir, "events").select(
        ts.days_between(start, F.col("ts").cast("timestamp")).alias("x"))


@query("hist_100", f"""
WITH {_DAYS_SQL}, ends AS (SELECT min(x) AS lo, (max(x) - min(x)) / 99 AS w FROM points_),
placed AS (SELECT CAST(least(greatest(ceil((x - lo) / w - 0.5), 0), 99) AS BIGINT) AS faixa, count(*) AS n
           FROM points_, ends GROUP BY 1)
SELECT CAST(i AS BIGINT) AS faixa, round(lo + i * w, 6) AS centro, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM unnest(generate_series(0, 99)) AS t(i), ends LEFT JOIN placed ON faixa = i""")
def hist_100(spark, sf_dir):
    bars = series.histogram(_event_days(spark, sf_dir), "x")
    return bars.select(F.col("faixa").cast("bigint").alias("faixa"), F.round("centro", 6).alias("centro"), "n")


@query("kde_grid", f"""
WITH {_DAYS_SQL}, stats AS (
  SELECT count(*) AS n, min(x) AS lo, max(x) AS hi,
    0.9 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) * pow(count(*), -0.2) AS bw
  FROM points_),
grid AS (SELECT *, lo - 4 * bw AS a, (hi - lo + 8 * bw) / 511 AS cell FROM stats),
halves AS (SELECT floor((x - a) / cell) AS i, sum(1 - ((x - a) / cell - floor((x - a) / cell))) AS ma,
                  sum((x - a) / cell - floor((x - a) / cell)) AS mb
           FROM points_, grid GROUP BY 1),
mass AS (SELECT i, sum(m) AS m FROM (SELECT i, ma AS m FROM halves UNION ALL SELECT i + 1, mb FROM halves) GROUP BY i),
cells AS (SELECT j, sum(m * exp(-pow((j - i) * cell / bw, 2) / 2)) / any_value(n * bw * sqrt(2 * pi())) AS d
          FROM unnest(generate_series(0, 511)) AS t(j), mass, grid GROUP BY j),
points_out AS (SELECT lo + k * (hi - lo) / 511 AS x, (lo + k * (hi - lo) / 511 - a) / cell AS p
               FROM unnest(generate_series(0, 511)) AS t(k), grid)
SELECT round(x, 6) AS x, round(c0.d + (coalesce(c1.d, c0.d) - c0.d) * (p - floor(p)), 6) AS densidade
FROM points_out JOIN cells c0 ON c0.j = floor(p) LEFT JOIN cells c1 ON c1.j = floor(p) + 1""")
def kde_grid(spark, sf_dir):
    days = _event_days(spark, sf_dir)
    spread = days.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd")).first()
    quartiles = grouped_quantiles(
        days.withColumn("_all", F.lit(1)), ["_all"], "x", {"q1": 0.25, "q3": 0.75}).first()
    bandwidth = series.rule_of_thumb_bandwidth(spread.n, spread.sd, quartiles.q1, quartiles.q3)
    density = series.kernel_density(days, "x", bandwidth)
    return density.select(F.round("x", 6).alias("x"), F.round("densidade", 6).alias("densidade"))
