"""Monthly panels: counting, completing, pivoting, shares, flows, backlog."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow import constants as k
from caseflow.functions import timestamps as ts
from caseflow.operators.quantiles import quantiles_of_counts, value_counts
from caseflow.session import settle


def specialised(spec: tuple[int, ...] = k.SPECIALISED_COURTS) -> Column:
    """FL2: membership that is FALSE, not NULL, for a missing court code."""
    return F.coalesce(F.col("orgao_julgador_codigo").isin(*spec), F.lit(False))


def in_month_range(column: str, first: str | None, last: str | None = None) -> Column:
    """FL3: UTC date literals on both ends, inclusive."""
    c = F.col(column)
    test = F.lit(True)
    if first:
        test = test & (c >= F.lit(first).cast("date"))
    if last:
        test = test & (c <= F.lit(last).cast("date"))
    return test


def with_court_group(cases: DataFrame, spec: tuple[int, ...]) -> DataFrame:
    """RS5, PJ10: specialised courts keep their name, the others share one label."""
    return cases.withColumn(
        "grupo", F.when(specialised(spec), k.GROUP_SPECIALISED).otherwise(k.GROUP_OTHER)
    ).withColumn(
        "orgao_label",
        F.when(F.col("grupo") == k.GROUP_SPECIALISED, F.col("orgao_julgador_nome"))
        .otherwise(k.GROUPED_COURTS))


def complete_panel(counts: DataFrame, keys: list[str], month: str, first: str, last: str) -> DataFrame:
    """RS1: every key gets every month of the grid (0 if absent); rows outside it stay."""
    grid = counts.select(*keys).distinct().withColumn(
        month, F.explode(ts.month_sequence(first, last)))
    return _add_zeros(grid, counts, [*keys, month])


def _add_zeros(grid: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts plus a 0 for every grid cell: one aggregate, and NULL keys match."""
    zeros = grid.select(*keys, F.lit(0).cast("bigint").alias("n"))
    return zeros.unionByName(counts.select(*keys, "n")).groupBy(*keys).agg(F.sum("n").alias("n"))


def complete_series(counts: DataFrame, month: str, keys: list[str] = ()) -> DataFrame:
    """RS2: fill the months between the first and last of each series with 0."""
    span = counts.groupBy(*keys).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    grid = span.filter(F.col("_a").isNotNull()).select(
        *keys, F.explode(ts.month_sequence(F.col("_a"), F.col("_b"))).alias(month))
    return _add_zeros(grid, counts, [*keys, month])


def months_of(counts: DataFrame, month: str, first: str | None = None, last: str | None = None) -> list[date]:
    """Distinct months of a counted panel, with the grid's, in calendar order.

    One value per calendar month comes to the driver.
    """
    found = {r[0] for r in counts.select(month).distinct().collect() if r[0] is not None}
    if first and last:
        a, b = date.fromisoformat(first), date.fromisoformat(last)
        found |= {date(i // 12, i % 12 + 1, 1)
                  for i in range(a.year * 12 + a.month - 1, b.year * 12 + b.month)}
    return sorted(found)


def pivot_months(counts: DataFrame, keys: list[str], month: str, months: list[date]) -> DataFrame:
    """RS3: one column per month, chronological, 0 where there is no row; a month that isn't listed fails the job."""
    listed = F.col(month).isNull() | F.col(month).isin(months)
    checked = counts.withColumn(month, F.when(listed, F.col(month)).otherwise(
        F.raise_error(F.concat(F.lit("month without a column: "), F.col(month).cast("string"))).cast("date")))
    wide = checked.groupBy(*keys).pivot(month, [m.isoformat() for m in months]).agg(F.sum("n"))
    return wide.na.fill(0)


def unpivot_months(wide: DataFrame, keys: list[str]) -> DataFrame:
    """RS4: back to (keys, mes, n)."""
    months = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(keys, months, "mes", "n")
    return long.withColumn("mes", F.col("mes").cast("date"))


def filings_wide(cases: DataFrame, spec: tuple[int, ...], first: str, last: str) -> DataFrame:
    """Q1: monthly filings, specialised courts by name, the rest as one row."""
    counts = settle(
        with_court_group(cases.filter(in_month_range("mes_ajuizamento", first)), spec)
        .groupBy("grupo", "orgao_label", F.col("mes_ajuizamento").alias("mes")).agg(F.count("*").alias("n"))
    )  # courts x months: read for its months and again for the panel
    keys = ["grupo", "orgao_label"]
    months = months_of(counts, "mes", first, last)
    panel = complete_panel(counts, keys, "mes", first, last)
    return pivot_months(panel, keys, "mes", months).orderBy(*keys)


def filings_long(wide: DataFrame, by: str, first: str, last: str) -> DataFrame:
    """Q2, Q3: the panel in long form, summed by group or by court label."""
    long = unpivot_months(wide, ["grupo", "orgao_label"])
    return (
        long.filter(in_month_range("mes", first, last))
        .groupBy(by, "mes").agg(F.sum("n").alias("n"))
    )


def other_courts(cases: DataFrame, spec: tuple[int, ...], since: str | None = None) -> DataFrame:
    """FL2, FL3: cases of non-specialised courts (a missing court code counts as one)."""
    return cases.filter(~specialised(spec) & in_month_range("mes_ajuizamento", since))


def other_courts_wide(
    cases: DataFrame, spec: tuple[int, ...], since: str, last: str | None = None
) -> DataFrame:
    """Q4: non-specialised courts by month: every month found, and all from ``since`` to ``last`` if that is given."""
    counts = settle(
        other_courts(cases, spec, since)
        .groupBy("orgao_julgador_nome", F.col("mes_ajuizamento").alias("mes")).agg(F.count("*").alias("n"))
    )
    months = months_of(counts, "mes", since if last else None, last)
    return pivot_months(counts, ["orgao_julgador_nome"], "mes", months).orderBy("orgao_julgador_nome")


def other_courts_list(cases: DataFrame, spec: tuple[int, ...], since: str) -> DataFrame:
    """Q5: listing by court and filing time."""
    return other_courts(cases, spec, since).orderBy("orgao_julgador_nome", "data_ajuizamento", "processo")


def flagged_by_month(flagged: DataFrame, time: str = "data_movimento_incompetencia") -> DataFrame:
    """Q7: matching decisions per municipality and month."""
    return (
        flagged.groupBy("municipio_nome", ts.month_start(F.col(time)).alias("mes"))
        .agg(F.count("*").alias("n"))
    )


def backlog_by_court(flagged_cases: DataFrame, spec: tuple[int, ...]) -> DataFrame:
    """Q9 (AG3): filed, archived and active cases per non-specialised court."""
    archived = F.col("status_arquivamento_definitivo")
    return (
        other_courts(flagged_cases, spec).groupBy("orgao_julgador_nome").agg(
            F.count("*").alias("quantidade_processos_ajuizados"),
            F.count_if(archived).alias("quantidade_processos_arquivamento_definitivo"),
            F.count_if(~archived).alias("quantidade_processos_ativos"))
        .orderBy("orgao_julgador_nome")
    )


def monthly_flow(
    cases: DataFrame, movements: DataFrame, spec: tuple[int, ...], first: str, last: str,
    archive_code: str = str(k.FINAL_ARCHIVE), distinct_movements: bool = False,
) -> DataFrame:
    """Q10 (ST1, ST2, JN4): filings as +n, archivings as -n per court and month.

    Movement rows repeat per complement; ``distinct_movements`` counts each
    (case, time) once instead of each row.
    """
    court = ["orgao_julgador_codigo", "orgao_julgador_nome"]
    ours = other_courts(cases, spec)
    filed = (
        ours.groupBy(*court, F.col("mes_ajuizamento").alias("mes")).agg(F.count("*").alias("n"))
        .withColumn("tipo", F.lit("ajuizamento"))
    )
    hits = movements.filter(F.col("movimento_codigo") == archive_code).select(
        "processo", "movimento_data_hora")
    if distinct_movements:
        hits = hits.distinct()
    archived = (
        hits.join(ours.select("processo", *court), "processo")
        .groupBy(*court, ts.month_start(F.col("movimento_data_hora")).alias("mes"))
        .agg((-F.count("*")).alias("n")).withColumn("tipo", F.lit("arquivamento"))
    )
    return filed.unionByName(archived).filter(in_month_range("mes", first, last))


def flow_check(flow: DataFrame) -> DataFrame:
    """AG23: rows and month range per type."""
    return flow.groupBy("tipo").agg(
        F.count("*").alias("linhas"), F.min("mes").alias("min_mes"), F.max("mes").alias("max_mes"))


def monthly_counts(frame: DataFrame, time: str, keys: list[str] = ()) -> DataFrame:
    """TS3, AG1: rows per month (and keys)."""
    return frame.groupBy(*keys, ts.month_start(F.col(time)).alias("mes")).agg(F.count("*").alias("n"))


def share_within(counts: DataFrame, group: str) -> DataFrame:
    """WN2: each row's share of its group's total; the input is already counted."""
    total = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("total", total).withColumn("prop", F.col("n") / F.col("total"))


def status_rate(decisions: DataFrame, status: str, since: str) -> DataFrame:
    """Q16 (FL3, AG1, WN2, FL8): monthly share of one status."""
    recent = decisions.filter(F.col("data_decisao") >= F.lit(f"{since}T00:00:00Z").cast("timestamp"))
    counts = monthly_counts(recent, "data_decisao", ["status"])
    return share_within(counts, "mes").filter(F.col("status") == status)


def duration_stats(durations: DataFrame, keys: list[str], p90: bool = True) -> DataFrame:
    """AG4, AG5: n, mean, median and 90th percentile of the duration per group."""
    counts = value_counts(durations, keys, "tempo_dias")
    basics = counts.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("media_dias"))
    probs = {"mediana_dias": 0.5, **({"p90": 0.9} if p90 else {})}
    return basics.join(quantiles_of_counts(counts, keys, probs), keys)
