"""Event logic per case: latest row, last status, flags, as-of durations, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow import constants as k
from caseflow.functions import timestamps as ts
from caseflow.operators.skew import DEFAULT_RULE, HotKeyRule, previous_time, sized
from caseflow.session import settle


def latest_per_key(frame: DataFrame, key: str, time: str, ties: list[Column]) -> DataFrame:
    """WN1: the latest row of each key.

    The ``== 1`` filter lets Spark keep one row per key before the shuffle
    (WindowGroupLimit), so a hot key sends one row per input partition.
    """
    newest = Window.partitionBy(key).orderBy(F.col(time).desc_nulls_last(), *ties)
    return (
        frame.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1).drop("_rank")
    )


def last_status(
    movements: DataFrame, ties: list[Column], final_code: str = str(k.FINAL_JUDGMENT)
) -> DataFrame:
    """WN6/Q11: label of each case's latest movement.

    The study labels the final-judgment code 'sem_transito'; that reading looks
    inverted but is kept, because its tables use it.
    """
    latest = latest_per_key(movements, "processo", "movimento_data_hora", ties)
    return latest.select(
        "processo",
        F.when(F.col("movimento_codigo") == final_code, "sem_transito")
        .when(F.col("movimento_codigo").isNotNull(), "com_transito").alias("transito_status"),
        F.col("movimento_data_hora").alias("transito_data"),
    )


def latest_decisions(
    movements: DataFrame,
    ties: list[Column],
    admitted: str = str(k.ADMITTED),
    refused: str = str(k.NOT_ADMITTED),
) -> DataFrame:
    """Q12: latest admissibility decision of each case."""
    decisions = movements.filter(F.col("movimento_codigo").isin(admitted, refused))
    latest = latest_per_key(decisions, "processo", "movimento_data_hora", ties)
    return latest.select(
        "processo",
        F.when(F.col("movimento_codigo") == admitted, "Admitido").otherwise("Não admitido").alias("status"),
        F.col("movimento_data_hora").alias("data_decisao"),
    )


def with_existence_flag(
    cases: DataFrame, movements: DataFrame, code: str = str(k.FINAL_ARCHIVE),
    out: str = "status_arquivamento_definitivo",
) -> DataFrame:
    """JN5, PJ17: TRUE where the case has a movement of this code, else FALSE."""
    found = (
        movements.filter(F.col("movimento_codigo") == code)
        .select("processo").distinct().withColumn(out, F.lit(True))
    )
    return cases.join(found, "processo", "left").withColumn(out, F.coalesce(out, F.lit(False)))


def cases_with_movement(
    movements: DataFrame, cases: DataFrame, code: str = str(k.LACK_OF_JURISDICTION),
    since: str = "2024-01-01", time_name: str = "data_movimento_incompetencia",
) -> DataFrame:
    """Q6 (JN3): many-to-many; one row per matching movement row and case row."""
    hits = movements.filter(F.col("movimento_codigo") == code).select(
        "processo", F.col("movimento_data_hora").alias(time_name))
    recent = cases.filter(F.col("mes_ajuizamento") >= F.lit(since).cast("date"))
    return hits.join(recent, "processo")


def with_duration(matched: DataFrame) -> DataFrame:
    """TS8, FL7: days from receipt to decision, negative ones dropped; decision month."""
    return matched.withColumns({
        "tempo_dias": ts.days_between(F.col("data_recebimento"), F.col("data_decisao")),
        "ano_mes_decisao": ts.month_start(F.col("data_decisao")),
    }).filter(F.col("tempo_dias") >= 0)


def receipt_to_latest_decision(
    movements: DataFrame, decisions: DataFrame, received: str = str(k.RECEIVED)
) -> DataFrame:
    """JN6/Q14: each case's decision with the latest receipt not after it.

    ``decisions`` has one row per case, so the match is a plain maximum, which
    Spark combines before the shuffle.  Cases without such a receipt drop out.
    """
    receipts = movements.filter(F.col("movimento_codigo") == received).select(
        "processo", F.col("movimento_data_hora").alias("data_recebimento"))
    in_time = receipts.join(decisions, "processo").filter(
        F.col("data_recebimento") <= F.col("data_decisao"))
    matched = in_time.groupBy("processo", "status", "data_decisao").agg(
        F.max("data_recebimento").alias("data_recebimento"))
    return with_duration(matched)


def receipt_to_every_decision(
    movements: DataFrame,
    decision: Column,
    receipt: Column,
    ties: list[Column],
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """JN6 for all decisions: backward as-of match (receipt <= decision) in one shuffle.

    Receipts sort before decisions of the same time, so the nearest earlier
    receipt row is the latest one that is not after the decision.
    """
    relevant = movements.filter(decision | receipt).withColumn("_is_decision", decision)
    matched = previous_time(
        relevant, "processo", "movimento_data_hora", [F.col("_is_decision"), *ties],
        "data_recebimento", when=~F.col("_is_decision"), rule=rule,
    )
    found = matched.filter(F.col("_is_decision") & F.col("data_recebimento").isNotNull())
    return with_duration(
        found.drop("_is_decision").withColumnRenamed("movimento_data_hora", "data_decisao"))


def gap_to_previous(
    movements: DataFrame, ties: list[Column], decision: Column, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """WN4: days since the previous movement of the case, for decision movements."""
    with_previous = previous_time(
        movements, "processo", "movimento_data_hora", ties, "movimento_anterior", rule=rule)
    return with_previous.filter(decision & F.col("movimento_anterior").isNotNull()).withColumn(
        "dias_desde_anterior",
        ts.days_between(F.col("movimento_anterior"), F.col("movimento_data_hora")))


def case_gap_totals(gaps: DataFrame) -> DataFrame:
    """WN4: per case, the summed gaps before its decisions."""
    return gaps.groupBy("processo").agg(
        F.count("*").alias("decisoes"), F.sum("dias_desde_anterior").alias("viscosidade_dias"))


def _cut(dated: DataFrame, group: str, cursor: str, unit: str, taken: str, limit: int) -> DataFrame:
    """Rows up to the time unit in which the limit falls, with ``taken`` rows before and ``_n`` rows in their unit."""
    units = dated.withColumn("_unit", F.date_trunc(unit, cursor))
    earlier = Window.partitionBy(group).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        units.groupBy(group, "_unit").agg(F.count("*").alias("_n"), F.max(taken).alias("_start"))
        .withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .filter(F.col("_before") < limit).drop("_start")
    )
    return units.drop(taken).join(sized(counts), [group, "_unit"]).withColumnRenamed("_before", taken).drop("_unit")


def bounded_extract(documents: DataFrame, group: str, cursor: str, tie: str, limit: int = 200_000) -> DataFrame:
    """SC7: the first ``limit`` rows of each group by (cursor, tie).

    Whole hours before the cut-off hour are taken unranked, then whole seconds
    of that hour. Only the one second per group that the limit falls into is
    ranked, after each partition kept at most ``limit`` of its rows. Rows without
    a cursor or a group are not part of the extract.
    """
    dated = documents.filter(F.col(cursor).isNotNull()).withColumn("_taken", F.lit(0).cast("bigint"))
    fits = F.col("_taken") + F.col("_n") <= limit
    hours = _cut(dated, group, cursor, "hour", "_taken", limit)
    seconds = _cut(hours.filter(~fits).drop("_n"), group, cursor, "second", "_taken", limit)
    last = Window.partitionBy(group).orderBy(cursor, tie)
    ranked = (
        seconds.filter(~fits).withColumn("_rank", F.row_number().over(last))
        .filter(F.col("_rank") <= limit).filter(F.col("_taken") + F.col("_rank") <= limit).drop("_rank")
    )
    whole = hours.filter(fits).unionByName(seconds.filter(fits))
    return whole.unionByName(ranked).select(*documents.columns)


def extract_cursor(rows: DataFrame, group: str, cursor: str, tie: str) -> DataFrame:
    """SC7: where an extract ended, (group, last cursor, last tie), one row per group."""
    last = F.max(F.struct(F.col(cursor).alias("_cursor"), F.col(tie).alias("_tie"))).alias("_last")
    return rows.groupBy(group).agg(last).select(group, "_last._cursor", "_last._tie")


def resumed_extract(
    documents: DataFrame, group: str, cursor: str, tie: str, state: DataFrame | None, limit: int = 200_000,
) -> tuple[DataFrame, DataFrame]:
    """SC7: the next ``limit`` rows of each group after the stored cursors, and the cursors after them.

    Rows that share the last row's time follow it if their tie is larger, so no row is met twice or left out as long as
    (cursor, tie) is unique in a group. A group that gave no rows keeps its cursor; a group without one begins at its
    start. Both results are stored.
    """
    if state is None:
        rest = documents
    else:
        known = sized(state.select(F.col(group).alias("_group"), "_cursor", "_tie"))
        here = F.struct(F.col(cursor).alias("c"), F.col(tie).alias("t"))
        met = (F.col(group) == F.col("_group")) & (F.struct(F.col("_cursor").alias("c"), F.col("_tie").alias("t")) >= here)
        rest = documents.join(known, met, "left_anti")
    taken = settle(bounded_extract(rest, group, cursor, tie, limit))
    cursors = extract_cursor(taken, group, cursor, tie)
    if state is not None:
        cursors = state.select(group, "_cursor", "_tie").unionByName(cursors)
    last = F.max(F.struct("_cursor", "_tie")).alias("_last")
    return taken, settle(cursors.groupBy(group).agg(last).select(group, "_last.*"))
