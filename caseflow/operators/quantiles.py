"""Exact interpolated quantiles per group without holding a group in one task.

Spark's ``percentile`` keeps a value->count map of the whole group in memory.
Here equal values are counted first and the counts are dealt by range, so that a
group of any shape (long tails, outliers, one dense spot) spreads over as many
stretches as its distinct values need. The sums of the stretches tell which of them
hold the wanted ranks; only those are ranked, each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.ranges import PART, ranged
from caseflow.session import settle


def value_counts(frame: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows per (keys, value): keys, ``_v``, ``_n``.

    Checkpointed: the quantile search reads the counts more than once, and what
    they are computed from may be a whole as-of match.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    return settle(
        frame.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v")).agg(n.alias("_n"))
    )


def wanted_stretches(stretches: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """The counts of the stretches that hold a wanted rank, with the weight ``_before`` them and the ranks ``_wanted``."""
    ordered = Window.partitionBy(*keys).orderBy(PART)  # one row per stretch of a group
    sums = (
        stretches.groupBy(*keys, PART).agg(F.sum("_n").alias("_inside"))
        .withColumn("_upto", F.sum("_inside").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_inside").over(Window.partitionBy(*keys)))
        .withColumn("_before", F.col("_upto") - F.col("_inside"))
    )
    ranks = F.array(*[
        F.struct(F.lit(name).alias("name"), F.floor(rank).alias("lo"), F.ceil(rank).alias("hi"), (rank - F.floor(rank)).alias("part"))
        for name, rank in ((name, (F.col("_total") - 1) * F.lit(float(p))) for name, p in probs.items())])

    def held(q: Column) -> Column:
        return ((q["lo"] >= F.col("_before")) & (q["lo"] < F.col("_upto"))) | (
            (q["hi"] >= F.col("_before")) & (q["hi"] < F.col("_upto")))

    targets = sums.withColumn("_wanted", F.filter(ranks, held)).filter(F.size("_wanted") > 0)
    return stretches.join(targets.select(*keys, PART, "_before", "_wanted"), [*keys, PART])


def quantiles_of_counts(counts: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation (type 7) quantiles of counted values, one column per name."""
    stretches = ranged(counts.select(*keys, "_v", "_n"), [*map(F.col, keys), F.col("_v")])
    inside = Window.partitionBy(*keys, PART).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        wanted_stretches(stretches, keys, probs)
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .select(*keys, "_v", "_start", "_end", F.explode("_wanted").alias("_q"))
    )

    def at(rank: str) -> Column:
        here = (F.col(f"_q.{rank}") >= F.col("_start")) & (F.col(f"_q.{rank}") < F.col("_end"))
        return F.max(F.when(here, F.col("_v")))

    points = ranked.groupBy(*keys, F.col("_q.name").alias("_name")).agg(
        at("lo").alias("_vlo"), at("hi").alias("_vhi"), F.max("_q.part").alias("_share"))
    value = F.when(F.col("_vlo") == F.col("_vhi"), F.col("_vlo")).otherwise(
        F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_share"))
    return points.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, value)).alias(name) for name in probs])


def grouped_quantiles(
    frame: DataFrame, keys: list[str], value: str, probs: dict[str, float], weight: str | None = None,
) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys`` (which must not be NULL)."""
    return quantiles_of_counts(value_counts(frame, keys, value, weight), keys, probs)
