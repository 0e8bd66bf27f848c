"""Rows dealt by range: every stored partition holds a stretch of one global order.

A key with many rows spans several stretches, so whatever is numbered, summed or carried along the order is done inside
each stretch and moved on by one row per stretch. Equal values and equal times are split like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.session import settle

PART = "_part"


def ranged(frame: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """``frame`` with the number of its stretch in ``PART``; checkpointed, as a second run might draw other borders.

    Without ``parts`` their number is Spark's (shuffle partitions, merged by AQE where they are small).
    """
    dealt = frame.repartitionByRange(*([] if parts is None else [max(1, parts)]), *order)
    return settle(dealt.withColumn(PART, F.spark_partition_id()))


def carried_maximum(stretches: DataFrame, key: str, value: Column) -> DataFrame:
    """(PART, _key, _carry): the largest ``value`` of the first key of each stretch in all stretches before it.

    ``stretches`` are ordered by ``key`` first. Only the first key of a stretch can have begun in another one, and there
    it was the last key; so one row per stretch is all that is looked at.
    """
    ends = stretches.groupBy(PART).agg(
        F.min(F.struct(F.col(key).alias("key"))).alias("first"),
        F.max(F.struct(F.col(key).alias("key"), value.alias("value"))).alias("last"))
    told = ends.select(PART, F.col("last.key").alias("_key"), F.lit(1).alias("_kind"), F.col("last.value").alias("_value"))
    nothing = F.lit(None).cast(told.schema["_value"].dataType)
    asked = ends.select(PART, F.col("first.key").alias("_key"), F.lit(0).alias("_kind"), nothing.alias("_value"))
    before = Window.partitionBy("_key").orderBy(PART, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    return (
        asked.unionByName(told).withColumn("_carry", F.max("_value").over(before))
        .filter((F.col("_kind") == 0) & F.col("_carry").isNotNull()).select(PART, "_key", "_carry")
    )
