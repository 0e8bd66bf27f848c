"""Joins and scans that stay even: sized lookups, and hot keys split in time.

Spark cannot guess the size of a computed lookup and may shuffle a large table for
it; ``sized`` computes the lookup first and broadcasts it only if it is small.

A window over ``partitionBy(key)`` puts every row of a key into one task.  A key
is *hot* when it has more than ``share`` of all rows (and more than ``floor``),
so there are at most ``1 / share`` hot keys. Their rows are dealt by range and
scanned stretch by stretch, at any place, also between rows of one time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.ranges import PART, carried_maximum, ranged
from caseflow.session import settle


def sized(lookup: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """The lookup, computed once; hinted for broadcast if its rows, as text, have at most ``max_bytes`` bytes.

    A larger one is returned plain: Spark shuffles both sides, and AQE splits hot keys.
    """
    stored = settle(lookup)
    size = stored.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(stored) if size <= max_bytes else stored


@dataclass(frozen=True)
class HotKeyRule:
    share: float = 1 / 10_000   # at most 10,000 keys can exceed this share
    floor: int = 1_000_000      # smaller groups are never worth splitting


DEFAULT_RULE = HotKeyRule()


def hot_keys(frame: DataFrame, key: str, rule: HotKeyRule) -> tuple[DataFrame, int] | None:
    """(the hot keys as ``_hot``, the number of stretches their rows make), or None when no key is hot."""
    counts = frame.groupBy(key).agg(F.count("*").alias("_n"))
    totals = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
    if totals.largest is None:
        return None
    limit = max(rule.floor, int(totals.total * rule.share))
    if totals.largest <= limit:
        return None
    rows = counts.filter(F.col("_n") > limit).collect()  # at most 1 / share rows
    keys = frame.sparkSession.createDataFrame(
        [(r[key],) for r in rows], f"_hot {frame.schema[key].dataType.simpleString()}")
    return keys, -(-sum(r["_n"] for r in rows) // limit)


def stretches_of(frame: DataFrame, key: str, ts: str, ties: list[Column], parts: int) -> DataFrame:
    """The rows dealt by (key, time, ties) and, where these are equal, by the number ``_any``."""
    return ranged(frame.withColumn("_any", F.rand(0)), [F.col(key), F.col(ts), *ties, F.col("_any")], parts)


def previous_time(
    frame: DataFrame,
    key: str,
    ts: str,
    ties: list[Column],
    out: str,
    when: Column | None = None,
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """Adds ``out``: the time of the nearest earlier row of the key that satisfies ``when``.

    "Earlier" follows (ts, ties); rows equal in both come in any order.  Hot keys
    are scanned by stretches of the order; the last qualifying time before a stretch
    is carried into it, one row per stretch.  NULL is a key like any other.  The input
    is read once more to count rows per key, so a dear input should be a table.
    """
    marked = F.col(ts) if when is None else F.when(when, F.col(ts))

    def scanned(rows: DataFrame, group: list[str], order: list[str | Column]) -> DataFrame:
        scan = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.last(marked, ignorenulls=True).over(scan))

    found = hot_keys(frame, key, rule)
    if found is None:
        return scanned(frame, [key], [ts, *ties])
    keys, parts = found
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    calm = scanned(frame.join(F.broadcast(keys), is_hot, "left_anti"), [key], [ts, *ties])
    stretches = stretches_of(frame.join(F.broadcast(keys), is_hot, "left_semi"), key, ts, ties, parts)
    inside = scanned(stretches, [PART, key], [ts, *ties, "_any"])
    carry = carried_maximum(stretches, key, marked).withColumnRenamed(PART, "_from")
    same = (F.col(PART) == F.col("_from")) & F.col(key).eqNullSafe(F.col("_key"))
    busy = (
        inside.join(F.broadcast(carry), same, "left")  # one row per stretch, of which there are 1 / share at most
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .drop(PART, "_any", "_from", "_key", "_carry")
    )
    return calm.unionByName(busy)
