"""Bounded samples of labelled rows, the only rows classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import fold


def labelled(docs: DataFrame, labels: DataFrame, target: str, folds: int, held_out: int, size: int) -> DataFrame:
    """(doc_id, text, label) of at most ``size`` labelled documents outside the held-out fold.

    The documents are those with the smallest hash of their id, so any input order gives the same sample. The
    sample's ids are broadcast (``size`` rows at most).
    """
    usable = labels.select("doc_id", F.col(target).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", folds) != held_out))
    one = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = one.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(size)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
