"""Packing into optimal length buckets.

The histogram of all lengths (one aggregate, combined map-side) goes to a dynamic program that chooses the bucket
boundaries with the least padding. Inside a bucket, batches hold as many documents as the token budget allows.

Every length is counted for itself. The program needs one row per distinct length, and D distinct lengths have at least
D * D / 2 tokens, so their list stays short: under five million rows for 10**13 tokens. As padding costs are Monge (a longer end
costs more for every further document), the best cuts are monotone and the program takes D log D steps per bucket. Batches are
cut inside slices of a bucket: a slice is chosen by a hash of the id and holds about ``SLICE_ROWS`` documents, so that no
bucket, however full, is numbered in one task; each slice leaves at most one batch that is not full.

Defined results: a NULL or empty text has one token (the end); an empty table gives no rows; repeated rows are packed one
by one; a document longer than the budget is a batch of its own; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.common import batches, blank_words, written

BUCKETS = 16
TOKEN_BUDGET = 32_768
SLICE_ROWS = 50_000


def _lengths(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words between ASCII white space, and one end token, of each document."""
    for batch in batches(rows):
        n = [len(blank_words(text)) + 1 for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    best[j]: least padding of the j shortest lengths in the buckets so far; a bucket pads its members to its largest length.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths)[order].astype(float), np.asarray(counts)[order].astype(float)
    n = len(lengths)
    if not n:
        return []
    rows, tokens = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * lengths)]
    best, cut = np.r_[0, np.full(n, np.inf)], []
    for _ in range(min(buckets, n)):
        new, back = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int)
        new[0] = 0
        ranges = [(1, n, 0, n - 1)]  # lengths still to be cut, and where their last cut can lie
        while ranges:
            low, high, first, last = ranges.pop()
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            k = int(np.argmin(cost))
            new[j], back[j] = cost[k], first + k
            if low < j:
                ranges.append((low, j - 1, first, first + k))
            if j < high:
                ranges.append((j + 1, high, first + k, last))
        best = new
        cut.append(back)
    ends, j = [], n
    for back in reversed(cut):
        if j:
            ends.append(int(lengths[j - 1]))
            j = back[j]
    return ends[::-1]


def packed(docs: DataFrame, *, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Per document: n_tokens, bucket, bucket_tokens (padded length), slice, batch, position and padding."""
    lengths = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_lengths, "doc_id long, n_tokens long"))
    histogram = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in histogram)
    ends = optimal_boundaries(
        np.array([r["n_tokens"] for r in histogram]), np.array([r["n"] for r in histogram]), buckets) or [1]
    bucket = F.lit(len(ends) - 1)
    for k in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= ends[k], k).otherwise(bucket)
    width = F.element_at(F.array(*[F.lit(e) for e in ends]), F.col("bucket") + 1).cast("long")
    pieces = -(-total // SLICE_ROWS) or 1
    number = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("doc_id", "n_tokens")) - 1
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens"))).cast("long")
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    return (
        lengths.withColumn("bucket", bucket).withColumn("bucket_tokens", width)
        .withColumn("slice", F.pmod(key, F.lit(pieces)))
        .withColumn("number", number)
        .select(
            "doc_id", "n_tokens", "bucket", "bucket_tokens", "slice",
            F.floor(F.col("number") / fits).cast("long").alias("batch"),
            (F.col("number") % fits).cast("long").alias("position"),
            (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding")))
