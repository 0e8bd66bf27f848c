"""Importance resampling towards a target text: hashed n-gram histograms, gains, and a draw by Gumbel scores.

Texts are lower-cased (A-Z only) and pre-tokenised by an untrained Regex Split of the tokenizers library, which returns
words with offsets; windows over the offset pairs are the features. Every feature falls into a CRC-32 bucket, and each
document's buckets are stored once as a table that serves both the histogram and the sums of gains. The histograms and the
gains have one entry per bucket, whatever the corpus.

The rank comes from a stored range partitioning by score, whose partitions of ``RANK_ROWS`` rows are numbered on their own
and moved up by the rows before them; nothing is sorted in one task.

Defined results: a NULL or empty text has no features, weight 0 and no draw; a row without an id has no noise, hence a
NULL score, and is not among the documents drawn from; rows that repeat an id are scored one by one with the same noise;
an empty target only shifts all gains; an empty table gives no rows; other columns do no harm.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from caseflow.llm.common import Scratch, batches, raw

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Documents numbered in one task.
RANK_ROWS = 200_000
#: Feature buckets a worker remembers.
MEMORY = 500_000
#: Fixed value: the words of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Features:
    """Buckets of a text's features: all runs of 1 to ``n`` consecutive words."""

    def __init__(self, n: int, buckets: int) -> None:
        self.n, self.buckets = n, buckets
        self.split = Split(Regex(WORD), "removed", invert=True)
        self.known: dict[str, int] = {}

    def words(self, text: str | None) -> list[str]:
        lowered = raw(text).decode("utf-8", "surrogatepass")
        pairs = [pair for _, pair in self.split.pre_tokenize_str(lowered)]
        return [lowered[start:end] for start, end in pairs]

    def bucket(self, feature: str) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        return found

    def of(self, text: str | None) -> tuple[int, list[int]]:
        words = self.words(text)
        runs = [self.bucket(w) for w in words]
        for size in range(2, self.n + 1):
            runs += [self.bucket(" ".join(words[i:i + size])) for i in range(len(words) - size + 1)]
        return len(words), runs


def _version(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _columns(id_type: str, *own: str) -> str:
    return ", ".join([f"doc {id_type}", "version long", "n_words long", *own])


def bucketed(docs: DataFrame, doc_id: str, text: str, n: int, buckets: int) -> DataFrame:
    """(doc, version, n_words, buckets) of every row."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(n, buckets)
        for batch in batches(rows):
            counts, offsets, parts = [], [0], []
            for whole in batch.column(2):
                words, own = features.of(whole.as_py())
                counts.append(words)
                parts.append(np.array(own, dtype=np.int32))
                offsets.append(offsets[-1] + len(own))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), lists],
                names=["doc", "version", "n_words", "buckets"])

    own = docs.select(F.col(doc_id).alias("doc"), _version(F.col(text)).alias("version"), F.col(text).alias("text"))
    return own.mapInArrow(run, _columns(own.schema["doc"].dataType.simpleString(), "buckets array<int>"))


def histogram(counted: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; every task adds up its own, the driver gets one row per bucket."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches(rows):
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    sums = counted.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed target share over the smoothed source share of each bucket."""
    all_source, all_target, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(((t + 1.0) * (all_source + k)) / ((s + 1.0) * (all_target + k))))
        for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 Gumbel), drawn from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def weighed(counted: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc, version, n_words, n_features, weight, score) of every row."""
    shared = counted.sparkSession.sparkContext.broadcast(gain)  # one entry per bucket

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            lists = batch.column("buckets")
            sizes = np.diff(lists.offsets.to_numpy())
            upto = np.concatenate([[0], np.cumsum(shared.value[lists.flatten().to_numpy()])])
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes.astype(np.int64)), pa.array(upto[ends] - upto[ends - sizes])],
                names=["doc", "version", "n_words", "n_features", "weight"])

    id_type = counted.schema["doc"].dataType.simpleString()
    sums = counted.mapInArrow(run, _columns(id_type, "n_features long", "weight long"))
    return sums.withColumn("score", F.col("weight") + noise(F.col("doc"), seed))


def with_ranks(scored: DataFrame, scratch: Scratch, percent: int, min_words: int, rank_rows: int) -> DataFrame:
    """``scored`` with the rank of drawn rows: the ``percent`` highest scores among documents of ``min_words`` words."""
    enough = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    eligible = scored.filter(enough)
    n = eligible.count()
    drawn = percent * n // 100
    order = [F.desc("score"), F.asc("doc")]
    ordered = scratch.keep("ordered", eligible.repartitionByRange(max(1, -(-n // rank_rows)), *order)
                           .withColumn("part", F.spark_partition_id()))
    # one row per range partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    placed = ordered.join(F.broadcast(starts), "part")
    inside = Window.partitionBy("part").orderBy(*order)
    rank = F.col("start") + F.row_number().over(inside)
    numbered = placed.filter(F.col("start") < drawn).withColumn("rank", rank).withColumn(
        "rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    undrawn = placed.filter(F.col("start") >= drawn).unionByName(
        scored.filter(~enough), allowMissingColumns=True).withColumn("rank", F.lit(None).cast("long"))
    columns = [*scored.columns, "rank"]
    return numbered.select(columns).unionByName(undrawn.select(columns))


def _ranked(
    docs: DataFrame, target: DataFrame, doc_id: str, text: str, n: int = 1, buckets: int = BUCKETS, seed: int = SEED,
    percent: int = PERCENT, min_words: int = MIN_WORDS, rank_rows: int = RANK_ROWS,
) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    counted = scratch.keep("counted", bucketed(docs, doc_id, text, n, buckets))
    wanted = bucketed(target.select(F.lit(0).alias("doc"), F.col(text).alias("text")), "doc", "text", n, buckets)
    gain = gains(histogram(counted, buckets), histogram(wanted, buckets))
    scored = scratch.keep("scored", weighed(counted, gain, seed))
    scratch.drop("counted")
    return with_ranks(scored, scratch, percent, min_words, rank_rows)


def ranked(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(``doc_id``, n_words, n_features, weight, score, rank) of every row of ``docs``; undrawn rows have no rank.

    Options are the sizes above: ``n`` words a feature at most, ``buckets``, ``seed``, ``percent`` drawn of the documents
    of at least ``min_words``, ``rank_rows``.
    """
    return _ranked(docs, target, doc_id, text, **options).drop("version").withColumnRenamed("doc", doc_id)


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs``, whole, with their ``rank`` (rows alike in id and text come with the first of theirs)."""
    ranks = _ranked(docs, target, doc_id, text, **options).filter(F.col("rank").isNotNull())
    best = ranks.groupBy("doc", "version").agg(F.min("rank").alias("rank"))
    same = (F.col(f"d.{doc_id}") == F.col("b.doc")) & (_version(F.col(f"d.{text}")) == F.col("b.version"))
    return docs.drop("rank").alias("d").join(best.alias("b"), same).select("d.*", "b.rank")
