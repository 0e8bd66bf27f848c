"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are trigrams of character classes (16 classes, 4,096 trigrams) and binned measures of repetition. Counts are
damped, weighted by inverse document frequency and projected on the leading singular vectors of a bounded
labelled sample (``TRAIN_DOCS`` rows). The sample's vectors and the projection, a few MB whatever the corpus holds, are
broadcast; every document's cosine with every sample vector is computed exactly, block by block, and the labels of the
``NEIGHBOURS`` nearest are weighted by similarity.

Defined results: a NULL or empty text has no terms and gets the sample's share of label 1; without labelled rows every score is
0.5; ties at the last neighbour are broken by the sample's order (hash of the id); repeated rows are scored one by one; other
columns pass through ``accepted`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.common import batches, fold
from caseflow.llm.samples import labelled

TRAIN_DOCS = 4_000
RANK = 48
NEIGHBOURS = 25
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SHARPNESS = 24.0
BLOCK = 256
BINS = 12
MEASURES = 4
TERMS = 4096 + MEASURES * BINS


def _classes() -> bytes:
    """Class of each UTF-8 byte."""
    out = bytearray([13]) * 256
    groups = {1: range(97, 123), 2: range(65, 91), 3: range(48, 58), 4: b" \t", 5: b"\n\r", 6: b".", 7: b",",
              8: b"!?", 9: b"|", 10: b"*#$%&~^", 11: b"-_=+/\\<>@", 12: b"\"'()[]{}", 0: range(128, 256)}
    for number, members in groups.items():
        for byte in members:
            out[byte] = number
    out[:9] = bytes([14]) * 9
    return bytes(out)


_CLASS = _classes()


def terms(text: str | None) -> np.ndarray:
    """Counts of class trigrams and, as soft bins, four measures of repetition."""
    out = np.zeros(TERMS, dtype=np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    c = np.frombuffer(b"\4" + data.translate(_CLASS) + b"\4", np.uint8).astype(np.int32)
    out[:4096] = np.bincount((c[:-2] << 8) + (c[1:-1] << 4) + c[2:], minlength=4096)
    words, lines = data.split(), data.split(b"\n")
    n = max(1, len(words))
    measures = (
        1 - len(set(words)) / n, sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines),
        min(1.0, np.log1p(n) / 10))
    size = np.log1p(len(data))  # a bin weighs as much as a frequent trigram
    for k, value in enumerate(measures):
        place = min(value, 0.999) * (BINS - 1)
        low = int(place)
        out[4096 + k * BINS + low] += size * (1 - place + low)
        out[4096 + k * BINS + low + 1] += size * (place - low)
    return out


class Neighbours:
    """Projection, labelled vectors and their labels."""

    def __init__(self, x: np.ndarray, labels: np.ndarray) -> None:
        """x: term counts of the sample, a row per document."""
        self.idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 0.1).astype(np.float32)
        weighted = self._weighted(x)
        self.projection = self._leading(weighted, min(RANK, len(x), x.shape[1]))
        self.vectors = self._unit(weighted @ self.projection)
        self.labels = labels.astype(np.float64)
        self.prior = float(labels.mean())

    def _weighted(self, x: np.ndarray) -> np.ndarray:
        return self._unit(np.log1p(x) * self.idf)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    @staticmethod
    def _leading(x: np.ndarray, rank: int) -> np.ndarray:
        """Leading right singular vectors by subspace iteration."""
        q = np.random.default_rng(11).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
        for _ in range(6):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, rows = np.linalg.svd(x @ q, full_matrices=False)
        return (q @ rows.T)[:, :rank].astype(np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for start in range(0, len(texts), BLOCK):
            x = np.stack([terms(t) for t in texts[start:start + BLOCK]])
            cosine = self._unit(self._weighted(x) @ self.projection) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.exp(SHARPNESS * (np.take_along_axis(cosine, near, axis=1).astype(np.float64) - 1))
            vote = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
            out[start:start + BLOCK] = np.where(x.any(axis=1), vote, self.prior)
        return out


def _sampled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        found = [terms(t) for t in batch.column("text").to_pylist()]
        where = [np.flatnonzero(x) for x in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array([w.tolist() for w in where], pa.list_(pa.int32())),
             pa.array([x[w].tolist() for x, w in zip(found, where)], pa.list_(pa.float32()))],
            names=["doc_id", "label", "at", "n"])


def train(docs: DataFrame, labels: DataFrame) -> Neighbours | None:
    """The labelled vectors of a bounded sample outside the held-out fold."""
    sample = labelled(docs, labels, "quality", FOLDS, HELD_OUT, TRAIN_DOCS)
    rows = sample.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(
        _sampled, "doc_id long, label int, at array<int>, n array<float>").orderBy(F.xxhash64("doc_id")).collect()
    if not rows:
        return None
    x = np.zeros((len(rows), TERMS), dtype=np.float32)
    for own, row in zip(x, rows):
        own[row["at"]] = row["n"]
    return Neighbours(x, np.array([r["label"] for r in rows]))


def _scores(model, texts: list) -> np.ndarray:
    return np.full(len(texts), 0.5) if model.value is None else model.value.score(texts)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_scores(model, batch.column("text").to_pylist()))],
                names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    schema = to_arrow_schema(docs.schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            keep = _scores(model, batch.column("text").to_pylist()) >= threshold
            yield batch.filter(pa.array(keep)).cast(schema)

    return docs.mapInArrow(run, docs.schema)
