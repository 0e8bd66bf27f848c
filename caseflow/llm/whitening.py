"""Whitening of embeddings: blockwise QR of the centred rows, and singular values and vectors of the triangle that is left.

Entries become whole numbers (floor(64 c) + 1000000), so counts and sums are exact. Every task reduces its centred rows to one
d x d triangle, block by block; triangles are merged 16 at a time, so no task holds more than that and the driver gets one.
``bidiagonal.singular`` gives the eigenvectors of the covariance from it, without ever forming the covariance.

Defined results: rows whose vector is NULL, empty or holds NULL or non-finite entries are dropped, and so are those with an
entry whose whole number doesn't fit a double exactly, and vectors of another length than most rows have (ties: the longer
length); a NULL id stays NULL; repeated rows count each; a component without variance (under 1e-20 of the first one) cannot be
whitened and is left out, so equal vectors, or a table with none, give no rows; a deviation beyond 64 bits is NULL; other
columns pass through unless named like a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.bidiagonal import singular
from caseflow.llm.common import Scratch, batches

COMPONENTS = 32
#: Grid of the contract.
GRID, ORIGIN = 64, 1_000_000
#: Triangles merged in one task.
FAN_IN = 16
#: Components under this share of the first one's variance are rounding noise.
LEAST_SHARE = 1e-20
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    """What a fit keeps: rows, sums per dimension, component directions (columns), their variances, the total variance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def base(self) -> np.ndarray:
        """Whole numbers next to the means: rows minus these are small and exact."""
        return np.array([round(s / self.n) for s in self.sums], dtype=np.int64)

    def rest(self) -> np.ndarray:
        """What the means have beyond the base, times n; exact."""
        return np.array([s - self.n * int(b) for s, b in zip(self.sums, self.base())], dtype=np.int64)


def whole_numbers(vectors: pa.ListArray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """(usable rows as a mask, [(length, whole numbers)]): each length's usable rows, in order."""
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, dtype=np.int64)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL entries become NaN
    with np.errstate(over="ignore", invalid="ignore"):
        grid = np.floor(values * GRID)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(grid) < _EXACT))])
    usable = valid & (bad[offsets[1:]] == bad[offsets[:-1]])
    out = []
    for length in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == length))
        out.append((int(length), grid[offsets[rows][:, None] + np.arange(length)].astype(np.int64) + ORIGIN))
    return usable, out


def _sums(vectors: DataFrame) -> DataFrame:
    """(length, n, sums) once per task and length."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches(rows):
            for length, x in whole_numbers(batch.column(0))[1]:
                old = totals.setdefault(length, [0, np.zeros(length, dtype=np.int64)])
                old[0] += len(x)
                old[1] += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t[0] for t in totals.values()], pa.int64()),
             pa.array([t[1].tolist() for t in totals.values()], pa.list_(pa.int64()))], names=["length", "n", "sums"])

    return vectors.mapInArrow(run, "length int, n long, sums array<long>")


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.base()) - model.rest() / model.n


def _triangle(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(stack), mode="r")


def _triangles(vectors: DataFrame, shared, length: int) -> DataFrame:
    """(node, triangle): what is left of each task's centred rows."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = np.zeros((0, length))
        for batch in batches(rows):
            for own, x in whole_numbers(batch.column(0))[1]:
                if own == length:
                    triangle = _triangle([triangle, _centred(x, shared.value)])
        if len(triangle):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([triangle.tobytes()], pa.binary())],
                names=["node", "triangle"])

    return vectors.mapInArrow(run, "node long, triangle binary")


def _merged(nodes: DataFrame, length: int) -> DataFrame:
    """One triangle for each ``FAN_IN`` nodes."""
    def merge(table: pa.Table) -> pa.Table:
        stack = [np.frombuffer(t, dtype=float).reshape(-1, length) for t in table["triangle"].to_pylist()]
        return pa.table({"node": pa.array([table["group"][0].as_py()], pa.int64()),
                         "triangle": pa.array([_triangle(stack).tobytes()], pa.binary())})

    grouped = nodes.withColumn("group", F.floor(F.col("node") / FAN_IN)).groupBy("group")
    return grouped.applyInArrow(merge, "node long, triangle binary")


def fitted(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The fit over all usable rows; None where there are none."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(vector).alias("vector"))
    scratch = Scratch(spark)
    sums = scratch.keep("sums", _sums(vectors))
    counts = sums.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if counts is None:
        return None
    length, n = counts["length"], counts["n"]
    totals = sums.filter(F.col("length") == length).select(F.posexplode("sums").alias("place", "part"))
    ordered = totals.groupBy("place").agg(F.sum("part").alias("total")).orderBy("place").collect()  # one per dimension
    scratch.drop("sums")
    empty = Whitening(n, tuple(r["total"] for r in ordered), np.zeros((length, 0)), np.zeros(0), 0.0)
    nodes = scratch.keep("0", _triangles(vectors, spark.sparkContext.broadcast(empty), length))
    level, most = 0, nodes.agg(F.max("node")).first()[0]
    while most:
        nodes = scratch.keep(str(level + 1), _merged(nodes, length))
        scratch.drop(str(level))
        level, most = level + 1, most // FAN_IN
    last = np.frombuffer(nodes.first()["triangle"], dtype=float).reshape(-1, length)
    scratch.drop(str(level))
    square = np.zeros((length, length))
    square[:len(last)] = last
    values, directions = singular(square, components)
    kept = values > LEAST_SHARE * values.max(initial=0.0)
    return Whitening(n, empty.sums, directions[:, kept], values[kept] / n, float((square ** 2).sum()) / n)


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Per row the exact sum over dimensions of (n x - S)^2."""
    near = x - model.base()
    rest = model.rest()
    most = model.n * float(np.abs(near).max(initial=0)) + float(np.abs(rest).max(initial=0))
    if most * most * max(1, x.shape[1]) < 2.0 ** 62:
        return ((model.n * near - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((model.n * a - r) ** 2 for a, r in zip(row, rest.tolist())) for row in near.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whitened(embeddings: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The usable rows with ``whitened`` (one number per component) and ``deviation`` (squared distance from the mean, times n^2)."""
    own = embeddings.drop("whitened", "deviation")
    schema = T.StructType([*own.schema.fields, T.StructField("whitened", T.ArrayType(T.DoubleType())),
                           T.StructField("deviation", T.LongType())])
    arrow = to_arrow_schema(schema)
    shared = embeddings.sparkSession.sparkContext.broadcast(model)  # as large as the dimensions times the components
    place = own.columns.index(vector)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        scale = fit.directions / np.sqrt(fit.variances)
        for batch in batches(rows):
            lengths = pa.compute.list_value_length(batch.column(place))
            usable = whole_numbers(batch.column(place))[0] & pa.compute.fill_null(
                pa.compute.equal(lengths, len(fit.sums)), False).to_numpy(zero_copy_only=False)
            kept = batch.filter(pa.array(usable))
            if kept.num_rows:
                (_, x), = whole_numbers(kept.column(place))[1]
                out = _centred(x, fit) @ scale
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
                columns = [*kept.columns, lists, pa.array(deviations(x, fit), pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return own.mapInArrow(run, schema)


def identity_error(rows: DataFrame, column: str = "whitened") -> float:
    """Largest absolute entry of the covariance of whitened rows minus the identity; tasks return their moments."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, n = None, 0
        for batch in batches(parts):
            lists = batch.column(0)
            x = lists.flatten().to_numpy().reshape(len(lists), -1)
            own = np.vstack([x.T @ x, x.sum(axis=0)])
            moments, n = own if moments is None else moments + own, n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([moments.ravel().tolist()])], names=["n", "moments"])

    tasks = rows.select(column).mapInArrow(run, "n long, moments array<double>")
    sums = tasks.select("n", F.posexplode("moments").alias("place", "part")).groupBy("place").agg(
        F.sum("n").alias("n"), F.sum("part").alias("total")).orderBy("place").collect()  # (components + 1) x components
    if not sums:
        return 0.0
    width = int((math.isqrt(4 * len(sums) + 1) - 1) // 2)
    moments = np.array([r["total"] for r in sums]).reshape(width + 1, width) / sums[0]["n"]
    covariance = moments[:-1] - np.outer(moments[-1], moments[-1])
    return float(np.abs(covariance - np.eye(width)).max())
