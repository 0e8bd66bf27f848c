"""Near duplicates of embeddings: exact cosine links by PCA-ordered, tiled comparison.

Equal vectors (same label) become one row with a count. Unit vectors are rotated onto the principal axes of a bounded sample
(``PCA_ROWS`` rows; any rotation keeps cosines, so the sample only decides how early a comparison stops) and sorted into tiles of
``TILE`` rows by their first coordinates. Two tiles meet only if their boxes on the leading axes are close enough for a
link. Inside a pair of tiles, products accumulate over groups of leading dimensions; what the remaining ones can add is at most
the product of the suffix norms, and rows and columns drop out as soon as the threshold is out of reach. Links within 1e-9 of
the threshold are decided on the original vectors.

A pair of tiles returns link counts per vector and a spanning forest of its links, never the links themselves, so large
groups of near copies add rows in proportion to their vectors.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components, rows with a NULL label and rows with a
NULL id link with nothing (a NULL id is not kept, its component is NULL); vectors of different lengths don't link; repeated rows
link with each other; an id that repeats with another vector joins both vectors' groups; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import batches, written
from caseflow.llm.components import components

THRESHOLD = 0.98
TILE = 512
PCA_ROWS = 10_000
STEP_DIMS = 8
BOX_DIMS = 6
CELL = 0.1
_EDGE = 1e-9


def _rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the principal axes of a bounded sample, most important first."""
    sample = classes.orderBy(F.xxhash64("vec")).limit(PCA_ROWS).select("dim", "vec").collect()
    out = {}
    for dim in {r["dim"] for r in sample}:
        x = np.array([r["vec"] for r in sample if r["dim"] == dim])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, axes = np.linalg.eigh(x.T @ x)
        out[dim] = np.ascontiguousarray(axes[:, ::-1])
    return out


def _rotated(shared):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            turned, cells, third = [], [], []
            for vec in batch.column("vec").to_pylist():
                x = np.array(vec)
                axes = shared.value.get(len(x))  # a length the sample doesn't have keeps its axes
                unit = x / np.linalg.norm(x)
                unit = unit @ axes if axes is not None else unit
                turned.append(unit.tobytes())
                lead = [*unit[:3], 0.0, 0.0]
                cells.append([int(np.floor(c / CELL)) for c in lead[:2]])
                third.append(float(lead[2]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "dim", "rep", "m")]
                + [pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                   pa.array(third), pa.array([np.array(v).tobytes() for v in batch.column("vec").to_pylist()], pa.binary()),
                   pa.array(turned, pa.binary())],
                names=["label", "dim", "rep", "m", "c1", "c2", "third", "vec", "unit"])

    return run


_ROTATED = "label int, dim int, rep long, m long, c1 int, c2 int, third double, vec binary, unit binary"
_TILES = ("tile long, label int, dim int, low array<double>, high array<double>, reps array<long>, ms array<long>, "
          "vecs binary, units binary")


def _tiles(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one label and length, at most TILE of them, as one row."""
    number, held = TaskContext.get().partitionId() << 32, []

    def tile() -> pa.RecordBatch:
        first = held[0]
        units = np.frombuffer(b"".join(r["unit"] for r in held)).reshape(len(held), first["dim"])
        row = {
            "tile": number, "label": first["label"], "dim": first["dim"],
            "low": units[:, :BOX_DIMS].min(axis=0).tolist(), "high": units[:, :BOX_DIMS].max(axis=0).tolist(),
            "reps": [r["rep"] for r in held], "ms": [r["m"] for r in held],
            "vecs": b"".join(r["vec"] for r in held), "units": units.tobytes()}
        return pa.RecordBatch.from_pylist([row], schema=_arrow(_TILES))

    for batch in batches(rows):
        for row in batch.to_pylist():
            if held and (len(held) == TILE or (held[0]["label"], held[0]["dim"]) != (row["label"], row["dim"])):
                yield tile()
                number, held = number + 1, []
            held.append(row)
    if held:
        yield tile()


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(),
             "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in schema.split(", "))])


def _pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with a <= b: tiles of one label and length whose boxes are within reach of each other."""
    reach = (2 - 2 * threshold) ** 0.5 + _EDGE  # distance of unit vectors at the threshold
    meta = tiles.select("tile", "label", "dim", "low", "high")
    cell = lambda c: F.floor(c / F.lit(reach)).cast("int")
    one = meta.withColumn("cell", F.explode(F.sequence(cell(F.col("low")[0]), cell(F.col("high")[0]))))
    two = meta.withColumn("cell", F.explode(F.sequence(cell(F.col("low")[0]) - 1, cell(F.col("high")[0]) + 1)))
    met = one.alias("a").join(two.alias("b"), ["label", "dim", "cell"]).filter("a.tile <= b.tile")
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("a.low", "b.high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            F.zip_with("b.low", "a.high", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            lambda x, y: F.greatest(x, y) * F.greatest(x, y)),
        F.lit(0.0), lambda total, x: total + x)
    return met.filter(gap <= reach * reach).select(
        F.col("a.tile").alias("a"), F.col("b.tile").alias("b")).distinct()


def near(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a and b (unit vectors, important dimensions first) reach the threshold."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    rows, columns = np.arange(len(a)), np.arange(len(b))
    total = np.zeros((len(a), len(b)))
    for start in range(0, a.shape[1], STEP_DIMS):
        stop = min(start + STEP_DIMS, a.shape[1])
        total += a[rows, start:stop] @ b[columns, start:stop].T
        rest_a = np.linalg.norm(a[rows, stop:], axis=1)
        rest_b = np.linalg.norm(b[columns, stop:], axis=1)
        alive = total + rest_a[:, None] * rest_b >= threshold - _EDGE
        keep_a, keep_b = alive.any(axis=1), alive.any(axis=0)
        if not keep_a.any():
            return out
        if keep_a.mean() * keep_b.mean() < 0.7:
            rows, columns, total = rows[keep_a], columns[keep_b], total[np.ix_(keep_a, keep_b)]
    close = total >= threshold
    for i, j in np.argwhere(np.abs(total - threshold) <= _EDGE):
        x, y = raw_a[rows[i]], raw_b[columns[j]]
        close[i, j] = float(x @ y) / (float(x @ x) ** 0.5 * float(y @ y) ** 0.5) >= threshold
    out[np.ix_(rows, columns)] = close
    return out


def _forest(links: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges (row, column) that connect what the links of a boolean matrix connect."""
    left_rows, left_columns = links.any(axis=1), links.any(axis=0)
    while left_rows.any():
        frontier = np.array([int(np.argmax(left_rows))])
        left_rows[frontier] = False
        while len(frontier):
            reached = links[frontier] & left_columns
            columns = np.flatnonzero(reached.any(axis=0))
            if not len(columns):
                break
            yield from zip(frontier[reached[:, columns].argmax(axis=0)], columns)
            left_columns[columns] = False
            back = links[:, columns] & left_rows[:, None]
            frontier = np.flatnonzero(back.any(axis=1))
            yield from zip(frontier, columns[back[frontier].argmax(axis=1)])
            left_rows[frontier] = False


def _compared(threshold: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                view = lambda k: np.frombuffer(row[k]).reshape(-1, row["dim"])
                links = near(view("units_a"), view("units_b"), view("vecs_a"), view("vecs_b"), threshold)
                a, b = np.array(row["reps_a"]), np.array(row["reps_b"])
                same = row["a"] == row["b"]
                if same:
                    np.fill_diagonal(links, False)
                counts = [(a, links @ np.array(row["ms_b"]))]
                if not same:
                    counts.append((b, np.array(row["ms_a"]) @ links))
                node = np.concatenate([x[n > 0] for x, n in counts])
                n = np.concatenate([n[n > 0] for _, n in counts])
                edges = [(a[x], b[y]) for x, y in _forest(links)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*node, *(u for u, _ in edges)], pa.int64()),
                     pa.array([*n, *[0] * len(edges)], pa.int64()),
                     pa.array([*[None] * len(node), *(v for _, v in edges)], pa.int64())], names=["node", "n", "to"])

    return run


def deduplicated(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    own = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"),
                         F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0),
        F.lit(False))
    own = own.withColumn("vec", F.when(usable, F.transform("vec", lambda x: x + 0.0)))
    classes = written(
        own.filter("vec is not null").groupBy("label", "vec")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")).withColumn("dim", F.size("vec")))
    axes = vectors.sparkSession.sparkContext.broadcast(_rotations(classes))
    turned = classes.select("label", "dim", "rep", "m", "vec").mapInArrow(_rotated(axes), _ROTATED)
    order = ["label", "dim", "c1", "c2", "third"]
    tiles = written(turned.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tiles, _TILES))
    side = lambda s: tiles.select(
        F.col("tile").alias(s), *([F.col("dim")] if s == "a" else []),
        *(F.col(c).alias(f"{c}_{s}") for c in ("reps", "ms", "vecs", "units")))
    pairs = written(_pairs(tiles, threshold))
    found = written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        _compared(threshold), "node long, n long, to long"))
    counts = found.filter("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(found.filter("to is not null").select(F.col("node").alias("u"), F.col("to").alias("v")))
    named = written(
        classes.join(counts, classes["rep"] == counts["node"], "left").drop("node")
        .join(labels, classes["rep"] == labels["node"], "left")
        .select(classes["label"], "vec", "m", "n",
                F.coalesce(labels["label"], "rep").alias("component")))
    kept = own.alias("o").join(named.alias("c"), (F.col("o.label") == F.col("c.label")) & (F.col("o.vec") == F.col("c.vec")), "left")
    component = F.coalesce(F.col("component"), F.col("vec_id"))
    return kept.select(
        "vec_id", (F.coalesce(F.col("m") - 1, F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
