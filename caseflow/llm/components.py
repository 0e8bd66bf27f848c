"""Connected components of an edge table by alternating large-star and small-star rounds.

Runs of at most ``CHUNK`` edges are first contracted to stars around their smallest vertices, inside their tasks; rounds then join
what is left between runs. A round is two aggregations and two joins over the edges; no vertex's neighbours are gathered in one
row, and the driver sees one number a round. Stored frames keep each join's sides splittable by AQE where a vertex has many
edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import batches, written

CHUNK = 1 << 18


def _lowest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of the vertices 0 to n - 1 the smallest one it is connected with."""
    label = np.arange(n)
    while (label[u] != label[v]).any():
        low = np.minimum(label[u], label[v])
        hooked = label.copy()
        np.minimum.at(hooked, label[u], low)
        np.minimum.at(hooked, label[v], low)
        while (hooked != hooked[hooked]).any():
            hooked = hooked[hooked]
        label = hooked
    return label


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    u, v = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v"))
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = _lowest(place[:len(u)], place[len(u):], len(nodes))
    apart = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(nodes[label[apart]])], names=["u", "v"])


def _contract(edges: DataFrame, chunk: int) -> DataFrame:
    """Each run of about ``chunk`` edges as stars that connect the same vertices, stored."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches(rows):
            held.append(batch)
            size += batch.num_rows
            if size >= chunk:
                yield _stars(held)
                held, size = [], 0
        if held:
            yield _stars(held)

    return written(edges.distinct().mapInArrow(run, "u long, v long"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no vertex has two edges to smaller ones, or edges to both smaller and larger ones."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    own = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return own.agg(F.count_if(F.expr("up > 1 or (up = 1 and down = 1)"))).first()[0] == 0


def _star(edges: DataFrame, lowest: DataFrame) -> DataFrame:
    return edges.join(lowest, "u")


def components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, label) of every vertex of ``edges`` (u, v); the label is the component's smallest vertex.

    Loops are ignored, repeated edges count once, an edge with a NULL end is none; no edges give no rows.
    """
    edges = _contract(
        edges.filter("u is not null and v is not null and u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), chunk)
    while not _settled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _star(both, lowest).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u != v").distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = _star(large, lowest)
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(
            stars.select("u", F.col("m").alias("v")))
        edges = _contract(small, chunk)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
