"""The smallest distinct values per group as a mergeable state: a few rows per task, whatever the input holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Smallest:
    """Row counts and the ``most`` smallest distinct values of each group seen so far."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.rows: dict[str, int] = {}
        self.values: dict[str, pa.Array] = {}

    def add(self, groups: pa.Array, values: pa.Array) -> None:
        coded = groups.dictionary_encode()
        codes = coded.indices.to_numpy()
        for code, group in enumerate(coded.dictionary.to_pylist()):
            here = codes == code
            self.rows[group] = self.rows.get(group, 0) + int(np.count_nonzero(here))
            self._merge(group, values.filter(pa.array(here)).drop_null())

    def _merge(self, group: str, values: pa.Array) -> None:
        known = self.values.get(group)
        if known is not None and len(known) == self.most:
            values = values.filter(pc.less(values, known[-1]))
        if known is not None:
            values = pa.concat_arrays([known, values])
        if known is None or len(values) > len(known):
            distinct = values.unique()
            self.values[group] = distinct.take(pc.sort_indices(distinct)[:self.most])

    def batch(self) -> pa.RecordBatch:
        groups = list(self.rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.string()), pa.array([self.rows[g] for g in groups], pa.int64()),
             pa.array([self.values[g].to_pylist() for g in groups], pa.list_(pa.string()))],
            names=["grupo", "n", "valores"])


def counts_and_smallest(frame: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """(grupo, n, valores): rows per group and its ``most`` smallest distinct values, rising; NULL values only count.

    ``group`` and ``value`` are strings and ``group`` is never NULL. Every task keeps its own state and returns one row per
    group it met; these rows are all that is shuffled, and a group's merge holds ``most`` values per task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Smallest(most)
        for batch in batches:
            if batch.num_rows:
                state.add(batch.column(0), batch.column(1))
        yield state.batch()

    states = frame.select(group, value).mapInArrow(run, "grupo string, n long, valores array<string>")
    merged = states.groupBy("grupo").agg(F.sum("n").alias("n"), F.flatten(F.collect_list("valores")).alias("valores"))
    return merged.withColumn("valores", F.slice(F.array_sort(F.array_distinct("valores")), 1, most))
