"""Benchmark decontamination: a broadcast hash set of normalised test windows.

Every text is read once as words; windows whose words all occur in the benchmark are hashed, looked
up and verified word by word. All stages are narrow: nothing of the corpus is shuffled.

The benchmark is indexed in blocks of ``BLOCK_CHARS`` characters, so that a broadcast index has a
size bound whatever the benchmark's size; each further block is one more narrow pass that adds to the
spans found so far, which are stored after every ``BLOCKS_AT_ONCE`` of them.

Defined results: a NULL or empty text has no words and no hits; an item without words has no window; an
item under ``n`` words is one window; repeated rows are treated one by one; an empty table gives no rows, an empty
benchmark no hits; other columns pass through, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.common import batches, new_name, plain_words, slices, written

WINDOW = 10
#: Benchmark characters indexed, and so broadcast, at a time (index: about 20 bytes a character).
BLOCK_CHARS = 4_000_000
#: Blocks looked up in one pass before its result is stored.
BLOCKS_AT_ONCE = 4
STATE_NAME = "_state"
STATE = T.StructType([
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("n_words", T.LongType()),
])
_WORD = re.compile("[0-9A-Za-z\\x80-\U0010FFFF]+")


class WindowIndex:
    """Windows of a block of items: word ids, one hash each, the items that hold them."""

    def __init__(self, items: list[tuple[object, str | None]], n: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in plain_words(text))
            for i in range(max(1, len(ids) - n + 1) if ids else 0):
                found.setdefault(ids[i:i + n], set()).add(str(item))
        self.by_length = {}
        for length in sorted({len(w) for w in found}):
            windows = [w for w in found if len(w) == length]
            ids = np.array(windows, dtype=np.int64)
            seed = 0
            while True:  # another multiplier until no two windows share a hash
                powers = self._powers(length, seed)
                hashes = (ids.astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)
                if len(np.unique(hashes)) == len(hashes):
                    break
                seed += 1
            order = np.argsort(hashes)
            self.by_length[length] = (
                powers, hashes[order], ids[order], [sorted(found[windows[k]]) for k in order])

    @staticmethod
    def _powers(length: int, seed: int) -> np.ndarray:
        return np.random.default_rng(1_000 + seed).integers(1, 1 << 63, length, dtype=np.uint64) | np.uint64(1)

    def scan(self, words: list[list[bytes]]) -> list[list[tuple[int, int, list[str]]]]:
        """For each document its verified occurrences (first word, end word, items)."""
        get = self.vocabulary.get
        starts = np.cumsum([0] + [len(w) + 1 for w in words])  # a separator after each document
        ids = np.full(starts[-1], -1, dtype=np.int64)
        for first, own in zip(starts, words):
            ids[first:first + len(own)] = [get(w, -1) for w in own]
        gaps = np.flatnonzero(ids < 0)
        run = np.repeat(gaps, np.diff(gaps, prepend=-1)) - np.arange(len(ids))  # known words from here on
        out: list[list[tuple[int, int, list[str]]]] = [[] for _ in words]
        for length, (powers, hashes, windows, items) in self.by_length.items():
            at = np.flatnonzero(run >= length)
            if not len(at):
                continue
            value = np.zeros(len(at), dtype=np.uint64)
            for k in range(length):
                value += ids[at + k].astype(np.uint64) * powers[k]
            place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            hit = np.flatnonzero(hashes[place] == value)
            hit = hit[(ids[at[hit][:, None] + np.arange(length)] == windows[place[hit]]).all(axis=1)]
            for doc, k in zip(np.searchsorted(starts, at[hit], side="right") - 1, hit):
                first = int(at[k] - starts[doc])
                out[doc].append((first, first + length, items[place[k]]))
        return out


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint ascending word spans, flattened to start, end, start, end, ..."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _pass(column: str, mark: str, index, schema: pa.Schema):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = batch.column(column).to_pylist()
            before = batch.column(mark).to_pylist()
            state = []
            for part in slices(texts):
                words = [plain_words(texts[i]) for i in part]
                for i, own, found in zip(part, words, index.value.scan(words)):
                    old = before[i] or {"spans": [], "items": []}
                    spans = [*zip(old["spans"][::2], old["spans"][1::2]), *((a, b) for a, b, _ in found)]
                    state.append({
                        "spans": _merged(spans),
                        "items": sorted({*old["items"], *(x for _, _, items in found for x in items)}),
                        "n_words": len(own)})
            columns = [*batch.columns[:-1], pa.array(state, type=schema.field(len(schema) - 1).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def hits(
    docs: DataFrame, benchmark: DataFrame, mark: str = STATE_NAME, text: str = "text", item: str = "item_id", n: int = WINDOW,
) -> DataFrame:
    """``docs`` with a last column ``mark``: word spans inside benchmark windows, their items, the word count."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item).alias("item"), F.col("text").alias("words"))
    chars = bench.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    out = docs.withColumn(mark, F.lit(None).cast(STATE))
    schema = to_arrow_schema(out.schema)
    for block in range(blocks):
        own = bench.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        index = spark.sparkContext.broadcast(WindowIndex([(r["item"], r["words"]) for r in own.collect()], n))
        out = out.mapInArrow(_pass(text, mark, index, schema), out.schema)
        if block % BLOCKS_AT_ONCE == BLOCKS_AT_ONCE - 1 and block < blocks - 1:
            out = written(out)  # so many indexes are held at a time, not all of them
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: word and hit counts, the items found, their digest."""
    state = hits(docs.select("doc_id", "text"), benchmark).select("doc_id", f"{STATE_NAME}.*")
    inside = F.aggregate(F.sequence(F.lit(1), F.size("spans"), F.lit(2)), F.lit(0),
                         lambda total, k: total + F.element_at("spans", k + F.lit(1)) - F.element_at("spans", k))
    n_hit = F.when(F.size("spans") > 0, inside).otherwise(0).cast("long")
    return state.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_spans(text: str, spans: list[int]) -> str:
    """The text without the characters from the first to the last word of each span."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(text[last:at[start][0]])
        last = at[end - 1][1]
    return "".join([*out, text[last:]])


def cleaned(docs: DataFrame, benchmark: DataFrame, drop_share: float = 0.5) -> DataFrame:
    """``docs`` without benchmark passages.

    A document whose words are to more than ``drop_share`` inside windows goes; from the others the hit spans
    are cut and ``n_chars`` follows. All columns of ``docs`` are returned.
    """
    schema, mark = to_arrow_schema(docs.schema), new_name(docs, STATE_NAME)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            states = batch.column(mark).to_pylist()
            keep = [sum(s["spans"][1::2]) - sum(s["spans"][::2]) <= drop_share * s["n_words"] for s in states]
            kept = batch.filter(pa.array(keep, type=pa.bool_()))
            states = [s for s, k in zip(states, keep) if k]
            texts = kept.column("text").to_pylist()
            new = [without_spans(t, s["spans"]) if s["spans"] else t for t, s in zip(texts, states)]
            columns = {name: kept.column(name) for name in schema.names}
            columns["text"] = pa.array(new, type=schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [len(t) if s["spans"] else c for t, s, c in zip(new, states, kept.column("n_chars").to_pylist())],
                    type=schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], schema=schema)

    return hits(docs, benchmark, mark).mapInArrow(run, docs.schema)
