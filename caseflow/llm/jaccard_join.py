"""Jaccard similarity join of word-shingle sets with PartEnum signatures.

Sets of one size band are compared in one instance of the scheme. An instance splits the shingle domain into ``n1`` parts
by a hash; two sets whose symmetric difference is at most K < n1 agree on at least n1 - K parts, so a signature per part
(part number and its content) is shared by every pair that is similar enough. With sets that differ in at most K
shingles, parts of the first level with no tolerance left are the enumeration with the fewest signatures, so the second level
is the single subset of all of a part.

Empty parts agree between unrelated sets, so they are not signatures. That stays exact: a set with e empty parts, whose
partners differ from it in at most k shingles, still shares a non-empty part whenever e < n1 - k. Where that fails, the set
also takes part in the next domain split (another hash), up to ``SPLITS`` of them; in the last one, empty parts do count.

Equal sets become one node first (a 64-bit digest; equal digests count as equal sets). Candidates never become all pairs of a
bucket: first, every node is compared with the nearest of its buckets' leaders (four per bucket); then only members
of a bucket that are still in different components are compared. Sizes and parity sketches (a lower bound of the difference; sets
of over 1,024 shingles also have one as wide as they are large) drop impossible pairs; both rounds verify whole shingle sets of
the others.

Defined results: a NULL or empty text, or one without words, has an empty set and is linked with nothing; with fewer than
five words the whole sequence is the one shingle; repeated rows and copies share a component; a NULL id never names a component
(only rows with NULL ids in it: component NULL); an empty table gives no rows; other columns are ignored by ``joined`` and
kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.common import Scratch, batches, bit_table, blank_words, in_bit_table, mixed, new_name, sized_slices, slices, written
from caseflow.llm.components import components

WIDTH = 5
#: Similarity as a fraction: linked when DEN * intersection >= NUM * union.
NUM, DEN = 80, 100
BAND = 1.6
SPLITS = 4
#: Bits of the broadcast tables that keep texts and signatures without partner out of a shuffle: 8 and 16 MB, whatever the input.
TEXT_BITS = 1 << 26
SIG_BITS = 1 << 27
SKETCH_BITS = 1024
#: Leaders a bucket proposes in round 1, and links a node tries there.
LEADERS = (0, -1, 0x5A5A1234C3C3F00D, 0x2545F4914F6CDD1D)
TRIES = 4
SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]
_STEP = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    out = []
    for part in slices(texts):
        words = [blank_words(texts[i]) for i in part]
        code = {w: xxhash.xxh3_64_intdigest(w) for own in words for w in set(own)}
        for own in words:
            h = np.fromiter(map(code.__getitem__, own), dtype=np.uint64, count=len(own))
            if len(h) < WIDTH:
                value = mixed((h * _STEP[8:8 + len(h)]).sum(keepdims=True) + np.uint64(len(h))) if len(h) else h
            else:
                value = h[:len(h) - WIDTH + 1] * _STEP[0]
                for k in range(1, WIDTH):
                    value = value + h[k:len(h) - WIDTH + 1 + k] * _STEP[k]
                value = mixed(value)
            out.append(np.unique(value))
    return out


def digest(shingles: np.ndarray) -> int | None:
    """Signed 64-bit digest of a set; None for the empty set."""
    if not len(shingles):
        return None
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), dtype=">i8")[0])


class Instance:
    """One size band: its parts, and for a set size the largest difference to a partner inside the band."""

    def __init__(self, low: int, high: int, number: int) -> None:
        self.low, self.high, self.number = -(-low * NUM // DEN), high, number
        self.limit = self._difference(high, high)
        self.parts = next((n for n in range(self.limit + 1, 2 * self.limit + 4) if self._roomy(n)), self.limit + 1)

    def _roomy(self, parts: int) -> bool:
        """Whether sets of the largest size rarely have more empty parts than the count leaves room for."""
        empty = parts * (1 - 1 / parts) ** self.high
        return empty + 3 * empty ** 0.5 <= parts - self.limit - 1 + 1e-3

    @staticmethod
    def _difference(a: int, b: int) -> int:
        """The largest symmetric difference of linked sets of sizes a and b."""
        return (a + b) * (DEN - NUM) // (DEN + NUM)

    def tolerance(self, size: int) -> int:
        return self._difference(size, min(self.high, size * DEN // NUM))


class Bands:
    """The instances, made as sizes ask for them."""

    def __init__(self) -> None:
        self.instances: list[Instance] = []
        self.ends: list[int] = []

    def of(self, size: int) -> list[Instance]:
        """The set's own band, and the next one when it can have larger partners there."""
        while len(self.ends) < 2 or self.ends[-2] < size:
            low = self.ends[-1] + 1 if self.ends else 1
            self.ends.append(int(low * BAND))
            self.instances.append(Instance(low, self.ends[-1], len(self.instances)))
        home = int(np.searchsorted(self.ends, size))
        return [x for x in self.instances[home:home + 2] if x.low <= size]


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signed 64-bit signatures of a non-empty set."""
    out = []
    for x in bands.of(len(shingles)):
        for split in range(SPLITS):
            h = mixed(shingles ^ _STEP[40 + split])
            part = (h % np.uint64(x.parts)).astype(np.int64)
            filled = np.bincount(part, minlength=x.parts)
            content = np.zeros(x.parts, dtype=np.uint64)
            np.add.at(content, part, mixed(h + _STEP[20]))
            where = (np.arange(x.parts, dtype=np.uint64) + np.uint64((x.number * SPLITS + split) << 40)) * _STEP[21]
            value = mixed(content + where)
            empty = int((filled == 0).sum())
            safe = empty < x.parts - x.tolerance(len(shingles))
            out.append(value if not safe and split == SPLITS - 1 else value[filled > 0])
            if safe:
                break
    return np.concatenate(out).view(np.int64)


def sketch(shingles: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parities of the set's members over ``bits`` classes; two sets differ in at least as many shingles as bits."""
    odd = np.bincount((mixed(shingles) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> bytes | None:
    """A sketch with a class per shingle at least, for sets that fill up the common one; None for smaller sets."""
    if len(shingles) <= SKETCH_BITS:
        return None
    return sketch(shingles, 1 << int(len(shingles) - 1).bit_length()).tobytes()


def wide_distance(a: bytes, b: bytes) -> int:
    """Differing bits of two wide sketches; the wider one is folded to the other's classes."""
    x, y = (np.frombuffer(s, dtype=np.uint64) for s in (a, b))
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _read(copies=None):
    """Node, size, sketches and signatures of each document; texts in the table of repeated ones are left unsigned."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands()
        for batch in batches(rows):
            for part in sized_slices(pa.compute.binary_length(batch.column("text")).to_pylist()):
                yield _signed(batch.slice(part.start, len(part)), bands, copies)

    return run


def _signed(batch: pa.RecordBatch, bands: Bands, copies) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text").to_pylist())
    nodes = [digest(s) for s in sets]
    seen: set = {None}
    if copies is not None:
        later = in_bit_table(copies.value, batch.column("text_key").to_numpy())
        seen.update(d for d, x in zip(nodes, later) if x)
    signs = [signatures(s, bands) if not (d in seen or seen.add(d)) else np.empty(0, np.int64) for s, d in zip(sets, nodes)]
    ends = np.cumsum([0] + [len(x) for x in signs]).astype(np.int32)
    sketches = np.array([sketch(s) for s in sets])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
         pa.array(nodes, pa.int64()), *(pa.array(sketches[:, k]) for k in range(SKETCH_BITS // 64)),
         pa.array([wide_sketch(s) for s in sets], pa.binary()),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(signs)))],
        names=["doc_id", "text_key", "n_shingles", "node", *SKETCH, "wide", "sigs"])


def _repeated(table):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            lists = batch.column("sigs")
            sigs = lists.flatten().to_numpy()
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy())
            keep = in_bit_table(table.value, sigs)
            yield pa.RecordBatch.from_arrays([pa.array(sigs[keep]), pa.array(nodes[keep])], names=["sig", "node"])

    return run


def _one_each(docs: DataFrame, table) -> DataFrame:
    """(text_key, text) of the distinct texts whose key is in a bit table; combined before and dealt by the key."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            yield batch.filter(pa.array(in_bit_table(table.value, batch.column("text_key").to_numpy())))

    kept = docs.select("text_key", "text").mapInArrow(run, "text_key long, text string")
    return kept.groupBy("text_key").agg(F.first("text").alias("text"))


def _close(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose wide sketches leave room for a link; pairs without two of them stay."""
    for batch in batches(rows):
        n = zip(batch.column("n_u").to_pylist(), batch.column("n_v").to_pylist())
        wide = zip(batch.column("wide_u").to_pylist(), batch.column("wide_v").to_pylist())
        keep = [not (a and b) or wide_distance(a, b) * (DEN + NUM) <= (x + y) * (DEN - NUM) for (a, b), (x, y) in zip(wide, n)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v", "u_key", "v_key"])


def _linked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets reach the similarity."""
    for batch in batches(rows):
        texts = [*batch.column("text_u").to_pylist(), *batch.column("text_v").to_pylist()]
        distinct = list(dict.fromkeys(texts))
        sets = dict(zip(distinct, shingle_sets(distinct)))
        n, keep = batch.num_rows, []
        for a, b in zip(texts[:n], texts[n:]):
            x, y = sets[a], sets[b]
            common = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(DEN * common >= NUM * (len(x) + len(y) - common))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["u", "v"])


def _verified(docs: DataFrame, info: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are linked: by wide sketches first, then by the whole sets.

    Pairs meet the texts by their keys, so a text is shuffled once, and once more with each of its pairs as the first of it.
    """
    def end(name: str) -> DataFrame:
        return info.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                           F.col("text_key").alias(f"{name}_key"), F.col("wide").alias(f"wide_{name}"))

    near = written(pairs.join(end("u"), "u").join(end("v"), "v").mapInArrow(_close, "u long, v long, u_key long, v_key long"))
    keys = near.select(F.col("u_key").alias("key")).union(near.select(F.col("v_key").alias("key")))
    table = docs.sparkSession.sparkContext.broadcast(bit_table(keys, "key", TEXT_BITS))
    texts = _one_each(docs, table)
    u = texts.select(F.col("text_key").alias("u_key"), F.col("text").alias("text_u"))
    v = texts.select(F.col("text_key").alias("v_key"), F.col("text").alias("text_v"))
    return written(near.join(u, "u_key").join(v, "v_key").select("u", "v", "text_u", "text_v")
                   .mapInArrow(_linked, "u long, v long"))


def _distance(a: str, b: str):
    """Differing sketch bits: at most the symmetric difference of the sets."""
    return sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH)


def _possible(a: str, b: str):
    """Whether sizes and sketches of two rows leave room for a link."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (DEN * F.least(n, m) >= NUM * F.greatest(n, m)) & (_distance(a, b) * (DEN + NUM) <= (n + m) * (DEN - NUM))


def _labelled(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, label) of every row; equal labels are one component, an empty set has none."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    broadcast = docs.sparkSession.sparkContext.broadcast
    scratch = Scratch(docs.sparkSession)
    # texts that occur more than once are signed apart, once each
    copied = docs.filter("text is not null").groupBy("text_key").agg(F.count("*").alias("n")).filter("n > 1")
    copies = broadcast(bit_table(scratch.keep("copied", copied.select("text_key")), "text_key", TEXT_BITS))
    longs = ", ".join(f"{s} long" for s in SKETCH)
    schema = f"doc_id long, text_key long, n_shingles long, node long, {longs}, wide binary, sigs array<long>"
    signed = scratch.keep("signed", docs.mapInArrow(_read(copies), schema))
    once = _one_each(docs, copies).select(F.lit(None).cast("long").alias("doc_id"), "text", "text_key")
    signed_once = scratch.keep("signed_once", once.mapInArrow(_read(), schema).select("node", "sigs"))
    nodes = written(signed.select("doc_id", "text_key", "n_shingles", "node"))
    info = written(signed.filter("node is not null").groupBy("node").agg(
        F.min("text_key").alias("text_key"), *(F.first(c).alias(c) for c in ("n_shingles", *SKETCH)), F.max("wide").alias("wide")))
    # signatures that occur more than once, then their members
    lists = signed.select("node", "sigs").union(signed_once).filter("size(sigs) > 0")
    counted = lists.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
    table = broadcast(bit_table(scratch.keep("repeated", counted.select("sig")), "sig", SIG_BITS))
    near = scratch.keep("near", lists.mapInArrow(_repeated(table), "sig long, node long"))
    scratch.drop("copied", "signed", "signed_once", "repeated")
    shared = written(near.groupBy("sig").agg(
        *(F.min(F.col("node").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)).alias(f"l{k}") for k, x in enumerate(LEADERS)))
        .filter("l0 != l1"))
    members = written(near.join(shared, "sig").dropDuplicates(["sig", "node"]))
    scratch.drop("near")
    # round 1: each node with the nearest of its buckets' leaders, by sketch
    leaders = members.select("node", F.explode(F.array(*(f"l{k}" for k in range(len(LEADERS))))).alias("leader"))
    proposed = written(leaders.filter("node != leader").distinct())
    near_by = proposed.join(info.alias("a"), "node").join(
        info.alias("b"), F.col("leader") == F.col("b.node")).filter(_possible("a", "b")).select(
        F.col("a.node").alias("u"), F.col("leader").alias("v"), _distance("a", "b").alias("d"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    tried = written(near_by.withColumn("rank", rank).filter(F.col("rank") <= TRIES).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    links = _verified(docs, info, tried)
    labels = written(components(links))
    # round 2: bucket members that are still apart
    placed = written(members.select("sig", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")))
    mixed_buckets = written(placed.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                            .filter("x != y").select("sig"))
    apart = written(placed.join(mixed_buckets, "sig").join(info.drop("text_key", "wide"), "node"))
    pairs = apart.alias("a").join(apart.alias("b"), "sig").filter(
        (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label")) & _possible("a", "b")).select(
        F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    more = _verified(docs, info, pairs.join(tried, ["u", "v"], "left_anti"))
    labels = written(components(links.union(more)))
    return written(nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).drop("node"))


def joined(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    own = _labelled(docs)
    smallest = written(own.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest")))
    return own.join(smallest, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id (NULL ids last), of its texts the one with the smallest hash.

    Rows are told apart by id and text, so another text under the same id stays where nothing is linked with it. Rows
    with an empty set are linked with nothing and all stay.
    """
    own = _labelled(docs).filter("label is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    first = written(own.groupBy("label").agg(F.min(rank).alias("first")))
    rows = written(own.join(first, "label").select("doc_id", "text_key", (rank == F.col("first")).alias("kept"))
                   .groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n")))
    key = new_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))

    def those(wanted: DataFrame, how: str, frame: DataFrame) -> DataFrame:
        ends = wanted.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"))
        return frame.join(ends, frame["doc_id"].eqNullSafe(ends["_id"]) & (frame[key] == ends["_text"]), how)

    repeated = rows.filter("kept and n > 1")
    others = those(rows.filter("not kept or n > 1"), "left_anti", keyed)
    return others.unionByName(those(repeated, "left_semi", keyed).dropDuplicates(["doc_id", key])).drop(key)
