"""Language-model scores from a probabilistic suffix tree over words.

Sequences of up to ``DEPTH`` + 1 words are counted that occur at least ``MIN_COUNT`` times in training, at every size of the
input; those counted at one length are those whose beginning and end were kept at the length before.
A context becomes a state when its next-symbol distribution diverges from that of its longest shorter state: the
log-likelihood gain over it must exceed the Bayesian cost of its symbols. A state discounts the counts of its
kept symbols and passes the rest to that shorter state, down to the root, which is the smoothed unigram
distribution. A token is scored in the longest state that ends before it.

That score is a sum over the kept sequences of a text: what a state leaves to shorter ones counts at each token after it, and a
kept sequence adds how its last token's probability differs from that. So the tree is a stored table of sequences with their
weights, computed by joins, and grows with the corpus. Only sequences that make up ``P_MIN`` of all training tokens are broadcast
(at most 1 / P_MIN per length). For all others, and for the unigram counts of words outside the frequent ones, blocks of
documents ask: the distinct codes of a block are sent to buckets of the table, packed, and their values are sent back. Counts
are summed in the same buckets, whose number follows the training tokens. Tables of ``BITS`` bits only spare work. Equal 64-bit codes of
sequences count as equal.

Defined results: a NULL or empty text is the end token alone; NULL ids are trained on and not held out; repeated rows are
scored one by one; without training rows every token has probability 1 (N = V = 0); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import Scratch, batches, bit_table, blank_words, fold, in_bit_table, mixed, slices, written

FOLDS, HELD_OUT = 5, 1
DEPTH = 3
P_MIN = 2e-6
MIN_COUNT = 8
DISCOUNT = 0.75
#: The end token's code; words have the hash of their bytes.
END = -0x61C8864680B583EB
COUNT_CHARS = 4 << 20
BITS = 1 << 26
#: Characters of a block; training tokens of a bucket, and the least number of buckets; codes a task gathers before it sends them.
BLOCK_CHARS = 6 << 20
BUCKET_TOKENS, LEAST_BUCKETS = 2 << 20, 32
TASK_CODES = 2 << 20
#: The blocks are scored in so many parts, so that what they ask for and get isn't on disk at once.
PARTS = 4


def coded(texts: list[str | None], limit: int = COUNT_CHARS) -> Iterator[tuple[range, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of texts: their indices, distinct codes, tokens as places in them, first token of each text."""
    for part in slices(texts, limit):
        words = [blank_words(texts[i]) for i in part]
        place = {w: k + 1 for k, w in enumerate({w for own in words for w in own})}
        codes = np.array([END, *(xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in place)], dtype=np.int64)
        starts = np.cumsum([0] + [len(own) + 1 for own in words])
        tokens = np.zeros(starts[-1], dtype=np.int64)
        for first, own in zip(starts, words):
            tokens[first:first + len(own)] = [place[w] for w in own]
        yield part, codes, tokens, starts


def _found(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of ``values`` in the sorted ``keys``; -1 where absent."""
    if not len(keys):
        return np.full(len(values), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def _joined(codes: np.ndarray) -> np.ndarray:
    """Codes of the sequences one longer, from those that begin at each position."""
    pair = mixed(codes[:-1].view(np.uint64)) + codes[1:].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(pair).view(np.int64)


def _ends(codes: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """Codes of the ends of sequences, from theirs and those of their beginnings: ``_joined`` undone."""
    x = codes.view(np.uint64).copy()
    for factor in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD):
        x ^= x >> np.uint64(33)
        x *= np.uint64(pow(factor, -1, 1 << 64))
    x ^= x >> np.uint64(33)
    return ((x - mixed(prefixes.view(np.uint64))) * np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))).view(np.int64)


def _grown(place: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where a sequence one longer can be known; none goes on after an end token."""
    return (place[:-1] >= 0) & (place[1:] >= 0) & ~end[:max(len(place) - 1, 0)]


class Tree:
    """The frequent sequences by length: sorted codes, weights, and what the states among them leave to shorter ones."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, total: int, distinct: int) -> None:
        order = np.argsort(codes)
        self.total, self.scale = total, total + 0.5 * (distinct + 1)
        self.keys, self.weight = [codes[order]], [np.zeros(len(codes))]
        self.log_prob = np.log10((counts[order] + 0.5) / self.scale)
        self.log_rest = [np.full(len(codes), np.nan)]  # NaN: no state

    def add(self, codes: np.ndarray, weight: np.ndarray) -> None:
        """The frequent sequences of the next length."""
        order = np.argsort(codes)
        self.keys.append(codes[order])
        self.weight.append(weight[order])
        self.log_rest.append(np.full(len(codes), np.nan))

    def add_states(self, length: int, codes: np.ndarray, log_rest: np.ndarray) -> None:
        """States among the sequences of a length."""
        self.log_rest[length - 1][_found(self.keys[length - 1], codes)] = log_rest

    def first(self, codes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Places of the tokens themselves; -1 where a token isn't frequent."""
        return _found(self.keys[0], codes)[tokens]

    def score(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per position: its base log10 probability (0 if not frequent), what frequent sequences add to it."""
        place = np.maximum(first, -1).astype(np.int64)
        known, added = place >= 0, np.zeros(len(place))
        base, codes = added.copy(), np.zeros(len(place), dtype=np.int64)
        base[known], codes[known] = self.log_prob[place[known]], self.keys[0][place[known]]
        for d, (keys, weight, log_rest) in enumerate(zip(self.keys, self.weight, self.log_rest)):
            if d:
                at, codes = np.flatnonzero(_grown(place, end)), _joined(codes)
                place = np.full(len(codes), -1, dtype=np.int64)
                place[at] = _found(keys, codes[at])
            at = np.flatnonzero(place >= 0)
            added[at + d] += weight[place[at]]
            rest = log_rest[place[at]]
            state = ~np.isnan(rest)
            added[at[state] + d + 1] += rest[state]  # contexts hold no end token
        return base, added


def _packed(values: np.ndarray) -> bytes:
    """Integers or doubles as bytes: their number, then their bytes by significance, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(values) else b"")


def _unpacked(data: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype=dtype)
    planes = np.frombuffer(pa.decompress(data[8:], n * size, "zstd", asbytes=True), dtype=np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _packed_codes(codes: np.ndarray) -> bytes:
    """Codes in their unsigned order as differences."""
    return _packed(np.diff(codes.view(np.uint64), prepend=np.uint64(0)))


def _unpacked_codes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64).view(np.int64)


def _dealt(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets of codes in their unsigned order, and which codes each holds."""
    bucket = (codes.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    ends = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    return ((k, slice(ends[k], ends[k + 1])) for k in np.flatnonzero(np.diff(ends)).tolist())


def _bucket(code: str, buckets: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(code, 32) * F.lit(buckets).cast("long"), 32).cast("int")


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in their unsigned order, and the place of each code among them."""
    own, which = np.unique(codes.view(np.uint64), return_inverse=True)
    return own.view(np.int64), which


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in their unsigned order with the sums of their counts."""
    order = np.argsort(codes.view(np.uint64))
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][:len(codes)])
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _encoded(limit: int):
    """Blocks of documents, held-out ones apart: their ids, lengths, distinct codes and tokens as places in these."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        waiting: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}

        def block(held_out: bool) -> pa.RecordBatch:
            ids, texts = waiting[held_out]
            waiting[held_out] = [], []
            ((_, codes, tokens, starts),) = coded(texts, 1 << 62)
            order = np.r_[0, 1 + np.argsort(-np.bincount(tokens, minlength=len(codes))[1:], kind="stable")]
            place = np.empty(len(codes), dtype=np.int32)
            place[order] = np.arange(len(codes), dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made]), pa.array([(base >> 32) + made], pa.int64()), pa.array([held_out]), pa.array([len(tokens)]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([_packed(np.diff(starts).astype(np.int32))], pa.binary()), pa.array([_packed(codes[order])], pa.binary()),
                 pa.array([_packed(place[tokens])], pa.binary())],
                names=["block", "turn", "held_out", "n", "doc_ids", "sizes", "codes", "tokens"])

        size = {False: 0, True: 0}
        for batch in batches(rows):
            for doc_id, held_out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                ids, texts = waiting[held_out]
                ids.append(doc_id)
                texts.append(text)
                size[held_out] += len(text or "") + 1
                if size[held_out] >= limit:
                    yield block(held_out)
                    made, size[held_out] = made + 1, 0
        for held_out in (False, True):
            if waiting[held_out][0]:
                yield block(held_out)
                made += 1

    return run


ENCODED = "block long, turn long, held_out boolean, n long, doc_ids array<long>, sizes binary, codes binary, tokens binary"


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, distinct codes and tokens of each block."""
    for batch in batches(rows):
        for block, codes, tokens in zip(*(batch.column(c) for c in ("block", "codes", "tokens"))):
            yield block.as_py(), _unpacked(codes.as_py(), np.int64), _unpacked(tokens.as_py(), np.int32)


def _by_length(codes: np.ndarray, end: np.ndarray, tables: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: codes of the shorter sequences, codes by position, positions whose beginning and end are in the tables.

    The length after the last table's comes last.
    """
    ok, before = np.ones(len(codes), dtype=bool), codes
    for k in range(len(tables) + 1):
        if k:
            before, codes, ok = codes, _joined(codes), ok[:-1] & ok[1:] & ~end[:max(len(ok) - 1, 0)]
        yield before, codes, np.flatnonzero(ok)
        if k < len(tables):
            ok[ok] = in_bit_table(tables[k], codes[ok])


def _counts(tables, buckets):
    """By bucket, the counts of the sequences one longer than the tables'; without tables, of the tokens."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for _, own, tokens in _blocks(rows):
            if tables is None:
                parts.append((own, np.bincount(tokens, minlength=len(own))))
            else:
                *_, (_, codes, at) = _by_length(own[tokens], tokens == 0, [t.value for t in tables])
                parts.append(_summed(codes[at], np.ones(len(at), dtype=np.int64)))
            size += len(parts[-1][0])
            if size >= TASK_CODES:
                yield from _sent(buckets, *_summed(*map(np.concatenate, zip(*parts))))
                parts, size = [], 0
        if size:
            yield from _sent(buckets, *_summed(*map(np.concatenate, zip(*parts))))

    return run


def _sent(buckets: int, codes: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = [(k, _packed_codes(codes[at]), _packed(values[at])) for k, at in _dealt(codes, buckets)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))],
        names=["bucket", "codes", "vals"])


def _received(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([np.empty(0, dtype=np.int64), *(_unpacked_codes(x.as_py()) for x in table["codes"])]),
            np.concatenate([np.empty(0, dtype=np.int64), *(_unpacked(x.as_py(), np.int64) for x in table["vals"])]))


def _counted(train: DataFrame, tables, buckets: int, least: int) -> DataFrame:
    """Sequences that occur ``least`` times (code, n)."""
    def run(table: pa.Table) -> pa.Table:
        codes, n = _summed(*_received(table))
        return pa.table({"code": codes[n >= least], "n": n[n >= least]})

    sent = train.mapInArrow(_counts(tables, buckets), "bucket int, codes binary, vals binary")
    return sent.groupBy("bucket").applyInArrow(run, "code long, n long")


def _links(tables, buckets):
    """Of the kept sequences: their codes and those of their beginnings, sent once by a task while it remembers them."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, kept = np.empty(0, dtype=np.int64), [t.value for t in tables]
        for _, own, tokens in _blocks(rows):
            for k, (before, codes, at) in enumerate(_by_length(own[tokens], tokens == 0, kept)):
                if not 0 < k < len(kept):
                    continue
                at = at[in_bit_table(kept[k], codes[at])]
                at = at[_found(sent, codes[at]) < 0]
                keys, one = np.unique(codes[at].view(np.uint64), return_index=True)
                keys = keys.view(np.int64)
                yield from _sent(buckets, keys, before[at[one]])
                sent = np.sort(np.concatenate([sent, keys] if len(sent) < TASK_CODES else [keys]))

    return run


def _linked(sent: pa.Table, counts: pa.Table) -> pa.Table:
    """The kept sequences of a bucket with their beginnings and ends."""
    codes, prefixes = _received(sent)
    codes, one = np.unique(codes, return_index=True)
    own = counts["code"].to_numpy()
    at = _found(codes, own)
    own, prefixes = own[at >= 0], prefixes[one][at[at >= 0]]
    return pa.table({"length": counts["length"].filter(pa.array(at >= 0)), "code": own,
                     "n": counts["n"].filter(pa.array(at >= 0)), "prefix": prefixes, "suffix": _ends(own, prefixes)})


def _columns(frame: DataFrame) -> list[np.ndarray]:
    found = frame.toArrow()
    return [found[name].to_numpy() for name in frame.columns]


def _level(scratch: Scratch, length: int, links: DataFrame, shorter: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Stored sequences of a length (code, n, lp, weight), and the states before their last tokens (code, n, log_rest).

    ``links``: the kept sequences with their beginnings and ends; ``shorter``: the sequences one shorter; lp is the log10
    probability of a sequence's last token after the others.
    """
    rows = scratch.keep(
        "rows",
        links.filter(F.col("length") == length)
        .join(shorter.select(F.col("code").alias("suffix"), F.col("lp").alias("lq")), "suffix")
        .join(shorter.select(F.col("code").alias("prefix"), F.col("n").alias("own")), "prefix")
        .select("code", "n", "prefix", "own", "lq"))
    p, q = F.col("n") / F.col("own"), F.pow(F.lit(10.0), "lq")
    left = (F.col("n") - DISCOUNT) / F.col("own")
    sums = rows.groupBy("prefix").agg(
        F.max("own").alias("n"), F.count("*").alias("symbols"), F.greatest(1 - F.sum(p), F.lit(1e-12)).alias("rest_p"),
        F.greatest(1 - F.sum(q), F.lit(1e-12)).alias("rest_q"), F.sum(p * F.log(p / q)).alias("bits"),
        (1 - F.sum(left)).alias("rest"))
    gain = F.col("n") * (F.col("bits") + F.col("rest_p") * F.log(F.col("rest_p") / F.col("rest_q")))
    states = scratch.keep(f"states {length}", sums.filter(gain >= 0.5 * (F.col("symbols") + 1) * float(np.log(max(total, 2)))).select(
        F.col("prefix").alias("code"), "n", F.log10(F.greatest("rest", F.lit(1e-300))).alias("log_rest")))
    lp = F.when(F.col("log_rest").isNull(), F.col("lq")).otherwise(F.log10(left + F.pow(F.lit(10.0), "log_rest") * q))
    own = rows.join(states.select(F.col("code").alias("prefix"), "log_rest"), "prefix", "left").select(
        "code", "n", lp.alias("lp"), F.coalesce(lp - F.col("lq") - F.col("log_rest"), F.lit(0.0)).alias("weight"))
    own = scratch.keep(f"sequences {length}", own)
    scratch.drop("rows")
    return own, states


def learn(docs: DataFrame, depth: int = DEPTH) -> tuple[Tree, tuple[DataFrame, DataFrame, list[Broadcast], int], DataFrame]:
    """The frequent sequences; the stored training counts of all tokens (code, n), the stored weights of all other sequences
    (code, weight), the shared bit tables of the kept ones by length and the number of buckets; the stored blocks of documents.

    ``docs``: doc_id, held_out, text; held-out ones are encoded, not counted. Texts are read once, everything else is done on
    the blocks.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    scratch = Scratch(spark)
    encoded = docs.select("doc_id", "held_out", "text").mapInArrow(_encoded(BLOCK_CHARS), ENCODED)
    encoded = written(encoded.withColumn("part", (F.col("turn") % PARTS).cast("int")).drop("turn"), "part")
    train = encoded.filter("not held_out").select("block", "codes", "tokens")
    total = encoded.filter("not held_out").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_TOKENS))
    vocabulary = written(_counted(train, None, buckets, 1))
    distinct = vocabulary.count()
    frequent = F.col("n") >= _frequent(total)
    tree = Tree(*_columns(vocabulary.filter(frequent).select("code", "n")), total, distinct)
    kept = [vocabulary.filter(F.col("n") >= MIN_COUNT)]
    tables = [share(bit_table(kept[0], "code", BITS))]
    for length in range(1, depth + 1):
        kept.append(scratch.keep(f"counts {length}", _counted(train, list(tables), buckets, MIN_COUNT)))
        tables.append(share(bit_table(kept[-1], "code", BITS)))
    links = train.mapInArrow(_links(tables, buckets), "bucket int, codes binary, vals binary")
    counts = [kept[k].select(_bucket("code", buckets).alias("bucket"), F.lit(k).alias("length"), "code", "n") for k in range(1, depth + 1)]
    links = scratch.keep("links", links.groupBy("bucket").cogroup(reduce(DataFrame.unionAll, counts).groupBy("bucket")).applyInArrow(
        _linked, "length int, code long, n long, prefix long, suffix long"))
    scratch.drop(*(f"counts {length}" for length in range(1, depth + 1)))
    shorter = kept[0].select("code", "n", F.log10((F.col("n") + 0.5) / tree.scale).alias("lp"))
    parts = []
    for length in range(1, depth + 1):
        shorter, states = _level(scratch, length, links, shorter, total)
        tree.add_states(length, *_columns(states.filter(frequent).select("code", "log_rest")))
        tree.add(*_columns(shorter.filter(frequent).select("code", "weight")))
        parts += [states.filter(~frequent).select("code", F.col("log_rest").alias("weight")),
                  shorter.filter(~frequent & (F.col("weight") != 0)).select("code", "weight")]
    others = written(reduce(DataFrame.unionAll, parts).groupBy("code").agg(F.sum("weight").alias("weight")))
    scratch.drop(*list(scratch.paths))
    return tree, (vocabulary, others, tables, buckets), encoded


def _frequent(total: int) -> int:
    return max(MIN_COUNT, int(np.ceil(P_MIN * total)))


def _rest(words: np.ndarray, own: np.ndarray, tokens: np.ndarray, tables: list[np.ndarray],
          listed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a block asks for: codes of its words that aren't frequent, codes and positions of sequences that may be listed."""
    found, of = [], []
    for k, (_, codes, at) in enumerate(_by_length(own[tokens], tokens == 0, tables)):
        if k == len(tables):
            break
        at = at[in_bit_table(tables[k], codes[at])]
        at = at[in_bit_table(listed, codes[at])]
        found.append(codes[at])
        of.append(at)
    rare = np.sort(own[_found(words, own) < 0].view(np.uint64)).view(np.int64)
    return rare, np.concatenate(found), np.concatenate(of)


def _asked(words, tables, listed, buckets):
    """Per block and bucket, the distinct codes whose values aren't broadcast; sequences have buckets after those of words."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, own, tokens in _blocks(rows):
            rare, found, _ = _rest(words.value, own, tokens, [t.value for t in tables], listed.value)
            sent = [(first + k, _packed_codes(codes[at])) for first, codes in ((0, rare), (buckets, _distinct(found)[0]))
                    for k, at in _dealt(codes, buckets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in sent], pa.int32()), pa.array([block] * len(sent), pa.int64()),
                 pa.array([codes for _, codes in sent], pa.binary())], names=["bucket", "block", "codes"])

    return run


def _gathered(known: pa.Table) -> pa.Table:
    """The codes of a bucket and their values as one row."""
    order = np.argsort(known["code"].to_numpy().view(np.uint64))
    codes, values = known["code"].to_numpy()[order], known["value"].to_numpy()[order]
    return pa.table({"bucket": known["bucket"][:1], "codes": pa.array([_packed_codes(codes)], pa.binary()),
                     "vals": pa.array([_packed(values)], pa.binary())})


def _answered(asked: pa.Table, known: pa.Table) -> pa.Table:
    """The values of the codes that blocks ask for; NaN where there is none."""
    codes, values = np.empty(0, dtype=np.int64), np.empty(0)
    if known.num_rows:
        codes, values = _unpacked_codes(known["codes"][0].as_py()), _unpacked(known["vals"][0].as_py(), np.float64)
    order = np.argsort(codes)
    keys, values = codes[order], np.append(values[order], np.nan)  # -1: absent
    return pa.table({
        "block": asked["block"], "bucket": asked["bucket"],
        "vals": pa.array([_packed(values[_found(keys, _unpacked_codes(x.as_py()))]) for x in asked["codes"]], pa.binary())})


def _scored(shared, tables, listed):
    """The documents of a block, from its tokens and the answers."""
    def run(answers: pa.Table, blocks: pa.Table) -> pa.Table:
        tree = shared.value
        order = np.argsort(answers["bucket"].to_numpy())
        values = np.concatenate([np.empty(0), *(_unpacked(answers["vals"][i].as_py(), np.float64) for i in order.tolist())])
        ((_, own, tokens),) = _blocks(iter(blocks.combine_chunks().to_batches()))
        sizes = _unpacked(blocks["sizes"][0].as_py(), np.int32)
        starts = np.cumsum(np.r_[0, sizes[:-1]])
        rare, found, at = _rest(tree.keys[0], own, tokens, [t.value for t in tables], listed.value)
        first, word = tree.first(own, tokens), _found(np.sort(rare), own)
        base, added = tree.score(first, tokens == 0)
        by_word = np.append(values[:len(rare)][np.argsort(rare)], 0.0)[word]
        known = (first >= 0) | ~np.isnan(by_word[tokens])
        base += np.where(np.isnan(by_word), np.log10(0.5 / tree.scale), by_word)[tokens]
        weights = np.nan_to_num(values[len(rare):])
        if len(found):
            np.add.at(added, at, weights[_distinct(found)[1]])
        total = lambda x: np.add.reduceat(x, starts)
        base, score = total(base), total(base + added)
        return pa.table({
            "doc_id": blocks["doc_ids"].combine_chunks().flatten(),
            "held_out": pa.array(np.full(len(sizes), blocks["held_out"][0].as_py())),
            "n_tokens": pa.array(sizes.astype(np.int64)), "n_known": pa.array(total(known.astype(np.int64))),
            "train_tokens": pa.array(np.full(len(sizes), tree.total, dtype=np.int64)), "base_score": base, "score": score})

    return run


def scored(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    tree, (vocabulary, others, tables, buckets), encoded = learn(docs)
    share = docs.sparkSession.sparkContext.broadcast
    shared, listed = share(tree), share(bit_table(others, "code", BITS))
    run = _asked(share(tree.keys[0]), tables, listed, buckets)
    known = vocabulary.filter(F.col("n") < _frequent(tree.total)).select(
        _bucket("code", buckets).alias("bucket"), "code", F.log10((F.col("n") + 0.5) / tree.scale).alias("value"))
    known = known.unionAll(others.select(
        (_bucket("code", buckets) + buckets).cast("int").alias("bucket"), "code", F.col("weight").alias("value")))
    known = written(known.groupBy("bucket").applyInArrow(_gathered, "bucket int, codes binary, vals binary"))
    parts = []
    for part in range(PARTS):
        blocks = encoded.filter(F.col("part") == part).drop("part")
        asked = blocks.select("block", "codes", "tokens").mapInArrow(run, "bucket int, block long, codes binary")
        answers = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
            _answered, "block long, bucket int, vals binary")
        parts.append(written(answers.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(
            _scored(shared, tables, listed),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")))
    return reduce(DataFrame.unionAll, parts)
