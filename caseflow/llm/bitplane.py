"""Token ids as bit-plane files: fixed-size blocks, transposed to planes, each plane compressed.

File format (a Parquet table, so any store and Spark's commit protocol work; one row is one chunk):

* a chunk holds whole consecutive documents, cut when it has ``chunk_ids`` ids; a longer document stands alone;
* its ids form blocks of ``BLOCK_IDS`` (the last one shorter), each transposed into four byte planes
  (least significant first) or 32 bit planes; every plane is one zstandard frame, NULL-free and in order;
* the chunk index are the other columns: ``part`` and ``seq`` (order of chunks), ``doc_ids`` and ``doc_tokens``
  (documents inside) and ``n_ids``. Readers that only need the index never read the planes.

Defined results: a NULL or empty text is the end id alone; NULL ids sort first; repeated rows are kept, next
to each other; an empty table gives an empty file; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.common import batches, sized_slices

BLOCK_IDS = 1 << 14
CHUNK_IDS = 1 << 16
END_ID = 2
FILE = ("part int, seq int, doc_ids array<bigint>, doc_tokens array<bigint>, n_ids bigint, kind string, "
        "planes array<binary>")
# a space beside other white space (or the character that marks line breaks), and a line break beside some or at an end
_BLANK = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_TOUCHING = f"\\x00| {_BLANK}|{_BLANK} "
_BESIDE_BREAK = rf"\n{_BLANK}|{_BLANK}\n|\A\n|\n\z"
_TAIL = ".,!?;:|&$#*%"
_PIECES_KEPT = 500_000
_ENCODERS: dict[tuple[str, bool], "WordEncoder"] = {}


class WordEncoder:
    """Encodes texts by their words, each distinct word once; the ids are those of whole texts.

    With ``added``, literals of the vocabulary's added tokens become those tokens, as in ``encode(text,
    add_special_tokens=False)`` of an untouched tokenizer; texts that contain one are encoded whole. Without, they are spelled out.
    The vocabulary's pre-tokenizer never joins what stands before a single space or line break with what follows it, nor
    letters with the punctuation after them, so letters and what follows them can be encoded apart. Texts in which a space touches
    other white space are encoded whole. Many texts are split, coded and put together as arrays; only pieces not met before go
    to the tokenizer. The cache is emptied at ``_PIECES_KEPT`` pieces.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # the same ids where no literal stands, in less time
        self.untouched = Tokenizer.from_file(path) if added else None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.model = self.tokenizer.model
        # the byte alphabet of byte-level vocabularies: printable bytes stand for themselves, others follow from 256
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.alphabet = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.cache: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> np.ndarray:
        tokenizer = self.untouched if any(x in text for x in self.added) else self.tokenizer
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces into the cache: letters after a space or none go straight to the model, others as a list of words."""
        letters = [p for p in pieces if (p[1:] if p[:1] == " " else p).isalpha()]
        shown = "\n".join(letters).encode("utf-8").decode("latin-1").translate(self.alphabet).split(self.alphabet[10])
        for piece, own in zip(letters, map(self.model.tokenize, shown)):
            self.cache[piece] = array("I", [t.id for t in own]).tobytes()
        if others := list(set(pieces).difference(letters)):
            found = self.tokenizer.encode(others, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            ends = np.searchsorted(np.array(found.word_ids, dtype=np.int64), np.arange(len(others)), side="right") * 4
            for piece, start, end in zip(others, [0, *ends.tolist()], ends.tolist()):
                self.cache[piece] = ids[start:end]

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lone = pc.invert(pc.match_substring_regex(texts, _BESIDE_BREAK))  # all line breaks stand alone: cut there too
        lists = pc.split_pattern(pc.if_else(lone, pc.replace_substring(texts, "\n", " \0"), texts), pattern=" ")
        offsets = lists.offsets.to_numpy()
        first = offsets[:-1]
        coded = lists.values.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        codes[first] = len(coded.dictionary) + np.arange(len(first))  # the first word of a text has no space before it
        words = pa.concat_arrays([coded.dictionary, lists.values.take(pa.array(first))])
        # a word is what stands before it (a space, a line break or nothing), its letters, and what follows them
        broken = pc.starts_with(words, "\0")
        words = pc.if_else(broken, pc.utf8_ltrim(words, characters="\0"), words)
        core = pc.utf8_rtrim(words, characters=_TAIL)
        apart = pc.utf8_is_alpha(core)
        nothing, space = pa.scalar("", words.type), pa.scalar(" ", words.type)
        tails = pc.if_else(apart, pc.replace_substring_regex(words, r"^\p{L}+", ""), nothing)
        bare = pc.or_(broken, pa.array(np.arange(len(words)) >= len(coded.dictionary)))
        heads = pc.binary_join_element_wise(
            pc.if_else(bare, nothing, space), pc.if_else(apart, core, words), nothing)
        pieces = [*heads.to_numpy(zero_copy_only=False), *tails.to_numpy(zero_copy_only=False), "", "\n"]
        if len(self.cache) > _PIECES_KEPT:
            self.cache = {"": b""}
        if unknown := list(set(pieces).difference(self.cache)):
            self._learn(unknown)
        parts = list(map(self.cache.__getitem__, pieces))
        flat = np.frombuffer(b"".join(parts), dtype="<u4")
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        start = np.cumsum(size) - size
        before = 2 * len(words) + broken.to_numpy(zero_copy_only=False)
        every = np.stack([before[codes], codes, codes + len(words)], axis=1).ravel()
        own = size[every]
        ends = np.cumsum(own)
        place = np.repeat(start[every] - (ends - own), own) + np.arange(ends[-1])
        return flat[place], np.diff(np.concatenate([[0], ends])[3 * offsets])

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text; a NULL text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = pc.match_substring_regex(texts, _TOUCHING)
        for literal in self.added:
            special = pc.or_(special, pc.match_substring(texts, literal))
        out: list = [None] * len(texts)
        plain = np.flatnonzero(~special.to_numpy(zero_copy_only=False))
        if len(plain):
            ids, sizes = self._by_words(texts.take(pa.array(plain)))
            for i, own in zip(plain.tolist(), np.split(ids, np.cumsum(sizes)[:-1])):
                out[i] = own
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._whole(texts[i].as_py())
        return out

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        return self.encode_many(pa.array([text], pa.string()))[0].tobytes()


def _encoder(path: str, added: bool) -> WordEncoder:
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = WordEncoder(path, added)
    return _ENCODERS[path, added]


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids, block by block."""
    pack = zstandard.ZstdCompressor(level=level).compress
    out = []
    for start in range(0, len(ids), BLOCK_IDS):
        planes = ids[start:start + BLOCK_IDS].astype("<u4").view(np.uint8).reshape(-1, 4).T
        if kind == "bit":
            planes = np.packbits(np.unpackbits(planes, axis=0, bitorder="little").reshape(32, -1), axis=1)
        out += [pack(np.ascontiguousarray(plane).tobytes()) for plane in planes]
    return out


def from_planes(planes: list[bytes], n_ids: int, kind: str = "byte") -> np.ndarray:
    """The ids behind ``to_planes``."""
    unpack = zstandard.ZstdDecompressor().decompress
    width, out = {"byte": 4, "bit": 32}[kind], np.empty(n_ids, dtype="<u4")
    for block, start in enumerate(range(0, n_ids, BLOCK_IDS)):
        size = min(BLOCK_IDS, n_ids - start)
        rows = np.stack([np.frombuffer(unpack(p), np.uint8) for p in planes[block * width:(block + 1) * width]])
        if kind == "bit":
            bits = np.unpackbits(rows, axis=1)[:, :size].reshape(32, size)
            rows = np.packbits(bits, axis=0, bitorder="little")
        out[start:start + size] = np.ascontiguousarray(rows.T).view("<u4").ravel()
    return out


def _chunks(vocabulary: str, added: bool, end_id: int, kind: str, chunk_ids: int, schema: pa.Schema):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _encoder(vocabulary, added), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")
        docs, sizes, held, total = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = {"part": part, "seq": seq, "doc_ids": docs, "doc_tokens": sizes, "n_ids": len(ids),
                   "kind": kind, "planes": to_planes(ids, kind)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches(rows):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for group in sized_slices(pc.binary_length(texts).to_pylist()):
                encoded = encoder.encode_many(texts.slice(group.start, len(group)))
                for doc, own in zip(ids[group.start:group.stop], encoded):
                    if docs and total + len(own) + 1 > chunk_ids:
                        yield chunk()
                        docs, sizes, held, total, seq = [], [], [], 0, seq + 1
                    docs.append(doc)
                    sizes.append(len(own) + 1)
                    held += [own, end]
                    total += len(own) + 1
        if docs:
            yield chunk()

    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str, *, end_id: int = END_ID, kind: str = "byte",
              chunk_ids: int = CHUNK_IDS, added: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) and write their ids in ascending doc_id order; ``added``: see ``WordEncoder``."""
    schema = T._parse_datatype_string(FILE)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    run = _chunks(vocabulary, added, end_id, kind, chunk_ids, to_arrow_schema(schema))
    ordered.mapInArrow(run, schema).write.parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of a file: a row per chunk, with the number of ids before it.

    Only two numbers per written part are put in one row order; inside a part the sums run by window.
    """
    index = spark.read.schema(FILE).parquet(path).drop("planes")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("ids")).collect()  # a row per written file
    offsets, total = [], 0
    for row in sorted(parts, key=lambda r: r["part"]):
        offsets.append((row["part"], total))
        total += row["ids"]
    before = spark.createDataFrame(offsets, "part int, part_start bigint")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return index.join(F.broadcast(before), "part").select(
        "part", "seq", "doc_ids", "doc_tokens", "n_ids", (F.col("part_start") + first).alias("chunk_start"))


def _documents(row: dict) -> Iterator[tuple[int, int | None, bytes]]:
    """Of a chunk: ids before each document, its id, its ids as little-endian bytes."""
    data, at = memoryview(from_planes(row["planes"], row["n_ids"], row["kind"])).cast("B"), 0
    for doc, n in zip(row["doc_ids"], row["doc_tokens"]):
        yield at, doc, data[4 * at:4 * (at + n)]
        at += n


def _decoded(spark: SparkSession, path: str, value: str, kind: pa.DataType, of) -> DataFrame:
    schema = T._parse_datatype_string(f"part int, seq int, offset bigint, doc_id bigint, n_tokens bigint, {value}")
    arrow = to_arrow_schema(schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches(rows) for r in _rows(batch)):
            found, n = list(_documents(row)), len(row["doc_ids"])
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                pa.array([at for at, _, _ in found], pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["doc_tokens"], pa.int64()), pa.array([of(x) for _, _, x in found], kind)], schema=arrow)

    return spark.read.schema(FILE).parquet(path).mapInArrow(run, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file: part, seq, ids before it in the chunk, doc_id, n_tokens, ids as little-endian bytes."""
    return _decoded(spark, path, "ids binary", pa.binary(), bytes)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def report(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back: ids before it, its number of ids, their crc32."""
    starts = chunk_index(spark, path).select("part", "seq", "chunk_start")
    own = _decoded(spark, path, "ids_crc32 bigint", pa.int64(), zlib.crc32)
    return own.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("chunk_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
