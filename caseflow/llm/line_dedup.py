"""Line dedup: lines that several documents hold stay only in the first of them.

Lines are normalised, exploded with their position and hashed to 128 bits; a table of the hashes with their smallest and
largest document tells which lines repeat. Documents meet it by hash: the few hashes with over 1/10,000 of all lines (so
10,000 at most) are broadcast, the others joined by shuffle. Each document gets back the positions it loses.

Defined results: a NULL or empty text is one empty line; a line shorter than ``min_chars`` code points stays; repeats inside
one document stay or go together; rows that repeat an id count as one document; rows without an id count as one document
that comes after all others; a document may lose all its lines (its text is then empty); an empty table gives no rows;
other columns pass through, ``n_chars`` follows the text, and columns named like the results are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.common import Scratch, batches, new_name

MIN_CHARS = 10
MIN_DOCS = 2
#: A hash with more than this share of all lines is broadcast.
HOT_SHARE = 1 / 10_000
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _version(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc, version, position, h1, h2) of every line whose key has at least ``min_chars`` code points."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc_id).alias("doc"), _version(F.col(text)).alias("version"),
        F.posexplode(F.transform(F.split(whole, "\n", -1), line_key)).alias("position", "key"))
    return lines.filter(F.char_length("key") >= min_chars).select(
        "doc", "version", "position",
        F.xxhash64(F.lit(1), F.col("key")).alias("h1"), F.xxhash64(F.lit(2), F.col("key")).alias("h2"))


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, first, n) of hashes found in at least ``min_docs`` documents: the first document and the number of lines."""
    if min_docs > 2:  # two different ids show by their minimum and maximum; more of them have to be counted
        per_doc = lines.groupBy("h1", "h2", "doc").agg(F.count("*").alias("n"))
    else:
        per_doc = lines.withColumn("n", F.lit(1))
    found = per_doc.groupBy("h1", "h2").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.sum("n").alias("n"),
        F.max(F.col("doc").isNull()).alias("nameless"),
        *([F.count("*").alias("documents")] if min_docs > 2 else []))
    several = (F.col("documents") >= min_docs) if min_docs > 2 else (
        (F.col("first") != F.col("last")) | (F.col("first").isNotNull() & F.col("nameless")))
    return found.filter(several).select("h1", "h2", "first", "n")


def lost_positions(lines: DataFrame, repeated: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """(doc, version, lost): the positions a document loses, all but those of the first holder of a line."""
    limit = max(1, int(lines.count() * hot_share))
    hot = repeated.filter(F.col("n") > limit).drop("n")  # at most 1 / hot_share rows, as each has so many lines
    rest = repeated.filter(F.col("n") <= limit).drop("n")
    later = ~F.col("doc").eqNullSafe(F.col("first"))
    common = lines.join(F.broadcast(hot), ["h1", "h2"])
    other = lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"])
    gone = common.filter(later).unionByName(other.filter(later))
    return gone.groupBy("doc", "version").agg(F.collect_set("position").alias("lost"))


def _without(text: str, mark: str, schema: pa.Schema):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            columns = {name: batch.column(name) for name in batch.schema.names}
            kept, before, gone = [], [], []
            for whole, lost in zip(columns[text], columns[mark]):
                lines = (whole.as_py() or "").split("\n")
                before.append(len(lines))
                gone.append(0 if not lost.is_valid else len(lost))
                if gone[-1]:
                    stay = np.ones(len(lines), dtype=bool)
                    stay[lost.values.to_numpy()] = False
                    lines = [lines[i] for i in np.flatnonzero(stay)]
                    kept.append("\n".join(lines))
                else:
                    kept.append(whole.as_py())
            columns |= {text: pa.array(kept, schema.field(text).type), "n_lines": pa.array(before, pa.int64()),
                        "n_dropped": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines`` (before) and ``n_dropped``."""
    scratch = Scratch(docs.sparkSession)
    lines = scratch.keep("lines", hashed_lines(docs, doc_id, text, min_chars))
    repeated = scratch.keep("repeated", repeated_lines(lines, min_docs))
    lost = scratch.keep("lost", lost_positions(lines, repeated))
    scratch.drop("lines", "repeated")
    own = docs.drop("n_lines", "n_dropped")
    mark = new_name(own, "_lost")
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col("l.doc")) & (_version(F.col(f"d.{text}")) == F.col("l.version"))
    joined = own.alias("d").join(lost.alias("l"), same, "left").select("d.*", F.col("l.lost").alias(mark))
    counts = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    schema = T.StructType([*own.schema.fields, *counts])
    out = joined.mapInArrow(_without(text, mark, to_arrow_schema(schema)), schema)
    if "n_chars" in own.columns:
        length = F.length(text).cast(own.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return out
