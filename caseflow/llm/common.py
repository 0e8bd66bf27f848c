"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.session import prepare, shared_dir

#: Rows and bytes of one Arrow batch, so that a worker holds little text at a time.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
#: Steps end in a stored frame, so what a step has shuffled isn't needed after it.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Characters of text one vectorised step handles together.
SLICE_CHARS = 1 << 20
_TO_SPACE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))


def ready(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on."""
    prepare(spark)
    for name, value in (ARROW | CLEANUP).items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """Store ``df`` once in the shared folder and read it back; cuts the lineage."""
    path = shared_dir(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored intermediate frames that can be removed once nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Store ``df`` under a name of this scratch and read it back."""
        self.paths[name] = shared_dir(self.spark)
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bit_table(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A table of ``bits`` bits (a power of two) in which the low bits of every key are set.

    Its size is fixed, whatever the number of keys: with too many of them it only stops sparing work. The driver gets
    one row per filled 64-bit word.
    """
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
    filled = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    return table


def in_bit_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & (64 * len(table) - 1)
    return ((table[place >> 6] >> (place & 63)) & 1).astype(bool)


def raw(text: str | None) -> bytes:
    """UTF-8 of a text, A-Z lower-cased; other letters keep their case. NULL counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def blank_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space, 0x09-0x0D), A-Z lower-cased."""
    return raw(text).split()


def plain_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, ASCII digits and all non-ASCII characters, A-Z lower-cased."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def sized_slices(sizes: list[int | None], limit: int = SLICE_CHARS) -> Iterator[range]:
    """Consecutive index ranges whose sizes add up to about ``limit``; a larger one stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        n = size or 0
        if i > start and total + n > limit:
            yield range(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield range(start, len(sizes))


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[range]:
    """Consecutive index ranges of about ``limit`` characters; a longer text stands alone."""
    return sized_slices([len(text) if text else 0 for text in texts], limit)


def fold(column: str, folds: int) -> Column:
    """crc32(id as text) mod ``folds``; a NULL id is in no fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def new_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def batches(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch for batch in rows if batch.num_rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalising mixer over unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
