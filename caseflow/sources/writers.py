"""SK1-SK7 and AG26: exports and the check that reads them back."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseflow.session import settle


class ExportMismatch(RuntimeError):
    """A written table does not match its source."""


def write_parquet(frame: DataFrame, path: str, compression: str = "zstd") -> str:
    """SK1, SK2, SK5: Parquet, ZSTD unless told otherwise."""
    frame.write.mode("errorifexists").option("compression", compression).parquet(path)
    return path


SINGLE_FILE_ROWS = 1_000_000


class TooManyRows(RuntimeError):
    """A table is too large for one file."""


def write_csv(frame: DataFrame, path: str) -> str:
    """SK3: CSV with header, as many files as the frame has partitions."""
    # quotes are doubled, as CSV readers other than Spark's expect
    frame.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
    return path


def write_one_csv(frame: DataFrame, path: str, most: int = SINGLE_FILE_ROWS) -> str:
    """SK3 as one file; a table of more than ``most`` rows raises, as one task would write it all."""
    stored = settle(frame.limit(most + 1))
    if stored.count() > most:
        raise TooManyRows(f"{path}: more than {most} rows; use write_csv")
    return write_csv(stored.coalesce(1), path)


def write_json_by_class(documents: DataFrame, path: str) -> str:
    """SK4: one JSON-lines folder per class code."""
    (
        documents.withColumn("classe_codigo", F.col("classe.codigo"))
        .write.mode("errorifexists").partitionBy("classe_codigo").json(path)
    )
    return path


# Leading columns of the aggregated export.
AGGREGATE_LEADING = (
    "_arquivo_origem", "_timestamp_processamento", "codigos_nacionais", "total_codigos_nacionais",
)


def aggregate_layout(records: DataFrame) -> DataFrame:
    """SK6: fixed leading columns, the rest A to Z, missing values as ''."""
    rest = sorted(c for c in records.columns if c not in AGGREGATE_LEADING)
    leading = [c for c in AGGREGATE_LEADING if c in records.columns]
    return records.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in leading + rest]
    )


def _schema_text(frame: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)


def write_checked(
    frame: DataFrame, path: str, compression: str = "zstd", gate: dict[str, Column] | None = None,
) -> DataFrame:
    """SK1, AG26, AG14: a write that observes itself; one row with what was written and what was asked of it.

    Rows and the aggregates of ``gate`` are observed on their way to the files, so the source is read once. The
    row count is compared with the files' own, the schema with that of the source; a difference raises.
    """
    seen = Observation()
    asked = [expression.alias(name) for name, expression in (gate or {}).items()]
    write_parquet(frame.observe(seen, F.count(F.lit(1)).alias("_rows"), *asked), path, compression)
    metrics = dict(seen.get)
    rows = metrics.pop("_rows", 0)  # an empty source observes nothing
    stored = frame.sparkSession.read.parquet(path)
    report = stored.agg(F.count("*").alias("linhas")).select(
        "linhas", F.lit(len(stored.columns)).cast("bigint").alias("colunas"),
        F.lit(", ".join(stored.columns)).alias("nomes"), (F.col("linhas") == rows).alias("mesmas_linhas"),
        F.lit(_schema_text(stored) == _schema_text(frame)).alias("mesmo_esquema"),
        *[F.lit(metrics.get(name, 0)).alias(name) for name in (gate or {})])
    row = report.first()
    if not (row.mesmas_linhas and row.mesmo_esquema):
        raise ExportMismatch(f"{path}: {row.asDict()}")
    return report


# ---- versions: a table is a folder of versions and a pointer to the current one --------------------

POINTERS = "_versions"


class VersionConflict(RuntimeError):
    """Another writer published this version first."""


class NoVersion(RuntimeError):
    """No version of this table was ever published."""


def _files(spark: SparkSession, path: str):
    """(file system, path): the store's own, whatever it is."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, rising; an unfinished or failed write is not among them."""
    files, place = _files(spark, f"{root.rstrip('/')}/{POINTERS}")
    if not files.exists(place):
        return []
    return sorted(int(status.getPath().getName()) for status in files.listStatus(place)
                  if status.getPath().getName().isdigit())


def publish(frame: DataFrame, root: str, expected: int | None = None) -> int:
    """SK7: write ``frame`` beside the current version and make it the current one; returns its number.

    The rows go to a folder no reader looks at. Only when they are complete (see ``write_checked``) a pointer file named
    by the version's number is created, which the file system grants to one writer: a crash before leaves the old
    version current, and a second writer of the same number raises ``VersionConflict``. ``expected`` is the version
    the frame was made from, by default the one current when the call begins.
    """
    spark, root = frame.sparkSession, root.rstrip("/")
    current = max(published_versions(spark, root), default=0) if expected is None else expected
    number, folder = current + 1, f"data-{uuid.uuid4().hex}"
    write_checked(frame, f"{root}/{folder}")
    files, pointer = _files(spark, f"{root}/{POINTERS}/{number}")
    try:
        files.mkdirs(pointer.getParent())
        stream = files.create(pointer, False)
    except Py4JJavaError as error:
        if files.exists(pointer):
            raise VersionConflict(f"{root}: version {number} exists") from error
        raise
    stream.write(bytearray(folder, "ascii"))
    stream.close()
    return number


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """SK7: the current version of a published table, or an older one by its number.

    A pointer whose writer died between its creation and its content is passed over.
    """
    numbers = published_versions(spark, root) if version is None else [version]
    for number in reversed(numbers):
        files, pointer = _files(spark, f"{root.rstrip('/')}/{POINTERS}/{number}")
        if files.exists(pointer) and files.getFileStatus(pointer).getLen() > 0:
            folder = spark.read.text(pointer.toString()).first()["value"]
            return spark.read.parquet(f"{root.rstrip('/')}/{folder}")
    raise NoVersion(f"{root}: no published version" if version is None else f"{root}: no version {version}")


def read_back(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """AG26: rows and columns of a written table next to those of its source."""
    written = spark.read.parquet(path)
    counts = written.agg(F.count("*").alias("linhas"))
    return counts.select(
        "linhas",
        F.lit(len(written.columns)).cast("bigint").alias("colunas"),
        F.lit(", ".join(written.columns)).alias("nomes"),
        (F.col("linhas") == source.agg(F.count("*")).scalar()).alias("mesmas_linhas"),
        F.lit([(f.name, f.dataType) for f in written.schema.fields]
              == [(f.name, f.dataType) for f in source.schema.fields]).alias("mesmo_esquema"),
    )


def check_read_back(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """AG26 gate: raise when row count or schema differ."""
    report = read_back(spark, path, source)
    row = report.first()
    if not (row.mesmas_linhas and row.mesmo_esquema):
        raise ExportMismatch(f"{path}: {row.asDict()}")
    return report
