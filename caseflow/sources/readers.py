"""SC1-SC6: scans of case documents, raw responses, Parquet tables and case lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import schemas
from caseflow.sources import lists

_REJECT = "_corrupt_record"


class MissingInput(RuntimeError):
    """A required input table does not exist."""


def read_case_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC1: newline-delimited case documents; bad lines carry ``_corrupt_record``.

    Lines are read as text and parsed with the whole schema, so that every table
    made from them agrees on which lines are bad.
    """
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return parse_case_text(lines, "value")


def read_organised_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC2: JSON files of one document (or one list of documents), absent fields NULL.

    A file of any size is cut into documents while it is read (``lists.documents``). Each row names its file; an unreadable
    document gives one row with its text in ``_corrupt_record``.
    """
    return parse_organised_text(lists.documents(spark, path).drop("numero"), "texto")


def read_raw_responses(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC6 input: stored envelopes of raw service responses."""
    return (
        spark.read.schema(f"{schemas.RAW_RESPONSE}, {_REJECT} string")
        .option("multiLine", True).json(path)
        .withColumn("_arquivo", F.col("_metadata.file_name"))
    )


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SC3: a Parquet table, optionally projected."""
    frame = spark.read.parquet(path)
    return frame.select(*columns) if columns else frame


def parse_case_text(frame: DataFrame, text: str) -> DataFrame:
    """The document schema applied to a text column; bad text is kept beside NULLs."""
    return _parse_text(frame, text, schemas.CASE_DOCUMENT)


def parse_organised_text(frame: DataFrame, text: str) -> DataFrame:
    return _parse_text(frame, text, schemas.ORGANISED_DOCUMENT)


def _parse_text(frame: DataFrame, text: str, schema: str) -> DataFrame:
    parsed = F.from_json(
        F.col(text), f"{schema}, {_REJECT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT},
    )
    others = [c for c in frame.columns if c != text]
    # as the element of a list a document is parsed once; a filter on its columns would parse it again
    return frame.select(*others, F.explode(F.array(parsed)).alias("_doc")).select(*others, "_doc.*")


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UN9: good documents and bad ones; the bad ones never stop the run."""
    bad = F.col(_REJECT).isNotNull()
    return parsed.filter(~bad).drop(_REJECT), parsed.filter(bad)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def required_inputs(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """SC4: expected tables and whether each can be read."""
    rows = []
    for name in names:
        path = f"{root.rstrip('/')}/{name}"
        found = table_exists(spark, path)
        rows.append((name, path, found, "OK" if found else "ERRO"))
    return spark.createDataFrame(rows, "arquivo string, caminho string, existe boolean, status string")


def check_required_inputs(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """SC4 gate: raise when an expected table is missing."""
    status = required_inputs(spark, root, names)
    missing = [r.arquivo for r in status.collect() if not r.existe]  # one row per expected name
    if missing:
        raise MissingInput(f"required tables not found: {', '.join(missing)}")
    return status


def read_case_list(spark: SparkSession, path: str) -> DataFrame:
    """SC5: first CSV column as case numbers, trimmed; header lines and blanks are dropped.

    Every file decides for itself: its first row is a header unless it looks like data.
    """
    rows = spark.read.schema("processo string").csv(path).select(
        F.trim("processo").alias("processo"), F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.file_block_start") == 0).alias("_start"), F.monotonically_increasing_id().alias("_row"))
    first = rows.filter("_start").groupBy("_file").agg(F.min("_row").alias("_first"))
    cell = F.coalesce("processo", F.lit(""))
    data = cell.rlike("^[0-9]+$") | cell.startswith("0")
    kept = rows.join(first, "_file", "left").filter((F.col("_row") != F.col("_first")) | data)
    return kept.select("processo").filter(F.length("processo") > 0)
