"""Data-quality profiles and gates (TS2, TS4-TS6, AG11-AG15, AG25, ST3)."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from caseflow.constants import EMPTY_CODE
from caseflow.functions import text as tx
from caseflow.functions import timestamps as ts
from caseflow.functions.schemas import MOVEMENT_OPTIONAL, MOVEMENT_REQUIRED
from caseflow.operators.smallest import counts_and_smallest


class QualityError(RuntimeError):
    """A critical table failed its quality gate."""


# ---- NULL profiles: one aggregate each, whatever the number of columns -----------------


def present_columns(frame: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    """ST3: the wanted columns the frame really has."""
    return [c for c in wanted if c in frame.columns]


def _null_cells(columns: list[str]) -> Column:
    return reduce(add, [F.count_if(F.col(c).isNull()) for c in columns], F.lit(0).cast("bigint"))


def _null_columns(columns: list[str]) -> Column:
    return reduce(add, [F.max(F.col(c).isNull().cast("bigint")) for c in columns],
                  F.lit(0).cast("bigint"))


def _rows_with_null(columns: list[str]) -> Column:
    return F.count_if(reduce(or_, [F.col(c).isNull() for c in columns], F.lit(False)))


def null_profile(frame: DataFrame, name: str) -> DataFrame:
    """AG11: rows, columns, NULL cells, their share, and columns with NULLs."""
    columns = frame.columns
    cells = _null_cells(columns)
    return frame.agg(
        F.lit(name).alias("dataframe"),
        F.count("*").alias("n_linhas"),
        F.lit(len(columns)).cast("bigint").alias("n_colunas"),
        cells.alias("n_celulas_na"),
        F.try_divide(cells, F.count("*") * len(columns)).alias("pct_celulas_na"),
        F.coalesce(_null_columns(columns), F.lit(0)).alias("n_colunas_com_na"),
    )


def strict_quality(frame: DataFrame, name: str) -> DataFrame:
    """AG12: any NULL at all is an error."""
    columns = frame.columns
    rows = _rows_with_null(columns)
    return frame.agg(
        F.lit(name).alias("dataframe"),
        F.count("*").alias("linhas"),
        F.lit(len(columns)).cast("bigint").alias("colunas"),
        rows.alias("linhas_com_na"),
        F.coalesce(_null_columns(columns), F.lit(0)).alias("colunas_com_na"),
        _null_cells(columns).alias("celulas_na"),
        F.when(rows == 0, "OK").otherwise("ERRO").alias("status"),
    )


def movement_quality(movements: DataFrame, name: str = "df_movimentos") -> DataFrame:
    """AG13: NULLs are errors in required columns and allowed in complement columns."""
    required = present_columns(movements, MOVEMENT_REQUIRED)
    optional = present_columns(movements, MOVEMENT_OPTIONAL)
    bad_rows = _rows_with_null(required)
    if optional:
        bare = F.count_if(F.coalesce(*[F.col(c).cast("string") for c in optional]).isNull())
        bare_cells = _null_cells(optional)
    else:
        bare = bare_cells = F.lit(None).cast("bigint")
    counted = movements.agg(
        F.lit(name).alias("dataframe"),
        F.count("*").alias("linhas"),
        bad_rows.alias("linhas_com_na_obrigatorio"),
        _null_cells(required).alias("celulas_na_obrigatorio"),
        bare.alias("linhas_sem_complemento"),
        bare_cells.alias("celulas_na_complemento"),
    )
    ok = F.col("linhas_com_na_obrigatorio") == 0
    return counted.select(
        "dataframe", "linhas", "linhas_com_na_obrigatorio", "celulas_na_obrigatorio",
        F.when(ok, "OK").otherwise("ERRO").alias("status_obrigatorio"),
        "linhas_sem_complemento", "celulas_na_complemento",
        F.lit("OK").alias("status_complemento"),
        F.when(ok, F.concat(F.lit("Obrigatórias OK; "),
                            F.coalesce(F.col("linhas_sem_complemento").cast("string"), F.lit("NA")),
                            F.lit(" linhas sem complemento")))
        .otherwise(F.concat(F.lit("ERRO: "), F.col("linhas_com_na_obrigatorio").cast("string"),
                            F.lit(" linhas com NA em obrigatórias"))).alias("mensagem"),
    )


def stack(*reports: DataFrame) -> DataFrame:
    """ST1: reports under each other, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def quality_gate(report: DataFrame, status: str = "status") -> DataFrame:
    """AG14: raise when a row of a (short) quality report says ERRO."""
    failed = report.filter(F.col(status) == "ERRO").select("dataframe").collect()
    if failed:
        raise QualityError(f"NULLs in critical tables: {', '.join(r.dataframe for r in failed)}")
    return report


def null_gate(columns: list[str]) -> dict[str, Column]:
    """AG14: what a gated write observes (``writers.write_checked``): rows and cells with a NULL in these columns."""
    return {"linhas_com_na": _rows_with_null(columns), "celulas_na": _null_cells(columns)}


def gate_written(written: DataFrame, name: str) -> DataFrame:
    """AG14: raise when a write observed rows with NULLs; reads the one-row report only, never the table."""
    report = written.select(
        F.lit(name).alias("dataframe"), "linhas", "linhas_com_na", "celulas_na",
        F.when(F.col("linhas_com_na") == 0, "OK").otherwise("ERRO").alias("status"))
    return quality_gate(report)


def empty_code_movements(movements: DataFrame) -> DataFrame:
    """AG15: the movements whose code is missing or {} (as rows, never as one list)."""
    code = F.col("movimento_codigo").cast("string")
    return movements.filter(code.isNull() | (code == EMPTY_CODE))


def check_text_time(frame: DataFrame, column: str) -> str | None:
    """AG25: a warning when the raw time column is numeric, so digits may be lost."""
    if isinstance(frame.schema[column].dataType, NumericType):
        return f"{column} is numeric: long digit stamps may have lost precision"
    return None


def numeric_time_losses(frame: DataFrame, columns: list[str]) -> DataFrame:
    """AG25: per raw time column its type, the warning, and how many stamps a number of that type cannot hold exactly.

    A 14-digit stamp needs 47 bits: a float keeps 24, an integer 31, a double 53. A value counts as lost when it is beyond
    what its type counts one by one, or has a fraction.
    """
    # The largest whole number up to which each type holds every whole number.
    exact = {"tinyint": 2 ** 7 - 1, "smallint": 2 ** 15 - 1, "int": 2 ** 31 - 1, "float": 2 ** 24, "double": 2 ** 53}
    parts = []
    for name in columns:
        kind, warning = frame.schema[name].dataType.simpleString(), check_text_time(frame, name)
        value = F.col(name)
        lost = F.lit(False)
        if warning and kind in exact:
            lost = (F.abs(value.cast("double")) >= F.lit(float(exact[kind]))) | (value.cast("double") % 1 != 0)
        parts += [F.count(value).alias(f"n_{name}"), F.count_if(lost).alias(f"p_{name}")]
    counted = frame.agg(*parts)  # all columns in one scan
    rows = F.array(*[F.struct(
        F.lit(name).alias("coluna"), F.lit(frame.schema[name].dataType.simpleString()).alias("tipo"),
        F.col(f"n_{name}").alias("valores"), F.col(f"p_{name}").alias("perdidos"),
        F.lit("AVISO" if check_text_time(frame, name) else "OK").alias("status")) for name in columns])
    return counted.select(F.inline(rows))


# ---- time columns ------------------------------------------------------------------------


def format_profile(frame: DataFrame, column: str, examples: int = 5) -> DataFrame:
    """TS2, JN8, SO3: rows per timestamp pattern and its ``examples`` smallest distinct values, in one scan."""
    value = F.trim(F.col(column).cast("string"))
    classed = frame.select(ts.format_class(value).alias("perfil"), value.alias("valor"))
    return counts_and_smallest(classed, "perfil", "valor", examples).select(
        F.col("grupo").alias("perfil"), "n", F.array_join("valores", " | ").alias("exemplos"))


def parse_report(frame: DataFrame, parsed: str) -> DataFrame:
    """TS4, TS5: parsed and failed counts with the valid range."""
    return frame.agg(
        F.count("*").alias("total"),
        F.count(parsed).alias("parse_ok"),
        F.count_if(F.col(parsed).isNull()).alias("parse_erro"),
        F.min(parsed).alias("min_data"),
        F.max(parsed).alias("max_data"),
    )


# What each midnight combination means.
MIDNIGHT_MEANING = {
    (False, False): "Data com hora na origem (datetime completo)",
    (True, True): "Data sem hora na origem (formato raw ISO com 00:00:00)",
    (True, False): "Data sem hora na origem (formato raw YYYYMMDD000000)",
    (False, True): "Outro caso",
}


def midnight_audit(frame: DataFrame, parsed: str, raw: str) -> DataFrame:
    """TS6, TS12, WN3, PJ13: parsed midnights against midnights written in the raw text.

    Unparsed rows leave after the count (their flag is NULL): a filter before it
    would make Spark parse every time twice.
    """
    flags = frame.select(
        ts.is_midnight(F.col(parsed)).alias("eh_meianoite"),
        F.col(raw).rlike(ts.ISO_MIDNIGHT).alias("raw_meianoite"),
    )
    counts = (
        flags.groupBy("eh_meianoite", "raw_meianoite").agg(F.count("*").alias("qtd"))
        .filter(F.col("eh_meianoite").isNotNull())
    )
    total = F.sum("qtd").over(Window.partitionBy())  # at most four rows
    meaning = F.lit("Outro caso")
    for (parsed_flag, raw_flag), text in MIDNIGHT_MEANING.items():
        here = (F.col("eh_meianoite") == parsed_flag) & (F.col("raw_meianoite") == raw_flag)
        meaning = F.when(here, text).otherwise(meaning)
    return counts.select(
        "eh_meianoite", "raw_meianoite",
        tx.thousands(F.col("qtd")).alias("n"),
        tx.percent_label(F.col("qtd") / total).alias("percentual"),
        meaning.alias("significado"),
    )
