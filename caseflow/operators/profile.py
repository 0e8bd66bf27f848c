"""Table profiles and run reports (AG6-AG10, AG16-AG20, AG24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import text as tx
from caseflow.functions import timestamps as ts
from caseflow.operators.nested import unnest
from caseflow.operators.quantiles import quantiles_of_counts, value_counts
from caseflow.session import settle


def _combinations(frame: DataFrame, columns: list[str], *sums: Column) -> DataFrame:
    """Rows and ``sums`` per combination of the columns, stored: the only scan of ``frame`` a profile makes.

    Equal rows are combined before the shuffle, and a DISTINCT of one column then reads these combinations.
    """
    return settle(frame.groupBy(*columns).agg(F.count("*").alias("_n"), *sums))


def _distinct_values(combinations: DataFrame, column: str) -> Column:
    """How many values the column has: an aggregate of its own, since several DISTINCTs in one multiply every row."""
    return combinations.filter(F.col(column).isNotNull()).select(column).distinct().agg(F.count("*")).scalar()


def _with_distinct(totals: DataFrame, combinations: DataFrame, columns: dict[str, str]) -> DataFrame:
    return totals.withColumns({name: _distinct_values(combinations, column) for name, column in columns.items()})


def _rows() -> Column:
    return F.coalesce(F.sum("_n"), F.lit(0).cast("bigint"))


def case_profile(cases: DataFrame) -> DataFrame:
    """AG6: one row per tribunal next to table-wide totals; one scan of the cases."""
    midnight = ts.is_midnight(F.col("data_ajuizamento"))
    distinct = {"n_processos_uniq": "processo", "n_tribunais": "tribunal", "n_classes": "classe_nome",
                "n_municipios": "orgao_julgador_municipio_ibge"}
    found = _combinations(
        cases, list(distinct.values()),
        F.min("ano_ajuizamento").alias("ano_min"), F.max("ano_ajuizamento").alias("ano_max"),
        F.min("data_ajuizamento").alias("data_min"), F.max("data_ajuizamento").alias("data_max"),
        F.count_if(midnight).alias("_midnight"), F.count(midnight).alias("_timed"))
    totals = _with_distinct(found.agg(
        _rows().alias("n_processos"),
        F.min("ano_min").alias("ano_min"), F.max("ano_max").alias("ano_max"),
        F.min("data_min").alias("data_min"), F.max("data_max").alias("data_max"),
        F.try_divide(F.sum("_midnight"), F.sum("_timed")).alias("pct_sem_hora"),
    ), found, distinct).select(
        "n_processos", "n_processos_uniq", "n_tribunais", "n_classes", "n_municipios",
        "ano_min", "ano_max", "data_min", "data_max", "pct_sem_hora")
    return found.select("tribunal").distinct().select(
        "tribunal", totals.select(F.struct(*totals.columns)).scalar().alias("_t")).select("tribunal", "_t.*")


def movement_profile(movements: DataFrame) -> DataFrame:
    """AG7; one scan of the movements."""
    distinct = {"n_processos_uniq": "processo", "n_tipos_movimento": "movimento_codigo"}
    found = _combinations(
        movements, list(distinct.values()),
        F.min("movimento_data_hora").alias("data_min"), F.max("movimento_data_hora").alias("data_max"),
        F.count("complemento_codigo").alias("_with"))
    return _with_distinct(found.agg(
        _rows().alias("n_movimentos"), F.min("data_min").alias("data_min"), F.max("data_max").alias("data_max"),
        F.try_divide(F.sum("_with"), F.sum("_n")).alias("pct_com_complemento"),
    ), found, distinct).select(
        "n_processos_uniq", "n_movimentos", "n_tipos_movimento", "data_min", "data_max",
        F.try_divide("n_movimentos", "n_processos_uniq").alias("media_mov_processo"), "pct_com_complemento")


def subject_profile(subjects: DataFrame) -> DataFrame:
    """AG8; one scan of the subjects."""
    distinct = {"n_processos_uniq": "processo", "n_assuntos_uniq": "assunto_codigo"}
    found = _combinations(subjects, list(distinct.values()))
    return _with_distinct(found.agg(_rows().alias("n_assuntos")), found, distinct).select(
        "n_processos_uniq", "n_assuntos", "n_assuntos_uniq",
        F.try_divide("n_assuntos", "n_processos_uniq").alias("media_assuntos_processo"))


def distinct_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """AG9: the distinct case list."""
    return frame.select(*keys).distinct()


def duplicate_report(frame: DataFrame, *keys: str) -> DataFrame:
    """AG10, FL8: keys that occur more than once, most frequent first."""
    return (
        frame.groupBy(*keys).agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1).orderBy(F.desc("n"), *keys)
    )


def duplicate_summary(frame: DataFrame, *keys: str) -> DataFrame:
    """AG10: total, distinct and surplus rows from one pre-aggregate."""
    return frame.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_registros"),
        F.count("*").alias("processos_unicos"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("duplicatas"))


def code_frequency(records: DataFrame, column: str, top: int = 5) -> DataFrame:
    """AG16, SO2: most frequent codes of a comma-separated field, with % of records."""
    total = records.agg(F.count("*")).scalar()
    codes = unnest(records, [], tx.list_items(F.col(column)), "codigo")
    return (
        codes.groupBy("codigo").agg(F.count("*").alias("frequencia"))
        .orderBy(F.desc("frequencia"), "codigo").limit(top)
        .withColumn("percentual", F.col("frequencia") * 100 / total)
    )


def code_presence(records: DataFrame, column: str) -> DataFrame:
    """AG16: records with and without codes, and distinct codes."""
    with_codes = F.coalesce(F.col(column) != "", F.lit(False))
    counts = records.agg(
        F.count_if(with_codes).alias("com_codigos"), F.count_if(~with_codes).alias("sem_codigos"))
    codes = unnest(records, [], tx.list_items(F.col(column)), "codigo")
    return counts.withColumn("codigos_unicos", codes.agg(F.count_distinct("codigo")).scalar())


def field_fill(records: DataFrame, top: int = 10) -> DataFrame:
    """AG17: fields by how often they hold a value.  NULL and '' both count as empty."""
    filled = [
        F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(c)
        for c in records.columns
    ]
    one_row = records.agg(F.count("*").alias("_total"), *filled)
    return (
        one_row.unpivot(["_total"], records.columns, "campo", "preenchidos")
        .withColumn("percentual", F.try_divide(F.col("preenchidos") * 100, F.col("_total")))
        .orderBy(F.desc("preenchidos"), "campo").limit(top).drop("_total")
    )


def run_report(run_log: DataFrame) -> DataFrame:
    """AG18: success rate and throughput of a run from its per-case log."""
    ok = F.count_if(F.col("status") == "ok")
    seconds = (F.max(F.unix_micros("fim")) - F.min(F.unix_micros("inicio"))) / F.lit(1e6)
    return run_log.agg(
        F.count("*").alias("processos_totais"),
        F.count_if(F.col("baixado")).alias("downloads"),
        ok.alias("processados"),
        F.count_if(F.col("status") == "erro").alias("erros"),
        F.try_divide(ok * 100.0, F.count("*")).alias("taxa_sucesso"),
        F.when(seconds > 0, ok / seconds).alias("processos_por_segundo"),
    )


def fill_rates(enriched: DataFrame) -> DataFrame:
    """AG20: extraction rates.  An empty role is a miss, an empty administrator a hit."""
    def filled(column: str):
        return F.count_if(F.coalesce(F.col(column), F.lit("")) != "")

    prefix = "complemento_projudi_descricao_"
    counts = {
        "parte_nome": filled(prefix + "parte_nome"),
        "parte_especie": filled(prefix + "parte_especie"),
        "administrador_judicial": F.count(prefix + "administrador_judicial"),
    }
    return enriched.agg(
        F.count("*").alias("linhas"),
        *[c.alias(f"n_{name}") for name, c in counts.items()],
        *[F.round(F.try_divide(c * 100, F.count("*")), 1).alias(f"pct_{name}") for name, c in counts.items()],
    )


_QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


def column_summary(frame: DataFrame, columns: list[str]) -> DataFrame:
    """AG24, AG19: count, minimum, quartiles, mean and maximum of numeric columns.

    All columns go through one pass: values are counted per column, and the quartiles come from the counts.
    """
    long = frame.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "coluna", "valor")
    counts = value_counts(long, ["coluna"], "valor")
    basics = counts.groupBy("coluna").agg(
        F.sum("_n").alias("n"), F.min("_v").alias("minimo"),
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("media"), F.max("_v").alias("maximo"))
    return basics.join(quantiles_of_counts(counts, ["coluna"], _QUARTILES), "coluna")


def coverage_ratio(matched: DataFrame, all_rows: DataFrame) -> DataFrame:
    """AG19: share of rows that found a match."""
    counted = matched.agg(F.count("*").alias("encontrados")).withColumn(
        "total", all_rows.agg(F.count("*")).scalar())
    return counted.withColumn("cobertura", F.try_divide(F.col("encontrados"), F.col("total")))
