"""Judge time: from the latest conclusion to each judge movement (JN7, AG21, AG22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow import constants as k
from caseflow.functions import timestamps as ts
from caseflow.operators.panel import complete_series, specialised
from caseflow.operators.series import decompose
from caseflow.operators.skew import DEFAULT_RULE, HotKeyRule, previous_time


# What makes a row of the movement table a movement of its own; the other columns repeat it per complement.
MOVEMENT = ["processo", "movimento_codigo", "movimento_data_hora"]


def one_per_movement(movements: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per movement: movement rows repeat per complement, decisions are counted once."""
    return movements.dropDuplicates(key or MOVEMENT)


def judge_deltas(
    movements: DataFrame,
    ties: list[Column],
    judge: Column | None = None,
    conclusion: Column | None = None,
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """JN7: days from the nearest earlier conclusion row to each judge movement.

    A judge movement with no earlier conclusion drops out; a conclusion counts
    only when it is an earlier row, not the row itself.
    """
    judge = F.col("movimento_codigo_1") == k.ROOT_JUDGE if judge is None else judge
    conclusion = F.col("movimento_codigo_3") == k.CONCLUSION if conclusion is None else conclusion
    relevant = movements.filter(judge | conclusion)
    matched = previous_time(
        relevant, "processo", "movimento_data_hora", ties, "data_conclusao",
        when=conclusion, rule=rule)
    return matched.filter(judge & F.col("data_conclusao").isNotNull()).withColumn(
        "delta_magistrado", ts.days_between(F.col("data_conclusao"), F.col("movimento_data_hora")))


def with_case_columns(deltas: DataFrame, cases: DataFrame) -> DataFrame:
    """Filing month and court of each delta's case: of repeated case rows, the first filing's."""
    first = F.min(F.struct("mes_ajuizamento", "orgao_julgador_codigo")).alias("_caso")
    one = cases.groupBy("processo").agg(first).select("processo", "_caso.*")
    return deltas.join(one, "processo")


def _populations(deltas: DataFrame, spec: tuple[int, ...]) -> DataFrame:
    """Each delta under 'todos', and again under 'especializadas' where it belongs."""
    names = F.when(specialised(spec), F.array(F.lit("todos"), F.lit("especializadas"))).otherwise(
        F.array(F.lit("todos")))
    return deltas.withColumn("populacao", F.explode(names))


def viscosity_totals(deltas: DataFrame, spec: tuple[int, ...] = k.SPECIALISED_COURTS) -> DataFrame:
    """AG21: cases, judge decisions and summed deltas, for all and specialised courts.

    Summed per case first, so the distinct count of cases is a plain count.
    """
    per_case = _populations(deltas, spec).groupBy("populacao", "processo").agg(
        F.count("*").alias("_n"), F.sum("delta_magistrado").alias("_days"))
    return per_case.groupBy("populacao").agg(
        F.count("*").alias("processos"), F.sum("_n").alias("decisoes"),
        F.sum("_days").alias("viscosidade_dias"))


def viscosity_by_filing_month(deltas: DataFrame, spec: tuple[int, ...] = k.SPECIALISED_COURTS) -> DataFrame:
    """AG22 A: summed deltas of the cases filed in each month."""
    return _populations(deltas, spec).groupBy("populacao", F.col("mes_ajuizamento").alias("mes")).agg(
        F.count("*").alias("decisoes"), F.sum("delta_magistrado").alias("viscosidade_dias"))


def viscosity_by_decision_month(deltas: DataFrame, spec: tuple[int, ...] = k.SPECIALISED_COURTS) -> DataFrame:
    """AG22 B: summed deltas of the decisions made in each month."""
    month = ts.month_start(F.col("movimento_data_hora"))
    return _populations(deltas, spec).groupBy("populacao", month.alias("mes")).agg(
        F.count("*").alias("decisoes"), F.sum("delta_magistrado").alias("viscosidade_dias"))


def cohort_series(by_filing: DataFrame, by_decision: DataFrame) -> DataFrame:
    """Both judge-time cohorts as gap-free monthly series (serie, mes, n): days, 0 in months without decisions."""
    def labelled(cohort: DataFrame, name: str) -> DataFrame:
        return cohort.filter(F.col("mes").isNotNull()).select(
            F.concat_ws(":", F.lit(name), "populacao").alias("serie"), "mes", F.col("viscosidade_dias").alias("n"))

    both = labelled(by_filing, "ajuizamento").unionByName(labelled(by_decision, "decisao"))
    return complete_series(both, "mes", ["serie"])


def decomposed_cohorts(by_filing: DataFrame, by_decision: DataFrame) -> DataFrame:
    """Q19: trend, seasonal part and remainder of both cohort series, for all and for specialised courts."""
    return decompose(cohort_series(by_filing, by_decision), "serie")
