"""The three flows of the study as stages that read and write stored tables.

Each stage reads the tables of the one before it, so that any stage can be run
again alone, and a lost executor costs one stage at most.  Paths are folders of
versions: a stage never overwrites what it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow import constants as k
from caseflow.operators import (events, hierarchy, models, nested, panel, parties, profile, quality, responses, series, tree,
                                viscosity)
from caseflow.session import prepare
from caseflow.sources import readers, writers

PARSED = ("processos", "assuntos", "movimentos")


def parse_documents(spark: SparkSession, landing: str, parsed: str) -> DataFrame:
    """Landed case documents to the three flat tables; returns the rejected lines.

    The text is parsed once, into a nested table; each flat table then reads
    only the nested columns it needs.
    """
    landed = readers.read_case_lines(prepare(spark), landing)
    writers.write_parquet(landed, f"{parsed}/documentos")
    documents, rejected = readers.split_rejects(spark.read.parquet(f"{parsed}/documentos"))
    writers.write_parquet(nested.case_table(documents), f"{parsed}/processos")
    writers.write_parquet(nested.subject_table(documents), f"{parsed}/assuntos")
    writers.write_parquet(nested.movement_table(documents), f"{parsed}/movimentos")
    return rejected


def quality_reports(spark: SparkSession, parsed: str) -> dict[str, DataFrame]:
    """The checks that precede cleaning; raises when a required table or column has gaps."""
    readers.check_required_inputs(prepare(spark), parsed, list(PARSED))
    tables = {name: spark.read.parquet(f"{parsed}/{name}") for name in PARSED}
    strict = quality.stack(*[quality.strict_quality(tables[n], f"df_{n}") for n in ("processos", "assuntos")])
    roles = quality.movement_quality(tables["movimentos"])
    return {
        "nulls": quality.stack(*[quality.null_profile(t, f"df_{n}") for n, t in tables.items()]),
        "strict": quality.quality_gate(strict),
        "movements": quality.quality_gate(roles, "status_obrigatorio"),
        "empty_codes": quality.empty_code_movements(tables["movimentos"]),
        "filing_formats": quality.format_profile(tables["processos"], "data_ajuizamento"),
        "movement_formats": quality.format_profile(tables["movimentos"], "movimento_data_hora"),
    }


def clean_tables(spark: SparkSession, parsed: str, cleaned: str, municipalities: DataFrame) -> None:
    """Parsed tables to cleaned ones: times, month and year, municipality names."""
    prepare(spark)
    cases = nested.add_municipality(
        nested.clean_cases(spark.read.parquet(f"{parsed}/processos")), municipalities)
    writers.write_parquet(cases, f"{cleaned}/processos")
    writers.write_parquet(
        nested.clean_movements(spark.read.parquet(f"{parsed}/movimentos")), f"{cleaned}/movimentos")
    writers.write_parquet(spark.read.parquet(f"{parsed}/assuntos"), f"{cleaned}/assuntos")


def organise_responses(spark: SparkSession, raw: str, organised: str) -> DataFrame:
    """Stored XML responses to organised documents; returns the unreadable ones."""
    parsed = responses.parse_responses(readers.read_raw_responses(prepare(spark), raw).drop("_corrupt_record"))
    good, bad = readers.split_rejects(parsed)
    documents = responses.organise_responses(good, F.col("_arquivo"))
    writers.write_parquet(documents.withColumn("_arquivo", F.col("metadados.arquivo_origem")), organised)
    return bad


def service_tables(spark: SparkSession, organised: str, out: str) -> None:
    """Organised documents to the case, movement, party and tree tables."""
    documents = prepare(spark).read.parquet(organised)
    writers.write_parquet(nested.service_case_table(documents), f"{out}/processos")
    writers.write_parquet(nested.service_movement_table(documents), f"{out}/movimentos")
    enriched = parties.enrich_movements(spark.read.parquet(f"{out}/movimentos"))
    writers.write_parquet(enriched, f"{out}/movimentos_partes")
    writers.write_parquet(parties.party_table(spark.read.parquet(f"{out}/movimentos_partes")), f"{out}/partes")
    trees = writers.write_parquet(tree.tree_of_document(documents), f"{out}/arvores_texto")
    writers.write_parquet(tree.flatten_trees(spark.read.parquet(trees)), f"{out}/arvore")


def judge_time_tables(
    spark: SparkSession, cleaned: str, taxonomy: DataFrame, out: str,
    spec: tuple[int, ...] = k.SPECIALISED_COURTS,
) -> None:
    """Cleaned tables and the taxonomy to enriched movements and the judge-time tables."""
    prepare(spark)
    movements = spark.read.parquet(f"{cleaned}/movimentos")
    lookup = hierarchy.code_lookup(taxonomy)
    writers.write_parquet(hierarchy.enrich_movements(movements, lookup), f"{out}/movimentos_tpu")
    enriched = spark.read.parquet(f"{out}/movimentos_tpu")
    deltas = viscosity.with_case_columns(
        viscosity.judge_deltas(viscosity.one_per_movement(enriched), [F.col("movimento_codigo")]),
        spark.read.parquet(f"{cleaned}/processos"))
    writers.write_parquet(deltas, f"{out}/deltas")
    stored = spark.read.parquet(f"{out}/deltas")
    writers.write_parquet(hierarchy.root_report(enriched), f"{out}/classes_raiz")
    writers.write_parquet(viscosity.viscosity_totals(stored, spec), f"{out}/viscosidade")
    writers.write_parquet(viscosity.viscosity_by_filing_month(stored, spec), f"{out}/viscosidade_ajuizamento")
    writers.write_parquet(viscosity.viscosity_by_decision_month(stored, spec), f"{out}/viscosidade_decisao")


def decompose_judge_time(spark: SparkSession, out: str) -> None:
    """Q19: the two cohort tables of ``judge_time_tables`` as decomposed monthly series."""
    tables = [prepare(spark).read.parquet(f"{out}/viscosidade_{name}") for name in ("ajuizamento", "decisao")]
    writers.write_parquet(viscosity.decomposed_cohorts(*tables), f"{out}/viscosidade_series")


def export_case_list(spark: SparkSession, parsed: str, path: str) -> DataFrame:
    """Q20: the distinct case numbers of the parsed cases as CSV, the way from the first flow to the second.

    Returns the count of rows, of distinct cases and of surplus rows; the repeated cases are written beside the list.
    """
    cases = prepare(spark).read.parquet(f"{parsed}/processos")
    writers.write_csv(profile.distinct_keys(cases, "processo"), f"{path}/processos")
    writers.write_parquet(profile.duplicate_report(cases, "processo"), f"{path}/duplicatas")
    return profile.duplicate_summary(cases, "processo")


def match_case_list(spark: SparkSession, path: str, organised: str, out: str) -> DataFrame:
    """The organised documents of listed cases, and the listed cases that the service has not delivered.

    Case numbers are compared by their digits, as one source writes them with punctuation. Returns the coverage.
    """
    def digits(number: str) -> Column:
        return F.regexp_replace(number, "[^0-9]", "")

    listed = readers.read_case_list(prepare(spark), f"{path}/processos").select(digits("processo").alias("processo")).distinct()
    documents = spark.read.parquet(organised).withColumn("processo", digits("metadados.numero_processo"))
    writers.write_parquet(documents.join(listed, "processo", "left_semi"), f"{out}/documentos")
    delivered = spark.read.parquet(f"{out}/documentos").select("processo").distinct()
    writers.write_parquet(listed.join(delivered, "processo", "left_anti"), f"{out}/faltantes")
    return profile.coverage_ratio(delivered, listed)


def analysis_tables(
    spark: SparkSession, cleaned: str, out: str, first: str, last: str, since: str = "2024-01-01",
    spec: tuple[int, ...] = k.SPECIALISED_COURTS,
) -> None:
    """Q1-Q16 and Q18 on the cleaned tables: every table of the study's panels, event logic and series.

    ``first`` and ``last`` bound the month grid; ``since`` starts the lists of recent cases.
    """
    prepare(spark)
    cases = spark.read.parquet(f"{cleaned}/processos")
    movements = spark.read.parquet(f"{cleaned}/movimentos")
    ties = [F.col("movimento_codigo").desc_nulls_last()]

    def stored(name: str, frame: DataFrame) -> DataFrame:
        return spark.read.parquet(writers.write_parquet(frame, f"{out}/{name}"))

    wide = stored("ajuizados_mes", panel.filings_wide(cases, spec, first, last))
    stored("ajuizados_grupo", panel.filings_long(wide, "grupo", first, last))
    stored("ajuizados_vara", panel.filings_long(wide, "orgao_label", first, last))
    stored("nao_especializadas_mes", panel.other_courts_wide(cases, spec, since))
    stored("nao_especializadas_lista", panel.other_courts_list(cases, spec, since))
    flagged = stored("incompetencia", events.cases_with_movement(movements, cases, since=since))
    stored("incompetencia_mes", panel.flagged_by_month(flagged))
    archived = stored("arquivamento", events.with_existence_flag(cases, movements))
    stored("acervo", panel.backlog_by_court(archived, spec))
    flow = stored("fluxo", panel.monthly_flow(cases, movements, spec, first, last, distinct_movements=True))
    stored("fluxo_conferencia", panel.flow_check(flow))
    stored("transito", events.last_status(movements, ties))
    decisions = stored("decisoes", events.latest_decisions(movements, ties))
    monthly = stored("decisoes_mes", panel.complete_series(
        panel.monthly_counts(decisions, "data_decisao").withColumn("serie", F.lit("decisoes")), "mes", ["serie"]))
    durations = stored("duracoes", events.receipt_to_latest_decision(movements, decisions))
    stored("duracoes_mes", panel.duration_stats(durations, ["ano_mes_decisao"]))
    stored("duracoes_status", panel.duration_stats(durations, ["ano_mes_decisao", "status"], p90=False))
    stored("duracoes_resumo", profile.column_summary(durations, ["tempo_dias"]))
    stored("taxa_admissao", panel.status_rate(decisions, "Admitido", first))
    stored("decisoes_stl", series.decompose(monthly, "serie"))


def admission_models(spark: SparkSession, analysed: str, out: str, origin: str) -> None:
    """Q17: the admission models on the decisions of ``analysis_tables``; raises where a fit does not settle."""
    decisions = prepare(spark).read.parquet(f"{analysed}/decisoes")
    data = models.binary_response(decisions, "Admitido", origin)
    knots = models.spline_knots(data)
    trend, spline = models.fit_trend(data), models.fit_spline(data, knots)
    writers.write_parquet(
        models.coefficient_table(spark, trend).unionByName(models.coefficient_table(spark, spline)), f"{out}/coeficientes")
    writers.write_parquet(models.fit_table(spark, trend, spline), f"{out}/ajustes")
    writers.write_parquet(models.odds_table(spark, data, trend), f"{out}/razao_chances")
    writers.write_parquet(models.prediction_grid(data, spline, knots, origin), f"{out}/probabilidade")
    writers.write_parquet(models.segmented_table(spark, models.fit_segmented(data)), f"{out}/quebra")
