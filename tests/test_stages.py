"""The three flows end to end on small landed files."""

import json
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_nested import DOCUMENTS
from test_responses import BODY

from caseflow.operators.quality import QualityError
from caseflow.plans import stages


def document(number, *moves):
    return {"id": f"T_{number}", "numeroProcesso": number, "classe": {"codigo": 108, "nome": "Falência"},
            "dataAjuizamento": "20230522230301", "orgaoJulgador": {"codigo": 26404, "nome": "V", "codigoMunicipioIBGE": 41},
            "tribunal": "T", "grau": "G1", "assuntos": [{"codigo": 1, "nome": "a"}],
            "movimentos": [{"codigo": c, "nome": str(c), "dataHora": t} for c, t in moves]}


def test_case_and_judge_time_flow(spark, tmp_path):
    landing, parsed, cleaned, out = (str(tmp_path / n) for n in ("landing", "parsed", "cleaned", "out"))
    (tmp_path / "landing").mkdir()
    lines = [document("01", (51, "2024-01-01T00:00:00.000Z"), (200, "20240103000000"), (201, "20240104000000")),
             document("02", (200, "20240101000000"), ({}, "20240102000000"))]
    (tmp_path / "landing" / "raw_1.ndjson").write_text("\n".join(map(json.dumps, lines)) + '\n{"id": "cut')
    assert stages.parse_documents(spark, landing, parsed).count() == 1
    reports = stages.quality_reports(spark, parsed)
    assert reports["empty_codes"].count() == 1
    assert {r.perfil: r.n for r in reports["movement_formats"].collect()} == {"iso8601_Z": 1, "num_yyyymmddhhmmss": 4}
    names = spark.createDataFrame([(41, "Curitiba", "Metropolitana")],
                                  "orgao_julgador_municipio_ibge long, municipio_nome string, municipio_mesorregiao string")
    stages.clean_tables(spark, parsed, cleaned, names)
    assert spark.read.parquet(f"{cleaned}/processos").first().municipio_nome == "Curitiba"
    rows = [(1, None), (14, None), (193, 1), (200, 193), (201, 193), (48, 14), (51, 48)]
    taxonomy = spark.createDataFrame([(i, p, f"n{i}") for i, p in rows], "id long, cod_item_pai long, nome string")
    stages.judge_time_tables(spark, cleaned, taxonomy, out)
    totals = {r.populacao: (r.processos, r.decisoes, r.viscosidade_dias) for r in spark.read.parquet(f"{out}/viscosidade").collect()}
    assert totals == {"todos": (1, 2, 5.0), "especializadas": (1, 2, 5.0)}
    assert spark.read.parquet(f"{out}/viscosidade_decisao").count() == 2
    stages.decompose_judge_time(spark, out)
    parts = spark.read.parquet(f"{out}/viscosidade_series").filter("componente = 'observed'").collect()
    assert {(r.serie, r.valor, r.motivo) for r in parts} == {
        (f"{c}:{p}", 5.0, "fewer than two full periods") for c in ("ajuizamento", "decisao") for p in ("todos", "especializadas")}


def test_case_list_leads_from_one_flow_to_the_other(spark, tmp_path):
    parsed, listed, organised, out = (str(tmp_path / n) for n in ("parsed", "listed", "organised", "out"))
    spark.createDataFrame([("0001",), ("0002",), ("0002",), ("0003",)], "processo string").write.parquet(f"{parsed}/processos")
    assert tuple(stages.export_case_list(spark, parsed, listed).first()) == (4, 3, 1)
    assert [tuple(r) for r in spark.read.parquet(f"{listed}/duplicatas").collect()] == [("0002", 2)]
    spark.createDataFrame([(("00-01",), "a"), (("0002",), "b"), (("0002",), "c"), (("0009",), "d"), ((None,), "e")],
                          "metadados struct<numero_processo: string>, x string").write.parquet(organised)
    assert tuple(stages.match_case_list(spark, listed, organised, out).first()) == (2, 3, pytest.approx(2 / 3))
    assert {r.x for r in spark.read.parquet(f"{out}/documentos").collect()} == {"a", "b", "c"}
    assert [r.processo for r in spark.read.parquet(f"{out}/faltantes").collect()] == ["0003"]


def test_analysis_of_cleaned_tables(spark, tmp_path):
    """Thirty months of cases: each admitted or refused after a receipt, every third archived."""
    cleaned, out, fitted = (str(tmp_path / n) for n in ("cleaned", "out", "fitted"))
    cases = spark.range(600).select(
        F.format_string("%04d", "id").alias("processo"), F.add_months(F.lit("2022-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("mes_ajuizamento"),
        F.when(F.col("id") % 4 == 0, 26404).otherwise(F.col("id") % 3).cast("long").alias("orgao_julgador_codigo"),
        F.when(F.col("id") % 4 == 0, "Falências").otherwise(F.concat(F.lit("Vara "), (F.col("id") % 3).cast("string"))).alias("orgao_julgador_nome"),
        F.lit("Curitiba").alias("municipio_nome")).withColumn("data_ajuizamento", F.col("mes_ajuizamento").cast("timestamp"))
    cases.write.parquet(f"{cleaned}/processos")

    def moves(code, days, keep):
        return cases.filter(keep).select(
            "processo", F.lit(code).alias("movimento_codigo"),
            (F.col("data_ajuizamento") + F.make_dt_interval(F.lit(days) + F.col("processo").cast("int") % 7)).alias("movimento_data_hora"))

    number = F.col("processo").cast("int")
    likely = F.pmod(F.xxhash64("processo"), F.lit(60)) < 10 + F.months_between("mes_ajuizamento", F.lit("2022-01-01"))
    rows = [moves("132", 1, F.lit(True)), moves("430", 20, likely), moves("433", 20, ~likely), moves("246", 90, number % 3 == 0),
            moves("941", 30, number % 10 == 0)]
    reduce(DataFrame.unionByName, rows).write.parquet(f"{cleaned}/movimentos")
    stages.analysis_tables(spark, cleaned, out, "2022-01-01", "2024-06-01", since="2023-01-01")
    read = {p.name: spark.read.parquet(str(p)) for p in (tmp_path / "out").iterdir()}
    assert len(read) == 20
    assert read["ajuizados_grupo"].agg(F.sum("n")).first()[0] == 600 and len(read["ajuizados_mes"].columns) == 32
    assert read["arquivamento"].filter("status_arquivamento_definitivo").count() == 200
    assert read["acervo"].agg(F.sum("quantidade_processos_ajuizados")).first()[0] == 450
    assert read["decisoes"].count() == read["duracoes"].count() == 600
    assert read["duracoes_resumo"].first().mediana == 19.0
    assert read["incompetencia"].count() == read["incompetencia_mes"].agg(F.sum("n")).first()[0]
    stl = read["decisoes_stl"].groupBy("data").pivot("componente").agg(F.first("valor"))
    assert stl.filter("abs(observed - trend - seasonal - remainder) < 1e-9").count() == read["decisoes_mes"].count()
    stages.admission_models(spark, out, fitted, "2022-01-01")
    slope = spark.read.parquet(f"{fitted}/coeficientes").filter("modelo = 'linear' AND termo = 't'").first()
    assert slope.estimativa > 2 * slope.erro_padrao > 0
    assert spark.read.parquet(f"{fitted}/probabilidade").count() == 200


def test_quality_stage_stops_on_gaps(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.ndjson").write_text("\n".join(map(json.dumps, DOCUMENTS)))
    stages.parse_documents(spark, str(tmp_path / "landing"), str(tmp_path / "parsed"))
    with pytest.raises(QualityError, match="df_processos"):
        stages.quality_reports(spark, str(tmp_path / "parsed"))


def test_service_flow(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name, body in (("1", BODY), ("2", "<cut")):
        (tmp_path / "raw" / f"{name}_raw.json").write_text(json.dumps({
            "numero_processo": name, "timestamp": "20240131_101112", "resposta_raw": body, "metadata": {"encoding": "utf-8"}}, indent=1))
    bad = stages.organise_responses(spark, str(tmp_path / "raw"), str(tmp_path / "organised"))
    assert [r.numero_processo for r in bad.collect()] == ["2"]
    out = str(tmp_path / "out")
    stages.service_tables(spark, str(tmp_path / "organised"), out)
    case = spark.read.parquet(f"{out}/processos").first()
    assert (case.numero_processo, case.arquivo_origem, case.valor_causa) == ("1", "1_raw.json", 10.5)
    assert spark.read.parquet(f"{out}/movimentos").count() == 3
    assert spark.read.parquet(f"{out}/partes").count() == 0
    assert spark.read.parquet(f"{out}/arvore").filter(F.col("eh_folha")).count() == 1
