from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseflow.operators import profile, quality

MOVES = "id string, processo string, movimento_codigo string, movimento_nome string, " \
        "movimento_data_hora string, complemento_codigo long, complemento_valor string"


def moves(spark, code):
    return spark.createDataFrame(
        [("1", "p", "26", "n", "t", 1, "v"), ("2", "p", code, "n", "t", None, None), ("3", "p", "{}", "n", "t", 2, None)], MOVES)


def test_role_aware_quality(spark):
    good = quality.movement_quality(moves(spark, "85")).first()
    assert (good.status_obrigatorio, good.linhas_sem_complemento, good.celulas_na_complemento) == ("OK", 1, 3)
    assert good.mensagem == "Obrigatórias OK; 1 linhas sem complemento"
    bad = quality.movement_quality(moves(spark, None))
    assert bad.first().mensagem == "ERRO: 1 linhas com NA em obrigatórias"
    with pytest.raises(quality.QualityError, match="df_movimentos"):
        quality.quality_gate(bad, "status_obrigatorio")
    bare = quality.movement_quality(moves(spark, "85").drop("complemento_codigo", "complemento_valor")).first()
    assert bare.linhas_sem_complemento is None and bare.status_obrigatorio == "OK"


def test_strict_gate_and_null_profile(spark):
    frame = moves(spark, "85")
    report = quality.strict_quality(frame, "df")
    row = report.first()
    assert (row.linhas, row.colunas, row.linhas_com_na, row.colunas_com_na, row.celulas_na, row.status) == (3, 7, 2, 2, 3, "ERRO")
    with pytest.raises(quality.QualityError):
        quality.quality_gate(report)
    assert quality.quality_gate(quality.strict_quality(frame.select("id"), "ok")).first().status == "OK"
    nulls = quality.null_profile(frame, "df").first()
    assert nulls.pct_celulas_na == pytest.approx(3 / 21)
    empty = quality.null_profile(frame.limit(0), "df").first()
    assert (empty.n_linhas, empty.n_celulas_na, empty.pct_celulas_na, empty.n_colunas_com_na) == (0, 0, None, 0)


def test_empty_codes_and_type_guard(spark):
    assert {r.id for r in quality.empty_code_movements(moves(spark, None)).collect()} == {"2", "3"}
    assert quality.check_text_time(spark.createDataFrame([(20230522230301.0,)], "t double"), "t")
    assert quality.check_text_time(spark.createDataFrame([("x",)], "t string"), "t") is None


def test_midnight_audit(spark):
    rows = [("2024-01-01T00:00:00.000Z", datetime(2024, 1, 1)), ("20240101000000", datetime(2024, 1, 1)),
            ("20240101101010", datetime(2024, 1, 1, 10, 10, 10)), ("x", None)]
    got = quality.midnight_audit(spark.createDataFrame(rows, "raw string, t timestamp"), "t", "raw").collect()
    assert {(r.eh_meianoite, r.raw_meianoite, r.n, r.percentual) for r in got} == {
        (True, True, "1", "33.3%"), (True, False, "1", "33.3%"), (False, False, "1", "33.3%")}


def test_profile_examples(spark):
    frame = spark.createDataFrame([(f"2024071{i}",) for i in range(8)] * 2 + [(" ",), (None,)], "x string")
    got = {r.perfil: (r.n, r.exemplos) for r in quality.format_profile(frame, "x").collect()}
    assert got["num_yyyymmdd"] == (16, " | ".join(f"2024071{i}" for i in range(5)))
    assert got["vazio/NA"][0] == 2


def test_duplicates_and_codes(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "processo string")
    assert [tuple(r) for r in profile.duplicate_report(frame, "processo").collect()] == [("a", 2)]
    assert tuple(profile.duplicate_summary(frame, "processo").first()) == (3, 2, 1)
    records = spark.createDataFrame([("1, 2",), ("2",), ("",), (None,)], "codigos string")
    assert tuple(profile.code_presence(records, "codigos").first()) == (2, 2, 2)
    assert [tuple(r) for r in profile.code_frequency(records, "codigos").collect()] == [("2", 2, 50.0), ("1", 1, 25.0)]
    fill = {r.campo: r.preenchidos for r in profile.field_fill(records.withColumn("x", F.lit(1))).collect()}
    assert fill == {"codigos": 2, "x": 4}


def test_case_profile_has_one_row_per_tribunal(spark):
    cases = spark.createDataFrame(
        [("p1", "A", "c", 1, 2020, datetime(2020, 1, 1)), ("p1", "B", "c", 2, 2021, datetime(2021, 1, 1, 5))],
        "processo string, tribunal string, classe_nome string, orgao_julgador_municipio_ibge int, "
        "ano_ajuizamento int, data_ajuizamento timestamp")
    rows = profile.case_profile(cases).collect()
    assert {r.tribunal for r in rows} == {"A", "B"}
    assert {(r.n_processos, r.n_processos_uniq, r.n_tribunais, r.pct_sem_hora) for r in rows} == {(2, 1, 2, 0.5)}
