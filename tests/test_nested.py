import json

import pytest
from pyspark.sql import functions as F

from caseflow.functions import text as tx
from caseflow.operators import nested
from caseflow.sources import readers

DOCUMENTS = [
    {"id": "T_1", "numeroProcesso": "00000000000000000001", "classe": {"codigo": 108, "nome": "Falência"},
     "dataAjuizamento": "20230522230301", "orgaoJulgador": {"codigo": 7, "nome": "Vara", "codigoMunicipioIBGE": 41},
     "tribunal": "T", "grau": "G1", "assuntos": [{"codigo": 1, "nome": 'a "b"'}, {"codigo": 2, "nome": "c"}],
     "movimentos": [
         {"codigo": 26, "nome": 'Dist "x"', "dataHora": "2024-03-19T11:05:46.000Z"},
         {"codigo": {}, "nome": "vazio", "dataHora": "2024-03-20T00:00:00.000Z", "complementosTabelados": []},
         {"codigo": 85, "nome": "dois", "dataHora": "x", "complementosTabelados": [
             {"codigo": 5, "nome": "n1", "valor": 3, "descricao": "d1"},
             {"codigo": 6, "nome": "n2", "valor": {}, "descricao": "d2"}]}]},
    {"id": "T_2", "numeroProcesso": "00000000000000000002", "assuntos": []},
]


@pytest.fixture()
def documents(spark):
    frame = spark.createDataFrame([(json.dumps(d),) for d in DOCUMENTS], "texto string")
    return readers.parse_case_text(frame, "texto")


def test_case_without_optional_fields_is_kept(documents):
    rows = nested.case_table(documents).orderBy("id").collect()
    assert [r.processo for r in rows] == ["00000000000000000001", "00000000000000000002"]
    assert rows[0].classe_codigo == 108 and rows[1].classe_codigo is None


def test_subjects_vanish_with_their_list(documents):
    rows = nested.subject_table(documents).orderBy("assunto_codigo").collect()
    assert [(r.id, r.assunto_codigo, r.assunto_nome) for r in rows] == [("T_1", 1, "a b"), ("T_1", 2, "c")]


def test_movements_keep_rows_without_complement(documents):
    rows = nested.movement_table(documents).collect()
    found = sorted((r.movimento_codigo, r.complemento_codigo or 0, r.complemento_valor or "") for r in rows)
    assert found == [("26", 0, ""), ("85", 5, "3"), ("85", 6, "{}"), ("{}", 0, "")]
    assert {r.movimento_nome for r in rows} == {"Dist x", "vazio", "dois"}
    kept = nested.usable_codes(nested.movement_table(documents))
    assert kept.count() == 3


def test_clean_cases(documents):
    row = nested.clean_cases(nested.case_table(documents)).orderBy("id").first()
    assert (row.ano_ajuizamento, str(row.mes_ajuizamento), row.data_ajuizamento_raw) == (
        2023, "2023-05-01", "20230522230301")


@pytest.mark.parametrize("items, first, last, middle, author", [
    ([], None, None, None, (None, None, None)),
    (["N"], "N", "N", None, ("n", None, None)),
    (["N", "Movimentada Por: Ana - Juiz"], "N", "Movimentada Por: Ana - Juiz", None, ("movimentada por", "ana", "juiz")),
    (["N", "a", "b", "Por: X"], "N", "Por: X", "a | b", ("por", "x", None)),
    (None, None, None, None, (None, None, None)),
])
def test_complements(spark, items, first, last, middle, author):
    frame = spark.createDataFrame([(items,)], "a array<string>")
    fields = tx.author_fields(tx.last_item(F.col("a")))
    row = frame.select(
        tx.first_item(F.col("a")), tx.last_item(F.col("a")), tx.middle_items(F.col("a")),
        fields["descricao"], fields["nome"], fields["cargo"]).first()
    assert tuple(row) == (first, last, middle, *author)


def test_text_helpers(spark):
    row = spark.createDataFrame([("1234567.5", [" 1 ", "", None, "2"], "a, ,b")], "v string, l array<string>, t string").select(
        tx.decimal_comma(F.col("v")), tx.join_items(F.col("l")), tx.count_items(F.col("l")),
        tx.list_items(F.col("t")), tx.thousands(F.lit(1234567)), tx.percent_label(F.lit(0.1234))).first()
    assert tuple(row) == ("1234567,5", "1, 2", 2, ["a", "b"], "1,234,567", "12.3%")


@pytest.mark.parametrize("text, decoded", [
    ("{&quot;a&quot;:1}", '{"a":1}'), ("&amp;quot;", "&quot;"), ("&ccedil;&#227;&#xE9; &x; &", "çãé &x; &"),
    ("&#128512;", "😀"), ("a&b&lt;", "a&b<"), (None, None)])
def test_entities(spark, text, decoded):
    assert spark.createDataFrame([(text,)], "x string").select(tx.unescape_html(F.col("x"))).first()[0] == decoded


def test_rejects_are_set_aside(spark):
    frame = spark.createDataFrame([(1, json.dumps(DOCUMENTS[0])), (2, '{"id": "cut'), (3, "[]")], "k int, texto string")
    good, bad = readers.split_rejects(readers.parse_case_text(frame, "texto"))
    assert 2 in {r.k for r in bad.collect()} and 1 in {r.k for r in good.collect()}
    assert good.count() + bad.count() == 3
