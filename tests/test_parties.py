import pytest
from pyspark.sql import functions as F

from caseflow.functions import party_text as pt
from caseflow.operators import parties, profile

H = "HABILITAÇÃO DE PARTE EM PROCESSO - Parte: "
CASES = [
    (H + "ADMINISTRADOR JUDICIAL (Ana Lima) (Terceiro)", "ana lima", "terceiro", "ana lima"),
    (H + "(ADMINISTRADOR JUDICIAL) Ana Lima (Terceiro)", "ana lima", "terceiro", "ana lima"),
    ("DES" + H + "Ana Lima (SÍNDICO DO(A) Acme) (Terceiro)", "ana lima", "terceiro", "ana lima"),
    ("DES" + H + "Ana Lima (síndico do(a) Acme) (Terceiro)", "ana lima", "terceiro", "ana lima"),
    (H + "Ana Lima (ADMINISTRADOR JUDICIAL) (Terceiro)", "ana lima", "terceiro", "ana lima"),
    (H + "MASSA FALIDA DE Acme & Cia Ltda. (Promovido)", "acme & cia ltda.", "promovido", None),
    (H + "MASSA  FALIDA -  Acme   Brasil (Réu)", "acme brasil", "réu", None),
    ("Para advogados/curador/defensor de Beta S/A com prazo de 5 dias", "beta s/a", None, None),
    ("P/ advgs. de Ana Lima (SÍNDICO DO(A) Acme) com prazo", "ana lima", None, "ana lima"),
    ("Pelo advogado/curador/defensor de Beta em 12/03/2020", "beta", None, None),
    (H + "Gama (Outro)", None, "", None),
    ("Juntada de petição", None, None, None),
    (None, None, None, None),
]


def _movements(spark):
    columns = ("numero_processo", "classe_processual", "movimento_sequencia", "movimento_data_hora",
               "movimento_codigo", "movimento_nome", "complemento_projudi_movimentado_por_nome",
               "complemento_projudi_movimentado_por_cargo")
    frame = spark.createDataFrame(
        [(str(i), text) for i, (text, *_) in enumerate(CASES)], f"numero_processo string, {parties.TEXT} string")
    return frame.withColumns({c: F.lit("x") for c in columns if c != "numero_processo"})


def test_extraction_table(spark):
    rows = {int(r.numero_processo): r for r in parties.enrich_movements(_movements(spark)).collect()}
    for i, (text, name, role, administrator) in enumerate(CASES):
        assert (rows[i][parties.NAME], rows[i][parties.ROLE], rows[i][parties.ADMINISTRATOR]) == (
            name, role, administrator), text


def test_party_table_keeps_any_field_and_normalises_suffixes(spark):
    table = parties.party_table(parties.enrich_movements(_movements(spark)))
    rows = {int(r.numero_processo): r for r in table.collect()}
    assert set(rows) == {i for i, c in enumerate(CASES) if any(x is not None for x in c[1:])}
    assert rows[5].parte_nome == "acme e cia ltda" and rows[7].parte_nome == "beta sa"
    assert len(table.columns) == 12


@pytest.mark.parametrize("name, clean", [
    ("acme & cia. ltda.", "acme e cia ltda"), ("acme & cia s/a", "acme e cia sa"), ("acme cia.", "acme cia"),
    ("beta s.a.", "beta sa"), ("gama, delta  ltda.", "gama delta ltda"), ("casa sá", "casa sá"), (None, None)])
def test_suffixes(spark, name, clean):
    frame = spark.createDataFrame([(name,)], "n string")
    assert frame.select(pt.normalise_suffix(F.col("n"))).first()[0] == clean


def test_fill_rates_count_empty_roles_as_missing(spark):
    row = profile.fill_rates(parties.enrich_movements(_movements(spark))).first()
    assert row.linhas == len(CASES)
    assert row.n_parte_nome == sum(c[1] is not None for c in CASES)
    assert row.n_parte_especie == sum(bool(c[2]) for c in CASES)
    assert row.n_administrador_judicial == sum(c[3] is not None for c in CASES)
