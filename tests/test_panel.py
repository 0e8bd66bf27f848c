from datetime import date, datetime

from pyspark.sql import functions as F

from caseflow.operators import events, panel

SCHEMA = "processo string, orgao_julgador_codigo long, orgao_julgador_nome string, mes_ajuizamento date"
ROWS = [("p1", 1, "Esp 1", date(2015, 1, 1)), ("p2", 1, "Esp 1", date(2015, 3, 1)),
        ("p3", 50, "Comum", date(2015, 1, 1)), ("p4", None, "Sem código", date(2015, 5, 1)),
        ("p4", None, "Sem código", date(2015, 5, 1)), ("p5", 50, "Comum", date(2014, 12, 1))]


def cases(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_wide_panel_keeps_rows_outside_the_grid(spark):
    wide = panel.filings_wide(cases(spark), (1,), "2015-01-01", "2015-03-01")
    assert wide.columns == ["grupo", "orgao_label", "2015-01-01", "2015-02-01", "2015-03-01", "2015-05-01"]
    assert [tuple(r) for r in wide.collect()] == [
        ("especializada", "Esp 1", 1, 0, 1, 0), ("nao_especializada", "nao_especializada (agrupadas)", 1, 0, 0, 2)]
    long = panel.filings_long(wide, "grupo", "2015-01-01", "2015-03-01")
    assert long.count() == 6 and long.agg(F.sum("n")).first()[0] == 3


def test_missing_court_code_counts_as_other(spark):
    others = panel.other_courts(cases(spark), (1,))
    assert sorted(r.processo for r in others.collect()) == ["p3", "p4", "p4", "p5"]
    wide = panel.other_courts_wide(cases(spark), (1,), "2015-01-01")
    assert wide.columns == ["orgao_julgador_nome", "2015-01-01", "2015-05-01"]


def test_series_completion(spark):
    counts = spark.createDataFrame(
        [("a", date(2020, 1, 1), 2), ("a", date(2020, 4, 1), 1), ("b", date(2021, 1, 1), 5), ("b", None, 1)],
        "k string, mes date, n long")
    got = {(r.k, r.mes and r.mes.month): r.n for r in panel.complete_series(counts, "mes", ["k"]).collect()}
    assert got == {("a", 1): 2, ("a", 2): 0, ("a", 3): 0, ("a", 4): 1, ("b", 1): 5, ("b", None): 1}


def test_backlog_identity_and_flow(spark):
    moves = spark.createDataFrame(
        [("p3", "246", datetime(2016, 1, 5)), ("p4", "246", datetime(2016, 2, 5)), ("p4", "246", datetime(2016, 2, 5)),
         ("p1", "246", datetime(2016, 1, 1)), ("p5", "1", datetime(2016, 1, 1))],
        "processo string, movimento_codigo string, movimento_data_hora timestamp")
    flagged = events.with_existence_flag(cases(spark), moves)
    assert flagged.count() == len(ROWS)
    for r in panel.backlog_by_court(flagged, (1,)).collect():
        assert r.quantidade_processos_ajuizados == (
            r.quantidade_processos_arquivamento_definitivo + r.quantidade_processos_ativos)
    flow = panel.monthly_flow(cases(spark), moves, (1,), "2015-01-01", "2025-10-01")
    rows = {(r.orgao_julgador_nome, str(r.mes), r.tipo): r.n for r in flow.collect()}
    assert rows[("Sem código", "2016-02-01", "arquivamento")] == -4  # two movement rows x two case rows
    once = panel.monthly_flow(cases(spark), moves, (1,), "2015-01-01", "2025-10-01", distinct_movements=True)
    assert {(r.tipo, r.n) for r in once.filter("tipo = 'arquivamento'").collect()} == {("arquivamento", -1), ("arquivamento", -2)}
    check = {r.tipo: r.linhas for r in panel.flow_check(flow).collect()}
    assert check == {"ajuizamento": 2, "arquivamento": 2}


def test_shares_add_up(spark):
    decisions = spark.createDataFrame(
        [("A", datetime(2020, 1, 3)), ("B", datetime(2020, 1, 9)), ("B", datetime(2020, 1, 9)), ("A", datetime(2019, 1, 1))],
        "status string, data_decisao timestamp")
    counts = panel.monthly_counts(decisions, "data_decisao", ["status"])
    total = panel.share_within(counts, "mes").groupBy("mes").agg(F.sum("prop").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in total)
    assert [(r.n, r.total) for r in panel.status_rate(decisions, "A", "2020-01-01").collect()] == [(1, 3)]
