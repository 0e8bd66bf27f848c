import json

import pytest
from pyspark.sql import functions as F

from caseflow.operators import hierarchy, tree


def node(number, *children, level="2", seq=1):
    return {"numeroUnico": number, "sequencial": seq, "instancia": level, "processos": list(children)}


def expected(n, root=None, parent=None, depth=0, order=1):
    root = root or n["numeroUnico"]
    yield (root, n["numeroUnico"], parent, depth, order, n["instancia"], "G1" if n["instancia"] == "1" else "G2",
           n["sequencial"], parent is None, not n["processos"])
    for i, child in enumerate(n["processos"], 1):
        yield from expected(child, root, n["numeroUnico"], depth + 1, i)


def chain(n):
    return node(f"c{n}", *([chain(n - 1)] if n else []))


TREES = [
    node("r", node("a", node("c")), node("b"), level="1"),
    node("só", level="1"),
    node('x"[', *[node(f"k{i}", node(f"g{i}")) for i in range(30)], level="1"),
    chain(40),
]


@pytest.fixture()
def trees(spark):
    texts = [json.dumps([t]) for t in TREES] + [None, "[]", "not json"]
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "numero_processo string, arvore string")


def test_flatten_matches_recursion(trees):
    rows = sorted(map(tuple, tree.flatten_trees(trees).collect()), key=str)
    assert rows == sorted((r for t in TREES for r in expected(t)), key=str)


def test_depth_costs_no_plan(spark):
    deep = json.dumps([chain(200)])
    junk = ["[" * 5000, "]" * 5000, "[" * 200_000, '[{"processos": ' + "[" * 5000, '"text"', "[null]", "[1]", " ", "{"]
    odd = ['{"numeroUnico": 7, "processos": "[{\\"numeroUnico\\": \\"k\\"}]"}', '[{"numeroUnico": "q", "processos": [3]}]']
    frame = spark.createDataFrame([(t,) for t in [deep, *junk, *odd]], "arvore string")
    rows = tree.flatten_trees(frame).collect()
    assert max(r.profundidade for r in rows) == 200 and len(rows) == 201 + 3
    assert {(r.processo_raiz, r.numero_processo, r.eh_folha) for r in rows if not r.processo_raiz.startswith("c")} == {
        ("7", "7", False), ("7", "k", True), ("q", "q", False)}


def test_tree_questions(trees):
    nodes = tree.flatten_trees(trees)
    totals = tree.tree_totals(nodes).first()
    assert (totals.processos_raiz, totals.recursos_diretos, totals.profundidade_maxima) == (4, 33, 40)
    assert [r.processo_raiz for r in tree.trivial_trees(nodes).collect()] == ["só"]
    per_root = {r.processo_raiz: (r.recursos_diretos, r.profundidade_maxima) for r in tree.litigiousness(nodes).collect()}
    assert per_root["r"] == (2, 2)
    assert sum(r.n for r in tree.depth_distribution(nodes).collect()) == nodes.count()
    children = nodes.filter(~F.col("eh_raiz")).count()
    assert nodes.count() == 4 + children


def test_rejects(trees):
    reasons = {r.numero_processo: r.motivo for r in tree.tree_rejects(trees).collect()}
    assert reasons["4"] == "sem arvore" and reasons["5"] == "vazia" and "6" in reasons
    assert set(reasons) == {"4", "5", "6"}


def test_joins_over_trees(spark, trees):
    nodes = tree.flatten_trees(trees)
    moves = spark.createDataFrame([("a", "237"), ("a", "237"), ("b", "238"), ("b", "1")], "processo string, movimento_codigo string")
    got = {(r.processo_raiz, r.movimento_codigo): r.n for r in tree.outcomes_by_root(nodes, moves, ["237", "238"]).collect()}
    assert got == {("r", "237"): 2, ("r", "238"): 1}
    parties = spark.createDataFrame([("r",), ("r",), ("a",)], "numero_processo string")
    cases = spark.createDataFrame([("r", "Falência")], "processo string, classe_nome string")
    assert [tuple(r) for r in tree.parties_by_class(nodes, parties, cases).collect()] == [("Falência", 2)]


def test_hierarchy(spark):
    rows = [(1, None), (193, 1), (385, 193), (221, 385), (50, 999),
            (14, None), (2, 14), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6)]
    taxonomy = spark.createDataFrame([(i, p, f"n{i}") for i, p in rows], "id long, cod_item_pai long, nome string")
    lookup = hierarchy.code_lookup(taxonomy)
    got = {r.movimento_codigo: r for r in lookup.collect()}
    levels = lambda r: [r[f"movimento_codigo_{i}"] for i in range(1, 6)]
    assert levels(got[221]) == [1, 193, 385, 221, None] and got[221].chain_complete
    assert levels(got[50]) == [50, None, None, None, None] and not got[50].chain_complete
    assert levels(got[6]) == [14, 2, 3, 4, 5] and got[6].cadeia == [14, 2, 3, 4, 5, 6]  # five of six levels have columns
    assert levels(got[7]) == [14, 2, 3, 4, 5] and got[7].chain_complete
    assert (got[7].codigo_raiz, got[7].nivel_folha) == (14, 7)
    deep = spark.createDataFrame([(i, i - 1 or None, "n") for i in range(1, 41)], "id long, cod_item_pai long, nome string")
    assert {r.codigo_raiz for r in hierarchy.ancestor_levels(deep).collect()} == {1}
    loop = spark.createDataFrame([(1, 3, "a"), (2, 1, "b"), (3, 2, "c")], "id long, cod_item_pai long, nome string")
    with pytest.raises(hierarchy.TaxonomyCycle):
        hierarchy.ancestor_levels(loop)
    moves = spark.createDataFrame([("p", "221"), ("p", "{}"), ("p", "77"), ("p", None)], "processo string, movimento_codigo string")
    enriched = hierarchy.enrich_movements(moves, lookup)
    assert {(r.movimento_codigo, r.movimento_codigo_1, r.tpu_nome) for r in enriched.collect()} == {
        (221, 1, "n221"), (77, None, None)}
    report = {r.movimento_codigo_1: (r.n, r.percentual) for r in hierarchy.root_report(enriched).collect()}
    assert report == {1: (1, 50.0), None: (1, 50.0)}
