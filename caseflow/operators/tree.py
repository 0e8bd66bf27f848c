"""Case trees: nested JSON to an adjacency table, and questions about it (HR1-HR6, HR10, HR11)."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions.schemas import TREE_COLUMNS, TREE_LEVEL
from caseflow.operators.responses import TREE_PARAMETER

FRAME_ROWS = 10_000
#: Numbers keep their spelling.
_JSON = json.JSONDecoder(parse_int=str, parse_float=str)
_NODE_SCHEMA = """processo_raiz string, numero_processo string, numero_pai string, profundidade int,
    ordem_entre_irmaos int, instancia string, sequencial string, eh_folha boolean"""
_NODE_COLUMNS = [field.split()[0] for field in _NODE_SCHEMA.split(",")]


def tree_of_document(documents: DataFrame) -> DataFrame:
    """UN8, HR2: the raw tree text of each organised document (NULL when absent)."""
    named = F.filter("processo.dados_basicos.outrosParametros", lambda p: p["nome"] == TREE_PARAMETER)
    return documents.select(
        F.col("metadados.numero_processo").alias("numero_processo"),
        F.try_element_at(named, F.lit(1))["valor_estruturado"]["arvoreProcessual"].alias("arvore"))


def _decoded(text: str | None) -> list | None:
    """The list a tree text holds (an object counts as a list of one); None where it holds none."""
    if text is None or not text.strip():
        return None
    try:
        value = _JSON.raw_decode(text.lstrip())[0]
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else None


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _children(node: dict) -> tuple[list[dict], bool]:
    """The child nodes, and whether the node is a leaf; children that are no list of nodes count as unreadable."""
    below = node.get("processos")
    if isinstance(below, str):
        below = [] if not below.strip("[] \t\r\n") and below.strip()[:1] == "[" else _decoded(below) or below
    if below is None or below == []:
        return [], True
    listed = [below] if isinstance(below, dict) else below
    if not isinstance(listed, list) or any(x is not None and not isinstance(x, dict) for x in listed):
        return [], False
    return [x or {} for x in listed], False


def _nodes(text: str | None) -> Iterator[tuple]:
    """Every node of one tree, parents before children."""
    roots = _decoded(text)
    if not roots or not isinstance(roots[0], dict):
        return
    root = _text(roots[0].get("numeroUnico"))
    pending = [(roots[0], None, 0, 1)]
    while pending:
        node, parent, depth, order = pending.pop()
        children, leaf = _children(node)
        number = _text(node.get("numeroUnico"))
        yield (root, number, parent, depth, order, _text(node.get("instancia")), _text(node.get("sequencial")), leaf)
        pending.extend((c, number, depth + 1, i) for i, c in enumerate(children, 1))


def _flattened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes in frames of at most ``FRAME_ROWS`` rows, so that a large tree is never held as one frame."""
    for frame in frames:
        nodes = itertools.chain.from_iterable(map(_nodes, frame["arvore"]))
        while part := list(itertools.islice(nodes, FRAME_ROWS)):
            yield pd.DataFrame(part, columns=_NODE_COLUMNS)


def flatten_trees(trees: DataFrame, column: str = "arvore") -> DataFrame:
    """HR1, WN5: one row per node.

    Each document is parsed once, in one narrow stage with a plan of fixed size, whatever its depth. Text that is not a
    tree gives no row.
    """
    found = trees.select(F.col(column).alias("arvore")).filter("arvore is not null").mapInPandas(_flattened, _NODE_SCHEMA)
    return found.select(
        "processo_raiz", "numero_processo", "numero_pai", "profundidade", "ordem_entre_irmaos", "instancia",
        F.when(F.col("instancia") == "1", "G1").otherwise("G2").alias("grau"),
        F.col("sequencial").try_cast("int").alias("sequencial"),
        (F.col("profundidade") == 0).alias("eh_raiz"),
        "eh_folha",
    ).select(*TREE_COLUMNS)


def tree_rejects(trees: DataFrame, column: str = "arvore") -> DataFrame:
    """HR2: documents that give no tree, with the reason."""
    parsed = F.from_json(F.col(column), TREE_LEVEL, {"allowSingleQuotes": "false"})
    reason = (
        F.when(F.col(column).isNull(), "sem arvore")
        .when(parsed.isNull(), "ilegivel")
        .when(F.size(parsed) == 0, "vazia")
        .when(parsed[0].isNull(), "ilegivel")
    )
    return trees.withColumn("motivo", reason).filter(F.col("motivo").isNotNull())


def tree_totals(nodes: DataFrame) -> DataFrame:
    """HR3: roots, nodes, direct appeals and greatest depth."""
    return nodes.agg(
        F.count_distinct("processo_raiz").alias("processos_raiz"),
        F.count("*").alias("nos"),
        F.count_if(F.col("profundidade") == 1).alias("recursos_diretos"),
        F.max("profundidade").alias("profundidade_maxima"))


def depth_distribution(nodes: DataFrame) -> DataFrame:
    """HR4: nodes per depth and grade."""
    return nodes.groupBy("profundidade", "grau").agg(F.count("*").alias("n")).orderBy("profundidade", "grau")


def litigiousness(nodes: DataFrame) -> DataFrame:
    """HR6: direct appeals and longest chain per root."""
    return nodes.groupBy("processo_raiz").agg(
        F.count_if(F.col("profundidade") == 1).alias("recursos_diretos"),
        F.max("profundidade").alias("profundidade_maxima"))


def trivial_trees(nodes: DataFrame) -> DataFrame:
    """HR5: roots without any appeal."""
    depth = nodes.groupBy("processo_raiz").agg(F.max("profundidade").alias("max_prof"))
    return depth.filter(F.col("max_prof") == 0).select("processo_raiz")


def nodes_with_cases(nodes: DataFrame, cases: DataFrame) -> DataFrame:
    """JN9: every node beside its own case; a node outside the case table keeps NULLs."""
    own = cases.withColumnRenamed("processo", "numero_processo")
    return nodes.join(own, "numero_processo", "left")


def parties_by_class(nodes: DataFrame, parties: DataFrame, cases: DataFrame) -> DataFrame:
    """HR10, JN9: party rows of tree roots counted by the root case's class."""
    roots = nodes.filter("eh_raiz").select(F.col("processo_raiz").alias("processo"))
    return (
        roots.join(parties.select(F.col("numero_processo").alias("processo")), "processo")
        .join(cases.select("processo", "classe_nome"), "processo")
        .groupBy("classe_nome").agg(F.count("*").alias("n"))
    )


def outcomes_by_root(nodes: DataFrame, movements: DataFrame, codes: list[str]) -> DataFrame:
    """HR11, JN9: appeal rulings of every node of a tree, counted by root and code."""
    rulings = movements.filter(F.col("movimento_codigo").isin(*codes)).select("processo", "movimento_codigo")
    members = nodes.select("processo_raiz", F.col("numero_processo").alias("processo"))
    return (
        members.join(rulings, "processo")
        .groupBy("processo_raiz", "movimento_codigo").agg(F.count("*").alias("n"))
    )
