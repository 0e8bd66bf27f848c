"""Movement taxonomy: ancestor chains, leaf attributes, root report (HR7-HR9, JN2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.skew import sized
from caseflow.session import settle

ROUNDS_AT_ONCE = 3  # doubling rounds planned together: chains of up to eight codes are found in one go
LEVELS = 5  # levels that also get columns of their own; the chain itself has no limit


class TaxonomyCycle(ValueError):
    """The parent pointers of a taxonomy lead back to a code."""


# Leaf attributes and the taxonomy field each comes from.
LEAF_FIELDS = (
    ("tpu_id", "id"), ("tpu_cod_item_pai", "cod_item_pai"), ("tpu_nome", "nome"),
    ("tpu_descricao_glossario", "descricao_glossario"), ("tpu_glossario", "glossario"),
    ("tpu_norma", "norma"), ("tpu_artigo", "artigo"),
    ("tpu_dispositivo_legal", "dispositivoLegal"), ("tpu_data_inclusao", "data_inclusao"),
    ("tpu_data_versao", "data_versao"), ("tpu_data_alteracao", "data_alteracao"),
)


def ancestor_levels(taxonomy: DataFrame) -> DataFrame:
    """HR7: per code, the whole chain from the root down.

    ``cadeia`` holds the codes of the chain, ``codigo_raiz`` its first and ``nivel_folha`` its length; codigo_1..5 and
    nome_1..5 are its first five levels.  ``chain_complete`` tells whether the climb ended at a node without parent.

    Chains double in length every round, so a taxonomy of any depth takes a logarithmic number of equi-joins on the
    pointer, stored after every ``ROUNDS_AT_ONCE``; Spark broadcasts the taxonomy while it is under its size threshold.
    A cycle raises ``TaxonomyCycle``.
    """
    chain = settle(taxonomy.select(
        F.col("id").alias("movimento_codigo"),
        F.array(F.struct(F.col("id").alias("_id"), F.col("nome").alias("_nome"))).alias("_chain"),
        F.col("cod_item_pai").alias("_up")))
    while True:
        for _ in range(ROUNDS_AT_ONCE):
            above = chain.select(
                F.col("movimento_codigo").alias("_from"), F.col("_chain").alias("_more"), F.col("_up").alias("_next"))
            climbed = chain.join(above, F.col("_up") == F.col("_from"), "left")
            known = F.col("_from").isNotNull()
            # a missing parent keeps its pointer, which marks the chain incomplete
            longer = climbed.select(
                "movimento_codigo", known.alias("_moved"),
                F.when(known, F.concat("_chain", "_more")).otherwise(F.col("_chain")).alias("_chain"),
                F.when(known, F.col("_next")).otherwise(F.col("_up")).alias("_up"))
            chain = longer.drop("_moved")
        stored = settle(longer)
        distinct = F.size(F.array_distinct(F.transform("_chain", lambda x: x["_id"])))
        moved, cyclic = stored.agg(F.max("_moved"), F.min(F.when(distinct < F.size("_chain"), F.col("movimento_codigo")))).first()
        if cyclic is not None:
            raise TaxonomyCycle(f"the parents of code {cyclic} form a cycle")
        chain = stored.drop("_moved")
        if not moved:
            break
    root_first = chain.withColumn("_chain", F.reverse("_chain"))

    def level(i: int, field: str):
        return F.try_element_at("_chain", F.lit(i))[field]

    return root_first.select(
        "movimento_codigo",
        *[level(i, "_id").alias(f"movimento_codigo_{i}") for i in range(1, LEVELS + 1)],
        *[level(i, "_nome").alias(f"movimento_nome_{i}") for i in range(1, LEVELS + 1)],
        F.transform("_chain", lambda x: x["_id"]).alias("cadeia"),
        level(1, "_id").alias("codigo_raiz"), F.size("_chain").alias("nivel_folha"),
        F.col("_up").isNull().alias("chain_complete"),
    )


def leaf_attributes(taxonomy: DataFrame) -> DataFrame:
    """HR8: the eleven attributes of each code; absent source fields are NULL."""
    has = set(taxonomy.columns)
    return taxonomy.select(
        F.col("id").alias("movimento_codigo"),
        *[(F.col(source) if source in has else F.lit(None).cast("string")).alias(name)
          for name, source in LEAF_FIELDS])


def code_lookup(taxonomy: DataFrame) -> DataFrame:
    """HR7 with HR8: one row per code."""
    return ancestor_levels(taxonomy).join(leaf_attributes(taxonomy), "movimento_codigo")


def enrich_movements(movements: DataFrame, lookup: DataFrame) -> DataFrame:
    """JN2: integer code, unusable codes dropped, unknown codes kept with NULL levels.

    Without a known size for the lookup, Spark would shuffle the movements onto
    a few hundred, very unequal codes.
    """
    coded = movements.withColumn(
        "movimento_codigo", F.col("movimento_codigo").cast("string").try_cast("bigint")
    ).filter(F.col("movimento_codigo").isNotNull())
    return coded.join(sized(lookup), "movimento_codigo", "left")


def root_report(enriched: DataFrame) -> DataFrame:
    """HR9: movements per root code with their share of all movements."""
    counts = enriched.groupBy("movimento_codigo_1").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per taxonomy root
    return counts.withColumn("percentual", F.round(F.col("n") * 100 / total, 1))
