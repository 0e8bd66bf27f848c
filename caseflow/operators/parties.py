"""Party extraction from movement sentences (RX1-RX8, FL5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import party_text as pt

TEXT = "complemento_projudi_descricao"
NAME = f"{TEXT}_parte_nome"
ROLE = f"{TEXT}_parte_especie"
ADMINISTRATOR = f"{TEXT}_administrador_judicial"


def enrich_movements(movements: DataFrame) -> DataFrame:
    """RX1-RX6: three extracted columns beside every movement row."""
    text = F.col(TEXT)
    return movements.withColumns({
        NAME: pt.party_name(text),
        ROLE: pt.party_role(text),
        ADMINISTRATOR: pt.administrator(text),
    })


def party_table(enriched: DataFrame) -> DataFrame:
    """RX7, FL5, RX8: rows with any extracted field; company suffixes normalised here only."""
    # the role is never NULL in an enrolment, so testing it first settles most rows;
    # the plain pattern test spares every other row the extraction
    found = enriched.filter(
        F.col(TEXT).rlike(pt.MENTIONS_PARTY) & F.coalesce(ROLE, NAME, ADMINISTRATOR).isNotNull())
    return found.select(
        "numero_processo",
        F.col("classe_processual").alias("classe_codigo"),
        "movimento_sequencia",
        "movimento_data_hora",
        "movimento_codigo",
        "movimento_nome",
        pt.normalise_suffix(F.col(NAME)).alias("parte_nome"),
        F.col(ROLE).alias("parte_especie"),
        F.col(ADMINISTRATOR).alias("administrador_judicial"),
        TEXT,
        "complemento_projudi_movimentado_por_nome",
        "complemento_projudi_movimentado_por_cargo",
    )
