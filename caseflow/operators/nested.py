"""Nested documents to flat tables (UN1-UN3, PJ1, PJ2, PJ16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import text as tx
from caseflow.functions import timestamps as ts
from caseflow.operators.skew import sized


def unnest(frame: DataFrame, keep: list, items, out: str, position: str | None = None) -> DataFrame:
    """One row per element of ``items``; rows without elements vanish.

    For a plain explode Spark infers a filter on the size of the list and, when
    the list comes out of a parsed text, that filter parses the text a second
    time.  The outer form has no such filter; a missing position marks the
    rows to drop.
    """
    pos = position or "_pos"
    rows = frame.select(*keep, F.posexplode_outer(items).alias(pos, out)).filter(F.col(pos).isNotNull())
    return rows if position else rows.drop(pos)


def case_table(documents: DataFrame) -> DataFrame:
    """PJ1: ten flat columns per case document."""
    return documents.select(
        "id",
        F.col("numeroProcesso").alias("processo"),
        F.col("classe.codigo").alias("classe_codigo"),
        F.col("classe.nome").alias("classe_nome"),
        F.col("dataAjuizamento").alias("data_ajuizamento"),
        F.col("orgaoJulgador.codigo").alias("orgao_julgador_codigo"),
        F.col("orgaoJulgador.nome").alias("orgao_julgador_nome"),
        F.col("orgaoJulgador.codigoMunicipioIBGE").alias("orgao_julgador_municipio_ibge"),
        "tribunal",
        "grau",
    )


def subject_table(documents: DataFrame) -> DataFrame:
    """UN1: one row per subject; a case without subjects gives none."""
    rows = unnest(documents, ["id", "numeroProcesso"], "assuntos", "a")
    return rows.select(
        "id",
        F.col("numeroProcesso").alias("processo"),
        F.col("a.codigo").alias("assunto_codigo"),
        tx.strip_quotes(F.col("a.nome")).alias("assunto_nome"),
    )


def movement_table(documents: DataFrame) -> DataFrame:
    """UN2: one row per movement and complement; a movement without one keeps a row."""
    movements = unnest(documents, ["id", "numeroProcesso"], "movimentos", "m")
    rows = movements.select("id", "numeroProcesso", "m.codigo", "m.nome", "m.dataHora",
                            F.explode_outer("m.complementosTabelados").alias("c"))
    return rows.select(
        "id",
        F.col("numeroProcesso").alias("processo"),
        F.col("codigo").alias("movimento_codigo"),
        tx.strip_quotes(F.col("nome")).alias("movimento_nome"),
        F.col("dataHora").alias("movimento_data_hora"),
        F.col("c.codigo").alias("complemento_codigo"),
        tx.strip_quotes(F.col("c.nome")).alias("complemento_nome"),
        tx.strip_quotes(F.col("c.valor")).alias("complemento_valor"),
        tx.strip_quotes(F.col("c.descricao")).alias("complemento_descricao"),
    )


def service_case_table(documents: DataFrame) -> DataFrame:
    """PJ2-PJ4: 21 columns per organised service document; unreadable numbers are NULL."""
    summary, basic = "resumo", "processo.dados_basicos"
    court = f"{basic}.orgaoJulgador.atributos"
    return documents.select(
        *[F.col(f"metadados.{c}").alias(c)
          for c in ("numero_processo", "data_consulta", "data_formatada", "arquivo_origem")],
        F.col(f"{summary}.classe_processual").alias("classe_processual"),
        F.col(f"{summary}.data_ajuizamento").alias("data_ajuizamento"),
        F.col(f"{summary}.valor_causa").try_cast("double").alias("valor_causa"),
        F.col(f"{summary}.orgao_julgador").alias("orgao_julgador_nome"),
        F.col(f"{summary}.situacao").alias("situacao"),
        F.col(f"{summary}.status").alias("status"),
        F.col(f"{summary}.total_movimentos").try_cast("int").alias("total_movimentos"),
        F.col(f"{summary}.ultimo_movimento.data").alias("ultimo_movimento_data"),
        F.col(f"{summary}.ultimo_movimento.descricao").alias("ultimo_movimento_descricao"),
        F.col(f"{basic}.competencia").alias("competencia"),
        F.col(f"{basic}.codigoLocalidade").alias("codigo_localidade"),
        tx.is_true(F.col(f"{basic}.juizo100Digital")).alias("juizo_100_digital"),
        F.col(f"{basic}.nivelSigilo").try_cast("int").alias("nivel_sigilo"),
        F.col(f"{basic}.custasRecolhidas").try_cast("double").alias("custas_recolhidas"),
        F.col(f"{court}.codigoOrgao").alias("codigo_orgao"),
        F.col(f"{court}.codigoMunicipioIBGE").alias("codigo_municipio_ibge"),
        F.col(f"{court}.instancia").alias("instancia"),
    )


def service_movement_table(documents: DataFrame) -> DataFrame:
    """UN3, PJ6-PJ8: one row per service movement with its complements taken apart."""
    number = F.col("metadados.numero_processo").alias("numero_processo")
    rows = unnest(documents, [number], "processo.movimentos", "m")
    items = F.col("m.complementos")
    author = tx.author_fields(tx.last_item(items))
    return rows.select(
        "numero_processo",
        F.col("m.atributos.identificadorMovimento").alias("movimento_sequencia"),
        F.col("m.dataHoraFormatada").alias("movimento_data_hora"),
        F.col("m.atributos.dataHora").alias("movimento_data_hora_raw"),
        F.col("m.atributos.classeProcessual").alias("classe_processual"),
        F.col("m.movimentoNacional.atributos.codigoNacional").alias("movimento_codigo"),
        tx.first_item(F.col("m.movimentoNacional.complementos")).alias("movimento_nome"),
        tx.first_item(items).alias("complemento_projudi_nome"),
        tx.middle_items(items).alias("complemento_projudi_descricao"),
        tx.last_item(items).alias("complemento_projudi_movimentado_por"),
        author["descricao"].alias("complemento_projudi_movimentado_por_descricao"),
        author["nome"].alias("complemento_projudi_movimentado_por_nome"),
        author["cargo"].alias("complemento_projudi_movimentado_por_cargo"),
    )


def summary_records(documents: DataFrame, origin: str = "_arquivo") -> DataFrame:
    """PJ14-PJ16: the nested summary as one flat record with lineage columns."""
    codes = F.transform("processo.dados_basicos.assuntos", lambda a: a["codigoNacional"])
    plain = ("classe_processual", "data_ajuizamento", "numero_processo", "orgao_julgador",
             "situacao", "status", "total_movimentos")
    return documents.select(
        F.col(origin).alias("_arquivo_origem"),
        F.current_timestamp().alias("_timestamp_processamento"),
        tx.join_items(codes).alias("codigos_nacionais"),
        tx.count_items(codes).alias("total_codigos_nacionais"),
        *[F.col(f"resumo.{c}").alias(c) for c in plain],
        F.col("resumo.ultimo_movimento.data").alias("ultimo_movimento_data"),
        F.col("resumo.ultimo_movimento.descricao").alias("ultimo_movimento_descricao"),
        tx.decimal_comma(F.col("resumo.valor_causa")).alias("valor_causa"),
    )


def clean_cases(cases: DataFrame) -> DataFrame:
    """TS1, TS3: filing time parsed, raw text kept, year and month added."""
    parsed = cases.withColumn("data_ajuizamento_raw", F.col("data_ajuizamento")).withColumn(
        "data_ajuizamento", ts.parse_timestamp(F.col("data_ajuizamento_raw")))
    return parsed.withColumns({
        "ano_ajuizamento": F.year("data_ajuizamento"),
        "mes_ajuizamento": ts.month_start(F.col("data_ajuizamento")),
    })


def clean_movements(movements: DataFrame) -> DataFrame:
    """TS1, TS3: movement time parsed, raw text kept, year and month added."""
    parsed = movements.withColumn("movimento_data_hora_raw", F.col("movimento_data_hora")).withColumn(
        "movimento_data_hora", ts.parse_timestamp(F.col("movimento_data_hora_raw")))
    return parsed.withColumns({
        "movimento_mes": ts.month_start(F.col("movimento_data_hora")),
        "movimento_ano": F.year("movimento_data_hora"),
    })


def add_municipality(cases: DataFrame, municipalities: DataFrame, code: str = "orgao_julgador_municipio_ibge") -> DataFrame:
    """JN1: municipality and region names by code; unknown codes keep NULLs."""
    return cases.join(sized(municipalities), code, "left")


def usable_codes(movements: DataFrame) -> DataFrame:
    """FL4: drop movements whose code is missing or the {} sentinel."""
    code = F.col("movimento_codigo")
    return movements.filter(code.isNotNull() & (code != F.lit("{}")))
