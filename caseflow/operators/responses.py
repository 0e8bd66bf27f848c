"""Raw XML responses to organised documents (SC6, UN4-UN7, PJ18-PJ20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import schemas
from caseflow.functions import text as tx
from caseflow.functions import timestamps as ts
from caseflow.operators.nested import unnest

TREE_PARAMETER = "ARVORE_PROCESSUAL"


def wrap_response(frame: DataFrame, key: str, xml: str, received: Column, source: str) -> DataFrame:
    """PJ20: the envelope stored around one raw payload."""
    return frame.select(
        F.col(key).alias("numero_processo"),
        F.date_format(received, "yyyyMMdd_HHmmss").alias("timestamp"),
        F.date_format(received, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp_iso"),
        F.col(xml).alias("resposta_raw"),
        F.struct(
            F.octet_length(xml).cast("bigint").alias("file_size_bytes"),
            F.lit("utf-8").alias("encoding"),
            F.lit(source).alias("source"),
        ).alias("metadata"),
    )


def parse_responses(raw: DataFrame) -> DataFrame:
    """SC6: the XML body as a struct; unreadable bodies keep their row and a reject text."""
    body = F.from_xml(
        F.col("resposta_raw"), f"{schemas.RESPONSE_XML}, _corrupt_record string",
        {"ignoreNamespace": "true", "mode": "PERMISSIVE",
         "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    kept = [c for c in raw.columns if c != "resposta_raw"]
    answer = F.col("_xml.Body.consultarProcessoResposta")
    return raw.select(*kept, body.alias("_xml")).select(
        *kept,
        tx.is_true_any_case(answer["sucesso"]).alias("sucesso"),
        answer["mensagem"].alias("mensagem"),
        answer["processo"]["dadosBasicos"].alias("basico"),
        answer["processo"]["movimento"].alias("movimento"),
        F.col("_xml._corrupt_record").alias("_corrupt_record"),
    )


def _non_empty(items: Column) -> Column:
    return F.coalesce(F.filter(items, lambda x: x != ""), F.array().cast("array<string>"))


def movement_structs(movement: Column) -> Column:
    """UN4, UN5: movements in the organised layout, sorted by numeric sequence."""
    def organise(m: Column) -> Column:
        stamp = m["_dataHora"]
        national = m["movimentoNacional"]
        return F.struct(
            F.struct(
                m["_identificadorMovimento"].alias("identificadorMovimento"),
                stamp.alias("dataHora"),
                m["_classeProcessual"].alias("classeProcessual"),
            ).alias("atributos"),
            F.when(F.length(stamp) == 14, ts.compact_to_display(stamp)).alias("dataHoraFormatada"),
            _non_empty(m["complemento"]).alias("complementos"),
            F.when(national.isNotNull(), F.struct(
                F.struct(national["_codigoNacional"].alias("codigoNacional")).alias("atributos"),
                _non_empty(national["complemento"]).alias("complementos"),
            )).alias("movimentoNacional"),
        )

    present = F.coalesce(movement, F.array())
    # the position keeps equal sequence numbers in document order
    keyed = F.transform(present, lambda m, i: F.struct(
        F.coalesce(m["_identificadorMovimento"].try_cast("int"), F.lit(0)).alias("seq"),
        i.alias("pos"), organise(m).alias("m")))
    return F.transform(F.array_sort(keyed), lambda k: k["m"])


def named_parameter(parameters: Column, name: str) -> Column:
    """UN8: the value of a named parameter; the last one wins when repeated."""
    return F.try_element_at(F.filter(parameters, lambda p: p["_nome"] == name), F.lit(-1))["_valor"]


def basic_data(parsed: DataFrame) -> DataFrame:
    """UN7: attributes, subjects, parameters, court and simple elements of a case."""
    b = F.col("basico")
    court = b["orgaoJulgador"]
    subjects = F.coalesce(b["assunto"], F.array())
    return parsed.select(
        "numero_processo",
        "sucesso",
        "mensagem",
        b["_competencia"].alias("competencia"),
        b["_classeProcessual"].alias("classe_processual"),
        b["_dataAjuizamento"].alias("data_ajuizamento_raw"),
        b["_nivelSigilo"].alias("nivel_sigilo"),
        b["_codigoLocalidade"].alias("codigo_localidade"),
        b["valorCausa"].alias("valor_causa"),
        b["juizo100Digital"].alias("juizo_100_digital"),
        b["custasRecolhidas"].alias("custas_recolhidas"),
        court["_codigoOrgao"].alias("codigo_orgao"),
        court["_nomeOrgao"].alias("nome_orgao"),
        tx.join_items(F.transform(subjects, lambda a: a["codigoNacional"])).alias("codigos_nacionais"),
        F.size(subjects).alias("total_assuntos"),
        F.coalesce(F.size(b["outroParametro"]), F.lit(0)).alias("total_parametros"),
        named_parameter(b["outroParametro"], TREE_PARAMETER).alias("arvore_raw"),
    )


def tree_text(parsed: DataFrame) -> DataFrame:
    """PJ18, UN8: the escaped tree parameter decoded to its JSON array (NULL if unusable)."""
    raw = named_parameter(F.col("basico.outroParametro"), TREE_PARAMETER)
    decoded = F.from_json(tx.unescape_html(raw), "arvoreProcessual string")
    return parsed.select("numero_processo", decoded["arvoreProcessual"].alias("arvore"))


def case_digest(parsed: DataFrame) -> DataFrame:
    """UN6: one summary row per case with its last movement."""
    b = F.col("basico")
    frame = parsed.select("numero_processo", "basico", movement_structs(F.col("movimento")).alias("mv"))
    last = tx.last_item(F.col("mv"))
    return frame.select(
        "numero_processo",
        b["_classeProcessual"].alias("classe_processual"),
        ts.compact_to_display(b["_dataAjuizamento"]).alias("data_ajuizamento"),
        b["valorCausa"].alias("valor_causa"),
        b["orgaoJulgador"]["_nomeOrgao"].alias("orgao_julgador"),
        named_parameter(b["outroParametro"], "situacao").alias("situacao"),
        named_parameter(b["outroParametro"], "status").alias("status"),
        F.size("mv").alias("total_movimentos"),
        ts.compact_to_display(last["atributos"]["dataHora"]).alias("ultimo_movimento_data"),
        tx.first_item(last["complementos"]).alias("ultimo_movimento_descricao"),
    )


def xml_movement_table(parsed: DataFrame) -> DataFrame:
    """UN4 flattened: one row per movement, in sequence order within its case."""
    rows = unnest(parsed, ["numero_processo"], movement_structs(F.col("movimento")), "m", position="pos")
    return rows.select(
        "numero_processo",
        (F.col("pos") + 1).alias("ordem"),
        F.col("m.atributos.identificadorMovimento").alias("movimento_sequencia"),
        F.col("m.atributos.dataHora").alias("movimento_data_hora_raw"),
        F.col("m.dataHoraFormatada").alias("movimento_data_hora"),
        F.size("m.complementos").alias("total_complementos"),
        tx.first_item(F.col("m.complementos")).alias("complemento_projudi_nome"),
        F.col("m.movimentoNacional.atributos.codigoNacional").alias("movimento_codigo"),
        tx.first_item(F.col("m.movimentoNacional.complementos")).alias("movimento_nome"),
    )


def organise_responses(parsed: DataFrame, origin: Column) -> DataFrame:
    """UN4-UN8: the organised document that the service tables are read from."""
    b = F.col("basico")
    digest_last = tx.last_item(F.col("mv"))
    court = b["orgaoJulgador"]
    frame = parsed.withColumn("mv", movement_structs(F.col("movimento")))
    # only the tree parameter is entity-decoded; every other value is kept as read
    tree = F.from_json(
        tx.unescape_html(named_parameter(b["outroParametro"], TREE_PARAMETER)),
        "arvoreProcessual string")
    parameters = F.transform(b["outroParametro"], lambda p: F.struct(
        p["_nome"].alias("nome"), p["_valor"].alias("valor"),
        F.when(p["_nome"] == TREE_PARAMETER, F.col("_tree")).alias("valor_estruturado")))
    return frame.withColumn("_tree", tree).select(
        F.struct(
            "numero_processo",
            F.col("timestamp").alias("data_consulta"),
            ts.query_time_to_display(F.col("timestamp")).alias("data_formatada"),
            origin.alias("arquivo_origem"),
        ).alias("metadados"),
        F.struct("sucesso", "mensagem").alias("resposta"),
        F.struct(
            "numero_processo",
            b["_classeProcessual"].alias("classe_processual"),
            ts.compact_to_display(b["_dataAjuizamento"]).alias("data_ajuizamento"),
            b["valorCausa"].alias("valor_causa"),
            court["_nomeOrgao"].alias("orgao_julgador"),
            named_parameter(b["outroParametro"], "situacao").alias("situacao"),
            named_parameter(b["outroParametro"], "status").alias("status"),
            F.size("mv").cast("string").alias("total_movimentos"),
            F.struct(
                ts.compact_to_display(digest_last["atributos"]["dataHora"]).alias("data"),
                tx.first_item(digest_last["complementos"]).alias("descricao"),
            ).alias("ultimo_movimento"),
        ).alias("resumo"),
        F.struct(
            F.struct(
                b["_competencia"].alias("competencia"),
                b["_codigoLocalidade"].alias("codigoLocalidade"),
                b["juizo100Digital"].alias("juizo100Digital"),
                b["_nivelSigilo"].alias("nivelSigilo"),
                b["custasRecolhidas"].alias("custasRecolhidas"),
                b["_classeProcessual"].alias("classeProcessual"),
                b["_dataAjuizamento"].alias("dataAjuizamento"),
                b["valorCausa"].alias("valorCausa"),
                F.transform(b["assunto"], lambda a: F.struct(
                    F.create_map(F.lit("principal"), a["_principal"]).alias("atributos"),
                    a["codigoNacional"].alias("codigoNacional"))).alias("assuntos"),
                parameters.alias("outrosParametros"),
                F.struct(F.struct(
                    court["_codigoOrgao"].alias("codigoOrgao"),
                    court["_nomeOrgao"].alias("nomeOrgao"),
                    court["_codigoMunicipioIBGE"].alias("codigoMunicipioIBGE"),
                    court["_instancia"].alias("instancia"),
                ).alias("atributos")).alias("orgaoJulgador"),
            ).alias("dados_basicos"),
            F.col("mv").alias("movimentos"),
        ).alias("processo"),
    )
