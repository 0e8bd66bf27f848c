"""Explicit read schemas (inference would cost a pass and trip on mixed codes)."""

# One case per line.  Movement codes stay text: the source mixes 85 and {}.
CASE_DOCUMENT = """
    id string, numeroProcesso string,
    classe struct<codigo: bigint, nome: string>,
    dataAjuizamento string,
    orgaoJulgador struct<codigo: bigint, nome: string, codigoMunicipioIBGE: bigint>,
    tribunal string, grau string, `@timestamp` string,
    assuntos array<struct<codigo: bigint, nome: string>>,
    movimentos array<struct<codigo: string, nome: string, dataHora: string,
        complementosTabelados: array<struct<codigo: bigint, nome: string,
                                            valor: string, descricao: string>>>>
"""

# One document per case, as organised from the service response.  The case tree
# stays raw JSON text because it is recursive.
ORGANISED_DOCUMENT = """
    metadados struct<numero_processo: string, data_consulta: string,
                     data_formatada: string, arquivo_origem: string>,
    resposta struct<sucesso: boolean, mensagem: string>,
    resumo struct<numero_processo: string, classe_processual: string, data_ajuizamento: string,
                  valor_causa: string, orgao_julgador: string, situacao: string, status: string,
                  total_movimentos: string,
                  ultimo_movimento: struct<data: string, descricao: string>>,
    processo struct<
        dados_basicos: struct<
            competencia: string, codigoLocalidade: string, juizo100Digital: string,
            nivelSigilo: string, custasRecolhidas: string, classeProcessual: string,
            dataAjuizamento: string, valorCausa: string,
            assuntos: array<struct<atributos: map<string, string>, codigoNacional: string>>,
            outrosParametros: array<struct<nome: string, valor: string,
                valor_estruturado: struct<arvoreProcessual: string>>>,
            orgaoJulgador: struct<atributos: struct<codigoOrgao: string, nomeOrgao: string,
                codigoMunicipioIBGE: string, instancia: string>>>,
        movimentos: array<struct<
            atributos: struct<identificadorMovimento: string, dataHora: string,
                              classeProcessual: string>,
            dataHoraFormatada: string,
            complementos: array<string>,
            movimentoNacional: struct<atributos: struct<codigoNacional: string>,
                                      complementos: array<string>>>>>
"""

# Envelope around one raw service response.
RAW_RESPONSE = """
    numero_processo string, timestamp string, timestamp_iso string, resposta_raw string,
    metadata struct<file_size_bytes: bigint, encoding: string, source: string>
"""

# XML body of one service response: namespaces dropped, attributes as _name.
_MOVEMENT_XML = """array<struct<
    _identificadorMovimento: string, _dataHora: string, _classeProcessual: string,
    complemento: array<string>,
    movimentoNacional: struct<_codigoNacional: string, complemento: array<string>>>>"""

RESPONSE_XML = f"""
    Body struct<consultarProcessoResposta: struct<
        sucesso: string, mensagem: string,
        processo: struct<
            dadosBasicos: struct<
                _numero: string, _competencia: string, _classeProcessual: string,
                _codigoLocalidade: string, _nivelSigilo: string, _dataAjuizamento: string,
                assunto: array<struct<_principal: string, codigoNacional: string>>,
                outroParametro: array<struct<_nome: string, _valor: string>>,
                orgaoJulgador: struct<_codigoOrgao: string, _nomeOrgao: string,
                                      _codigoMunicipioIBGE: string, _instancia: string>,
                valorCausa: string, juizo100Digital: string, custasRecolhidas: string>,
            movimento: {_MOVEMENT_XML}>>>
"""

# One level of the recursive case tree; deeper levels stay raw text.
TREE_LEVEL = "array<struct<numeroUnico: string, sequencial: string, instancia: string, processos: string>>"

TREE_COLUMNS = (
    "processo_raiz", "numero_processo", "numero_pai", "profundidade", "ordem_entre_irmaos",
    "instancia", "grau", "sequencial", "eh_raiz", "eh_folha",
)

# Columns of the parsed tables, by role.
MOVEMENT_REQUIRED = ("id", "processo", "movimento_codigo", "movimento_nome", "movimento_data_hora")
MOVEMENT_OPTIONAL = (
    "complemento_codigo", "complemento_nome", "complemento_valor", "complemento_descricao",
)
