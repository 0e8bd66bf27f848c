import json
from xml.sax.saxutils import quoteattr

from pyspark.sql import functions as F

from caseflow.operators import nested, responses, tree
from caseflow.plans import proxies

TREE = {"arvoreProcessual": [{"numeroUnico": "1", "sequencial": 0, "instancia": "1", "processos": [
    {"numeroUnico": "çã", "sequencial": 1, "instancia": "2", "processos": []}]}]}
ESCAPED = json.dumps(TREE, ensure_ascii=False).replace('"', "&quot;").replace("ç", "&ccedil;")

BODY = f"""<?xml version="1.0"?><soap:Envelope xmlns:soap="s"><soap:Body>
<ns4:consultarProcessoResposta xmlns:ns4="d" xmlns:ns2="b"><sucesso>TRUE</sucesso><mensagem>ok</mensagem>
<processo><ns2:dadosBasicos classeProcessual="108" dataAjuizamento="20230522230301" competencia="4">
<ns2:assunto principal="true"><ns2:codigoNacional>9</ns2:codigoNacional></ns2:assunto>
<ns2:assunto><ns2:codigoNacional> </ns2:codigoNacional></ns2:assunto>
<ns2:outroParametro nome="situacao" valor="velha"/><ns2:outroParametro nome="situacao" valor="nova"/>
<ns2:outroParametro nome="ARVORE_PROCESSUAL" valor={quoteattr(ESCAPED)}/>
<ns2:orgaoJulgador codigoOrgao="7" nomeOrgao="Vara" codigoMunicipioIBGE="41" instancia="1"/>
<ns2:valorCausa>10.50</ns2:valorCausa></ns2:dadosBasicos>
<ns2:movimento identificadorMovimento="10" dataHora="20230103000000"><ns2:complemento>z</ns2:complemento></ns2:movimento>
<ns2:movimento identificadorMovimento="9" dataHora="2023"><ns2:movimentoNacional codigoNacional="26">
<ns2:complemento>Distribuição</ns2:complemento></ns2:movimentoNacional>
<ns2:complemento>a</ns2:complemento><ns2:complemento></ns2:complemento><ns2:complemento>Por: X - Y</ns2:complemento></ns2:movimento>
<ns2:movimento dataHora="20230101000000"/>
</processo></ns4:consultarProcessoResposta></soap:Body></soap:Envelope>"""
EMPTY = BODY[:BODY.index("<processo>")] + BODY[BODY.index("</ns4:"):]


def parsed(spark):
    frame = spark.createDataFrame([("1", BODY), ("2", EMPTY.replace("TRUE", "false")), ("3", "<cut"), ("4", None)],
                                  "numero string, corpo string")
    received = F.lit("2024-01-31T10:11:12Z").cast("timestamp")
    return responses.parse_responses(responses.wrap_response(frame, "numero", "corpo", received, "S"))


def test_flags_and_rejects(spark):
    rows = {r.numero_processo: r for r in parsed(spark).collect()}
    assert (rows["1"].sucesso, rows["1"].mensagem, rows["2"].sucesso, rows["3"].sucesso) == (True, "ok", False, None)
    assert rows["1"].timestamp == "20240131_101112"
    assert rows["1"].metadata.file_size_bytes == len(BODY.encode())
    assert rows["3"]._corrupt_record is not None and rows["1"]._corrupt_record is None


def test_basic_data_and_digest(spark):
    basic = {r.numero_processo: r for r in responses.basic_data(parsed(spark)).collect()}
    assert (basic["1"].codigos_nacionais, basic["1"].total_assuntos, basic["1"].nome_orgao) == ("9", 2, "Vara")
    assert basic["2"].classe_processual is None and basic["2"].total_parametros == 0
    digest = {r.numero_processo: r for r in responses.case_digest(parsed(spark)).collect()}
    assert digest["1"].situacao == "nova" and digest["1"].status is None
    assert digest["1"].total_movimentos == 3
    assert (digest["1"].ultimo_movimento_data, digest["1"].ultimo_movimento_descricao) == ("03/01/2023 00:00:00", "z")
    assert digest["1"].data_ajuizamento == "22/05/2023 23:03:01"
    assert digest["2"].total_movimentos == 0 and digest["2"].ultimo_movimento_data is None


def test_movements_sorted_by_number(spark):
    rows = [r for r in responses.xml_movement_table(parsed(spark)).orderBy("ordem").collect()]
    assert [r.movimento_sequencia for r in rows] == [None, "9", "10"]
    assert [r.movimento_data_hora for r in rows] == ["01/01/2023 00:00:00", None, "03/01/2023 00:00:00"]
    assert (rows[1].movimento_codigo, rows[1].movimento_nome, rows[1].total_complementos) == ("26", "Distribuição", 2)


def test_tree_parameter(spark):
    nodes = tree.flatten_trees(responses.tree_text(parsed(spark))).collect()
    assert {(r.processo_raiz, r.numero_processo, r.profundidade) for r in nodes} == {("1", "1", 0), ("1", "çã", 1)}


def test_organised_documents_feed_the_service_tables(spark):
    documents = responses.organise_responses(parsed(spark), F.lit("x_raw.json"))
    cases = {r.numero_processo: r for r in nested.service_case_table(documents).collect()}
    assert (cases["1"].valor_causa, cases["1"].total_movimentos, cases["1"].situacao) == (10.5, 3, "nova")
    assert cases["1"].data_formatada == "31/01/2024 10:11:12"
    moves = nested.service_movement_table(documents).filter("movimento_sequencia = '9'").first()
    assert (moves.complemento_projudi_nome, moves.complemento_projudi_movimentado_por_cargo) == ("a", "y")
    nodes = tree.flatten_trees(tree.tree_of_document(documents))
    assert nodes.count() == 2


def test_orders_of_one_row_group_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    """Without a setting the number of rows decides how many tasks make and parse documents."""
    monkeypatch.setattr(proxies, "DEALT", 10)
    spark.range(300).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"), F.lit("1996-01-02").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("caseflow.read.tasks", None)
    spark.conf.unset("caseflow.read.tasks")
    try:
        made = proxies.responses(spark, str(tmp_path))
        own = made.groupBy(F.spark_partition_id()).count().collect()
    finally:
        if before is not None:
            spark.conf.set("caseflow.read.tasks", before)
    assert made.rdd.getNumPartitions() == 31 and len(own) > 20 and sum(r["count"] for r in own) == 300
