"""Document and XML ingestion, service tables, rejects (SC1-SC7, UN*, PJ*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators import nested, responses
from caseflow.plans import proxies as px
from caseflow.plans.registry import query
from caseflow.sources import readers


def _case_documents(spark, sf_dir) -> DataFrame:
    return readers.parse_case_text(px.case_documents_text(spark, sf_dir), "texto")


NUM = px.CASE_NUMBER_SQL


@query("ingest_cases", f"""
SELECT 'T1_' || {NUM} AS id, {NUM} AS processo, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS classe_codigo,
  o_orderpriority AS classe_nome, strftime(o_orderdate, '%Y%m%d%H%M%S') AS data_ajuizamento,
  o_custkey % 25 AS orgao_julgador_codigo, 'Vara ' || (o_custkey % 25) AS orgao_julgador_nome,
  o_custkey % 5 AS orgao_julgador_municipio_ibge, 'T1' AS tribunal,
  CASE WHEN o_orderkey % 2 = 0 THEN 'G1' ELSE 'G2' END AS grau
FROM orders""")
def ingest_cases(spark, sf_dir):
    return nested.case_table(_case_documents(spark, sf_dir))


@query("ingest_subjects", f"""
SELECT 'T1_' || {NUM} AS id, {NUM} AS processo, j * 1000 + o_custkey % 100 AS assunto_codigo,
       'Assunto ' || j AS assunto_nome
FROM orders, unnest(generate_series(1, o_custkey % 3)) AS t(j)""")
def ingest_subjects(spark, sf_dir):
    return nested.subject_table(_case_documents(spark, sf_dir))


_MOVES_SQL = f"""moves AS (
  SELECT o_orderkey, j, 'T1_' || {NUM} AS id, {NUM} AS processo,
         CASE WHEN (o_orderkey + j) % 11 = 0 THEN '{{}}' ELSE CAST(j + 100 AS VARCHAR) END AS movimento_codigo,
         'Mov ' || j AS movimento_nome,
         strftime(o_orderdate + to_seconds(90061 * j), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS movimento_data_hora
  FROM orders, unnest(generate_series(1, o_orderkey % 4)) AS t(j)),
ingested AS (
  SELECT m.*, c FROM moves m
  LEFT JOIN LATERAL (SELECT unnest(generate_series(1, (m.o_orderkey + m.j) % 3)) AS c) ON TRUE)"""


@query("ingest_moves", f"""
WITH {_MOVES_SQL}
SELECT id, processo, movimento_codigo, movimento_nome, movimento_data_hora,
       c * 10 AS complemento_codigo, 'tipo ' || c AS complemento_nome,
       CASE WHEN c IS NULL THEN NULL WHEN (o_orderkey + j + c) % 2 = 0 THEN CAST(j * c AS VARCHAR)
            ELSE '{{}}' END AS complemento_valor,
       'valor_' || c AS complemento_descricao
FROM ingested""")
def ingest_moves(spark, sf_dir):
    return nested.movement_table(_case_documents(spark, sf_dir))


@query("clean_moves", f"""
WITH {_MOVES_SQL}
SELECT processo, CAST(movimento_codigo AS BIGINT) AS movimento_codigo, movimento_data_hora AS movimento_data_hora_raw,
       strftime(strptime(movimento_data_hora, '%Y-%m-%dT%H:%M:%S.%gZ'), '%Y-%m-%d %H:%M:%S') AS movimento_data_hora,
       strftime(strptime(movimento_data_hora, '%Y-%m-%dT%H:%M:%S.%gZ'), '%Y-%m-01') AS movimento_mes,
       CAST(substr(movimento_data_hora, 1, 4) AS BIGINT) AS movimento_ano, c * 10 AS complemento_codigo
FROM ingested WHERE movimento_codigo <> '{{}}'""")
def clean_moves(spark, sf_dir):
    """UN2, FL4, TS1, TS3, PJ9: movements with parsed times and integer codes."""
    rows = nested.clean_movements(nested.usable_codes(nested.movement_table(_case_documents(spark, sf_dir))))
    return rows.select(
        "processo", F.col("movimento_codigo").try_cast("bigint").alias("movimento_codigo"),
        "movimento_data_hora_raw",
        F.date_format("movimento_data_hora", "yyyy-MM-dd HH:mm:ss").alias("movimento_data_hora"),
        px.day(F.col("movimento_mes")).alias("movimento_mes"),
        F.col("movimento_ano").cast("bigint").alias("movimento_ano"), "complemento_codigo")


@query("rejects", """
SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'rejeitado' ELSE 'aceito' END AS situacao,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS soma_chaves
FROM orders GROUP BY 1""")
def rejects(spark, sf_dir):
    """UN9: every 17th document is cut short; it is set aside and the rest is parsed."""
    text = px.case_documents_text(spark, sf_dir)
    cut = F.when(F.col("o_orderkey") % 17 == 0, F.expr("left(texto, length(texto) - 20)")).otherwise(F.col("texto"))
    good, bad = readers.split_rejects(readers.parse_case_text(text.withColumn("texto", cut), "texto"))
    both = good.select(F.lit("aceito").alias("situacao"), "o_orderkey").unionByName(
        bad.select(F.lit("rejeitado").alias("situacao"), "o_orderkey"))
    return both.groupBy("situacao").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("soma_chaves"))


# ---- organised service documents -----------------------------------------------------------


def _organised(spark, sf_dir) -> DataFrame:
    return readers.parse_organised_text(px.organised_documents_text(spark, sf_dir), "texto")


_SERVICE_CASES_SQL = f"""service AS (SELECT *, {NUM} AS num,
  CASE WHEN o_orderkey % 5 = 0 THEN 'R$ 10' WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE CAST(o_totalprice AS VARCHAR) END AS valor_texto FROM orders)"""


@query("mni_cases", f"""
WITH {_SERVICE_CASES_SQL}
SELECT num AS numero_processo, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS data_consulta,
  strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS data_formatada, num || '_raw.json' AS arquivo_origem,
  substr(o_orderpriority, 1, 1) AS classe_processual, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS data_ajuizamento,
  try_cast(valor_texto AS DOUBLE) AS valor_causa,
  'Vara ' || (o_custkey % 25) AS orgao_julgador_nome, o_orderstatus AS situacao,
  CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'ativo' END AS status,
  CAST(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 END AS BIGINT) AS total_movimentos,
  CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') END AS ultimo_movimento_data,
  CASE WHEN o_orderkey % 4 > 0 THEN 'fim' END AS ultimo_movimento_descricao,
  CAST(o_custkey % 3 AS VARCHAR) AS competencia, CAST(o_custkey % 7 AS VARCHAR) AS codigo_localidade,
  o_orderkey % 3 = 0 AS juizo_100_digital,
  CAST(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 6 END AS BIGINT) AS nivel_sigilo,
  CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 1000) / 8.0 END AS custas_recolhidas,
  CAST(o_custkey % 25 AS VARCHAR) AS codigo_orgao, CAST(o_custkey % 5 AS VARCHAR) AS codigo_municipio_ibge,
  '1' AS instancia
FROM service""")
def mni_cases(spark, sf_dir):
    rows = nested.service_case_table(_organised(spark, sf_dir))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("total_movimentos", "nivel_sigilo")})


@query("ingest_complements", f"""
WITH moves AS (
  SELECT *, {NUM} AS num, (o_orderkey + j) % 5 AS n, o_orderdate + to_seconds(90061 * j) AS moment
  FROM orders, unnest(generate_series(1, o_orderkey % 4)) AS t(j)),
texts AS (
  SELECT *, CASE WHEN n > 1 THEN CASE o_custkey % 3 WHEN 0 THEN 'Movimentada Por: Ana ' || o_custkey || ' - Juiz'
                                 WHEN 1 THEN 'Por: SISTEMA' ELSE 'sem autor' END
                 WHEN n = 1 THEN 'item 1' END AS ultimo
  FROM moves)
SELECT num AS numero_processo, CAST(j AS VARCHAR) AS movimento_sequencia,
  strftime(moment, '%d/%m/%Y %H:%M:%S') AS movimento_data_hora, strftime(moment, '%Y%m%d%H%M%S') AS movimento_data_hora_raw,
  '108' AS classe_processual, CAST(j + 50 AS VARCHAR) AS movimento_codigo, 'Nac ' || j AS movimento_nome,
  CASE WHEN n > 0 THEN 'item 1' END AS complemento_projudi_nome,
  CASE WHEN n > 2 THEN array_to_string(list_transform(generate_series(2, n - 1), lambda i: 'item ' || i), ' | ') END
    AS complemento_projudi_descricao,
  ultimo AS complemento_projudi_movimentado_por,
  lower(trim(string_split(ultimo, ':')[1])) AS complemento_projudi_movimentado_por_descricao,
  lower(trim(string_split(string_split(ultimo, ':')[2], ' - ')[1])) AS complemento_projudi_movimentado_por_nome,
  lower(trim(string_split(string_split(ultimo, ':')[2], ' - ')[2])) AS complemento_projudi_movimentado_por_cargo
FROM texts""")
def ingest_complements(spark, sf_dir):
    return nested.service_movement_table(_organised(spark, sf_dir))


_RECORDS_SQL = f"""{_SERVICE_CASES_SQL}, records AS (
  SELECT num || '_organized.json' AS _arquivo_origem,
    array_to_string(list_filter([CASE WHEN o_custkey % 3 > 0 AND o_custkey % 4 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END,
      CASE WHEN o_custkey % 3 > 1 THEN CAST(o_custkey % 50 + 100 AS VARCHAR) END], lambda x: x IS NOT NULL), ', ')
      AS codigos_nacionais,
    CAST((o_custkey % 3 > 0 AND o_custkey % 4 <> 0) AS BIGINT) + CAST((o_custkey % 3 > 1) AS BIGINT)
      AS total_codigos_nacionais,
    substr(o_orderpriority, 1, 1) AS classe_processual, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS data_ajuizamento,
    num AS numero_processo, 'Vara ' || (o_custkey % 25) AS orgao_julgador, o_orderstatus AS situacao,
    CASE WHEN o_custkey % 2 = 0 THEN '' ELSE 'ativo' END AS status,
    CASE WHEN o_orderkey % 9 = 0 THEN 'muitos' ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS total_movimentos,
    CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') END AS ultimo_movimento_data,
    CASE WHEN o_orderkey % 4 > 0 THEN 'fim' END AS ultimo_movimento_descricao,
    replace(valor_texto, '.', ',') AS valor_causa
  FROM service)"""


def summary_records(spark, sf_dir) -> DataFrame:
    return nested.summary_records(_organised(spark, sf_dir)).drop("_timestamp_processamento")


@query("summary_records", f"WITH {_RECORDS_SQL} SELECT * FROM records")
def summary(spark, sf_dir):
    rows = summary_records(spark, sf_dir)
    return rows.withColumn("total_codigos_nacionais", F.col("total_codigos_nacionais").cast("bigint"))


RECORDS_SQL = _RECORDS_SQL


# ---- XML responses ---------------------------------------------------------------------------


def _parsed(spark, sf_dir) -> DataFrame:
    raw = responses.wrap_response(
        px.responses(spark, sf_dir), "numero", "corpo", F.col("recebido"), "SERVICE")
    return responses.parse_responses(raw)


_XML_MOVES_SQL = f"""xml_moves AS (
  SELECT {NUM} AS num, j, o_orderkey, o_orderdate + to_seconds(90061 * j) AS moment, (o_orderkey + j) % 3 AS n
  FROM orders, unnest(generate_series(1, o_orderkey % 4)) AS t(j))"""


@query("xml_envelope", f"""
SELECT {NUM} AS numero_processo, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS timestamp,
       strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS data_formatada, TRUE AS tem_tamanho,
       'utf-8' AS encoding, o_orderkey % 10 <> 0 AS sucesso, 'm' || (o_orderkey % 3) AS mensagem
FROM orders""")
def xml_envelope(spark, sf_dir):
    """PJ19, PJ20, TS11: response flag, message and lineage of each stored response."""
    from caseflow.functions import timestamps as ts

    return _parsed(spark, sf_dir).select(
        "numero_processo", "timestamp",
        ts.query_time_to_display(F.col("timestamp")).alias("data_formatada"),
        (F.col("metadata.file_size_bytes") > 500).alias("tem_tamanho"),
        F.col("metadata.encoding").alias("encoding"), "sucesso", "mensagem")


@query("xml_moves", f"""
WITH {_XML_MOVES_SQL}
SELECT num AS numero_processo, j AS ordem, CAST(j AS VARCHAR) AS movimento_sequencia,
  strftime(moment, '%Y%m%d%H%M%S') AS movimento_data_hora_raw, strftime(moment, '%d/%m/%Y %H:%M:%S') AS movimento_data_hora,
  n AS total_complementos, CASE WHEN n > 0 THEN 'comp ' || j || '.1' END AS complemento_projudi_nome,
  CASE WHEN j % 2 = 1 THEN CAST(j + 50 AS VARCHAR) END AS movimento_codigo,
  CASE WHEN j % 2 = 1 THEN 'Nac ' || j END AS movimento_nome
FROM xml_moves""")
def xml_moves(spark, sf_dir):
    rows = responses.xml_movement_table(_parsed(spark, sf_dir))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("ordem", "total_complementos")})


@query("xml_basic", f"""
SELECT {NUM} AS numero_processo, o_orderkey % 10 <> 0 AS sucesso, 'm' || (o_orderkey % 3) AS mensagem,
  CAST(o_custkey % 3 AS VARCHAR) AS competencia, substr(o_orderpriority, 1, 1) AS classe_processual,
  strftime(o_orderdate, '%Y%m%d%H%M%S') AS data_ajuizamento_raw, '0' AS nivel_sigilo,
  CAST(o_custkey % 7 AS VARCHAR) AS codigo_localidade, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS valor_causa,
  CAST(NULL AS VARCHAR) AS juizo_100_digital, CAST(NULL AS VARCHAR) AS custas_recolhidas,
  CAST(o_custkey % 25 AS VARCHAR) AS codigo_orgao, 'Vara & ' || (o_custkey % 25) AS nome_orgao,
  array_to_string(list_transform(generate_series(1, o_custkey % 3), lambda j: CAST(o_custkey % 50 + j AS VARCHAR)), ', ')
    AS codigos_nacionais,
  o_custkey % 3 AS total_assuntos, CAST(CASE WHEN o_orderkey % 13 <> 0 THEN 3 ELSE 2 END AS BIGINT) AS total_parametros,
  o_orderkey % 13 <> 0 AS tem_arvore
FROM orders""")
def xml_basic(spark, sf_dir):
    rows = responses.basic_data(_parsed(spark, sf_dir))
    return rows.withColumn("tem_arvore", F.col("arvore_raw").isNotNull()).drop("arvore_raw").withColumns({
        c: F.col(c).cast("bigint") for c in ("total_assuntos", "total_parametros")})


@query("case_digest", f"""
SELECT {NUM} AS numero_processo, substr(o_orderpriority, 1, 1) AS classe_processual,
  strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS data_ajuizamento,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS valor_causa, 'Vara & ' || (o_custkey % 25) AS orgao_julgador,
  o_orderstatus AS situacao, CAST(NULL AS VARCHAR) AS status, o_orderkey % 4 AS total_movimentos,
  CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate + to_seconds(90061 * (o_orderkey % 4)), '%d/%m/%Y %H:%M:%S') END
    AS ultimo_movimento_data,
  CASE WHEN o_orderkey % 4 > 0 AND (o_orderkey + o_orderkey % 4) % 3 > 0
       THEN 'comp ' || (o_orderkey % 4) || '.1' END AS ultimo_movimento_descricao
FROM orders""")
def case_digest(spark, sf_dir):
    rows = responses.case_digest(_parsed(spark, sf_dir))
    return rows.withColumn("total_movimentos", F.col("total_movimentos").cast("bigint"))


@query("xml_to_service_moves", f"""
WITH {_XML_MOVES_SQL}
SELECT num AS numero_processo, CAST(j AS VARCHAR) AS movimento_sequencia,
  strftime(moment, '%d/%m/%Y %H:%M:%S') AS movimento_data_hora, CASE WHEN n > 0 THEN 'comp ' || j || '.1' END AS primeiro,
  CASE WHEN n > 0 THEN 'comp ' || j || '.' || n END AS ultimo
FROM xml_moves""")
def xml_to_service_moves(spark, sf_dir):
    """The whole per-case path: envelope, XML, organised document, movement table."""
    organised = responses.organise_responses(
        _parsed(spark, sf_dir), F.concat("numero_processo", F.lit("_raw.json")))
    rows = nested.service_movement_table(organised)
    return rows.select("numero_processo", "movimento_sequencia", "movimento_data_hora",
                       F.col("complemento_projudi_nome").alias("primeiro"),
                       F.col("complemento_projudi_movimentado_por").alias("ultimo"))
