"""Queries of the training-data operators and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import (bitplane, decontaminate, importance, jaccard_join, knn_quality, line_dedup, packing, pca_dedup,
                          pii_boost, site_style, suffix_tree, toxicity, whitening)
from caseflow.llm.common import ready
from caseflow.session import shared_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(ready(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity")
def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE_SQL = f"""
WITH bench AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
        ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS win
    FROM bench),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
grams AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM docs, sizes WHERE len(w) >= size),
found AS (
    SELECT g.doc_id, g.i, g.size, x.item
    FROM (SELECT doc_id, i, size, w[i:i + size - 1] AS win FROM grams) g JOIN windows x USING (win)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op2_decontaminate", DECONTAMINATE_SQL)
def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


JACCARD_SQL = """
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * k >= 80 * (nx + ny - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM sets
    UNION SELECT r.node, e.y FROM reach r JOIN both_ways e ON r.seen = e.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON s.doc_id = c.node
"""


@query("op3_jaccard_join", JACCARD_SQL)
def _jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


@query("op4_suffix_tree")
def _suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(table(spark, sf_dir, "documents"))


@query("op5_bitplane")
def _bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark)
    bitplane.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return bitplane.report(spark, path)


@query("op6_knn_quality")
def _knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


PCA_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding::DOUBLE[], lambda x: x != 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
        AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM embeddings
    UNION SELECT r.node, l.y FROM reach r JOIN links l ON r.seen = l.x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT node AS vec_id, min(seen) AS component_id FROM reach GROUP BY node)
LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x) USING (vec_id)
"""


@query("op8_pca_dedup", PCA_SQL)
def _pca_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_dedup.deduplicated(table(spark, sf_dir, "embeddings"))


@query("op9_site_style")
def _site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extracted(table(spark, sf_dir, "pages"))


@query("op10_pii_boost")
def _pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.found(table(spark, sf_dir, "documents"))


IMPORTANCE_SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
        ORDER BY b) AS t FROM range(256) r(b)),
docs AS (SELECT doc_id, {words} AS w FROM documents),
bench AS (SELECT {words} AS w FROM benchmark),
features AS (SELECT doc_id, unnest(w) AS f FROM docs),
wanted AS (SELECT unnest(w) AS f FROM bench),
crcs AS (
    SELECT f, xor(list_reduce(
        list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), (2 * i + 1)::BIGINT, 2))::BIGINT),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT f FROM features UNION SELECT f FROM wanted), crc_table),
source AS (SELECT bucket, count(*) AS s FROM features JOIN crcs USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN crcs USING (f) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM features) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM source LEFT JOIN target USING (bucket)),
weights AS (
    SELECT doc_id, sum(gain)::BIGINT AS weight FROM features JOIN crcs USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (doc_id)),
places AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN places USING (doc_id)
""".replace("{words}", _WORDS)


@query("op11_importance", IMPORTANCE_SQL)
def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_whitening")
def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = whitening.fitted(vectors)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    rows = whitening.whitened(vectors, model).drop("embedding")
    explained = F.array(*[F.lit(float(e / model.total)) for e in model.variances])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(whitening.identity_error(rows)).alias("identity_error"))


LINES_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p
    FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (
    SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id > first) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE first IS NULL OR doc_id = first), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""


@query("op13_line_dedup", LINES_SQL)
def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))
