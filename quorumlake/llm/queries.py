"""Queries of the training-data operators and, where SQL can express them, their oracles."""

from __future__ import annotations

import warnings

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.llm import bpe, exact_dedup, fingerprints, hard_negatives, importance, language_id, licenses, media, mixing, near_dedup, pii, warc, whitening
from quorumlake.plans.shipping import ship
from quorumlake.plans.staging import Stage, new_path

#: A run over real data passes its own secret in this setting. The published key is for the synthetic tables alone:
#: whoever knows a key can undo its surrogates.
KEY_SETTING, PUBLISHED_KEY = "spark.quorumlake.pii.key", "published-key-of-the-synthetic-tables"
TOKENS = "byte_bpe_multi_50k.tiktoken"


def pii_key(spark: SparkSession) -> bytes:
    """The session's key; without one the published key, with a warning."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: surrogates are made with a published key", stacklevel=2)
    return (key or PUBLISHED_KEY).encode()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"), weights=[5, 2, 1], share=1.5, cap=2.0)
    return m.select("doc_id", "size", "source_size", "target", "taken")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with surrogates, and where those are; what was replaced is not returned."""
    out = pii.anonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii_key(spark))
    return out.select("doc_id", "text", F.size("pii_spans").alias("n_entities"), "pii_spans")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.components(table(spark, sf_dir, "documents"), radius=2, width=3)
    return found.select("doc_id", near_dedup.hexadecimal("fp").alias("fingerprint"), "component_id")


def op3_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures of all embeddings are searched for edited pictures of those whose id is divisible by 100: a row for
    each picture and each query with its class of copies."""
    return media.search(table(spark, sf_dir, "embeddings"), every=100).withColumnRenamed("id", "vec_id")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also, for documents whose id is divisible by 100, ``n_near``: how many other documents have a
    fingerprint within 3 bits, by the permuted block tables over all documents."""
    prints = Stage(spark, "op4").put(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")), "prints")
    asked = prints.where("doc_id % 100 = 0").select("fingerprint").distinct()
    counts = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = fingerprints.within_radius(asked, counts, radius=3)
    near = near.join(counts, near["found"] == counts["fingerprint"]).groupBy("query").agg((F.sum("n") - 1).alias("n_near"))
    near = near.select(F.col("query").alias("fingerprint"), "n_near", F.lit(0).alias("_asked"))
    out = prints.withColumn("_asked", (F.col("doc_id") % 100).cast("int")).join(near, ["fingerprint", "_asked"], "left")
    hexed = {c: fingerprints.hexadecimal(F.col(c)) for c in ("fingerprint", "edited_fingerprint")}
    return out.withColumns(hexed).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, declared by their lang and hosted by their source."""
    return language_id.documents(table(spark, sf_dir, "documents"))


def op5_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over web pages, with all kinds of evidence: markup language, address suffix, domain and host."""
    model = language_id.fit(table(spark, sf_dir, "documents"), ["de", "en", "es", "fr"])
    return language_id.pages(table(spark, sf_dir, "pages"), model)


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(TOKENS), public_tokenizers.PATTERN
    both = bpe.encode(table(spark, sf_dir, "documents"), path, pattern, back=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "template", "containment")


def op8_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are decoded and digested again as read; revisits are read by their headers alone."""
    path = new_path(spark, "warc")
    warc.write(warc.deduplicated(table(spark, sf_dir, "pages"), least=100), path)
    page = lambda c: F.expr(f"try_cast(nullif(substring({c}, 10), '') as bigint)")
    responses = warc.read(spark, path).where("warc_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = warc.read(spark, path).where("warc_type = 'revisit'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to")
    )
    return responses.unionByName(revisits)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.marks(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(e.select("vec_id", "embedding", label.alias("label")), anchors=F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_image_copies": op3_image_copies,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_language_id": op5_language_id,
    "op5_language_id_pages": op5_language_id_pages,
    "op6_byte_level_bpe": op6_byte_level_bpe,
    "op7_license_scan": op7_license_scan,
    "op8_warc_archives": op8_warc_archives,
    "op9_importance_resampling": op9_importance_resampling,
    "op10_source_mix": op10_source_mix,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_embedding_whitening": op13_embedding_whitening,
}

#: Shingles of the templates and of a text, as the license scan verifies them, without its windows.
_LICENSE_ROWS = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items())

ORACLES = {
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm, length(COALESCE(text, '')) AS n FROM documents)
SELECT doc_id, FIRST_VALUE(doc_id) OVER g AS keep_id, COUNT(*) OVER (PARTITION BY norm) AS group_size, ROW_NUMBER() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""",
    "op12_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, p.id AS positive_id, (ROW_NUMBER() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id))::INT AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score QUALIFY rank <= 10
""",
    "op7_license_scan": rf"""
WITH w AS (
  SELECT doc_id AS id, NULL AS template, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents
  UNION ALL
  SELECT NULL, template, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') FROM (VALUES {_LICENSE_ROWS}) AS v(template, text)),
s AS (
  SELECT id, template, array_to_string(w[i:i+4], ' ') AS shingle
  FROM (SELECT id, template, w, UNNEST(range(1, GREATEST(len(w) - 3, 1))) AS i FROM w)),
t AS (SELECT DISTINCT template, shingle FROM s WHERE template IS NOT NULL),
n AS (SELECT template, COUNT(*) AS n FROM t GROUP BY template)
SELECT d.id AS doc_id, t.template, COUNT(DISTINCT t.shingle) / ANY_VALUE(n.n)::DOUBLE AS containment
FROM (SELECT id, shingle FROM s WHERE template IS NULL) d JOIN t USING (shingle) JOIN n ON n.template = t.template
GROUP BY d.id, t.template HAVING COUNT(DISTINCT t.shingle) / ANY_VALUE(n.n)::DOUBLE >= 0.8
""",
    "op8_warc_archives": """
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS f FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> page_id THEN f END AS refers_to
FROM r
""",
    "op10_source_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || doc_id::VARCHAR) AS k
  FROM documents),
s AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
lvl(i, level, n) AS (
  SELECT 0, (1.5 * SUM(source_size)::DOUBLE) / SUM(w)::DOUBLE, 0::BIGINT FROM s
  UNION ALL
  SELECT i + 1, (SELECT (1.5 * SUM(source_size)::DOUBLE - 2.0 * COALESCE(SUM(source_size) FILTER (w * level > 2.0 * source_size), 0)::DOUBLE)
                        / (SUM(w) FILTER (NOT w * level > 2.0 * source_size))::DOUBLE FROM s),
         (SELECT COUNT(*) FILTER (w * level > 2.0 * source_size) FROM s)
  FROM lvl WHERE i < 40 AND (i = 0 OR n <> (SELECT COUNT(*) FILTER (w * level > 2.0 * source_size) FROM s))),
t AS (SELECT source, source_size, LEAST(w * (SELECT level FROM lvl ORDER BY i DESC LIMIT 1), 2.0 * source_size) AS target FROM s),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, FLOOR(t.target)::BIGINT AS budget,
         (SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + LEAST(GREATEST(budget - (budget // source_size) * source_size - start, 0), size) END::BIGINT AS taken
FROM p
""",
}
