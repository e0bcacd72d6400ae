"""Queries of the thirteen operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from ..session import scratch_path
from .common import table
from .decontaminate import report
from .embedding_dedup import near_duplicate_vectors
from .hard_negatives import hard_negatives
from .license_scan import license_report
from .line_dedup import line_report
from .packing import pack_documents
from .quality import quality_report
from .sharding import shard_documents
from .simhash import fingerprint_hex, near_duplicate_classes
from .substring_dedup import passage_report
from .token_alignment import aligned
from .token_files import read_token_files, write_token_files
from .warc import archive_pages


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    return read_token_files(spark, path)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicate_classes(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return rows.select("doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, 1024)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 24)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, _ = aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))
    return texts.withColumn("doc_id", texts["doc_id"].cast("long"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_report(table(spark, sf_dir, "documents"), 50).drop("longest")


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_license_scan, op3_line_dedup, op4_warc, op5_simhash, op6_quality, op7_packing,
    op8_embedding_dedup, op9_sharding, op10_decontaminate, op11_token_alignment, op12_hard_negatives, op13_substring_dedup)}
ORACLES = {
    "op4_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM k
""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS len FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.len > 0 AND b.len > 0
   AND list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.9
), reach(vec_id, r) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT link.a, reach.r FROM reach JOIN link ON link.b = reach.vec_id
)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON n.a = v.vec_id
JOIN (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) c ON c.vec_id = v.vec_id
""",
    "op10_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)
), pos AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b)
), hit AS (
  SELECT p.doc_id, p.i, p.n, win.item_id FROM pos p
  JOIN win ON win.n = p.n AND win.g = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')
), words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5
""",
    "op13_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
), hit AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS k FROM hit GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, d.w, coalesce(k, []) AS k FROM d LEFT JOIN gone USING (doc_id)
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM kept
), left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t
  FROM words ANTI JOIN (SELECT doc_id, unnest(k) AS j FROM gone) g USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(k) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN left_over USING (doc_id)
""",
}
