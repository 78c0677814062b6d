"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinline.llm import language_id
from twinline.llm.archives import pages_through_archives
from twinline.llm.bpe import encode_documents
from twinline.llm.common import read_table
from twinline.llm.exact_dedup import exact_dedup
from twinline.llm.hard_negatives import mine
from twinline.llm.lexical_search import search
from twinline.llm.mixing import mix
from twinline.llm.quality import quality_rules, vocabulary_path
from twinline.llm.sharding import shard
from twinline.llm.simhash import simhash_dedup
from twinline.llm.suffix_dedup import remove_repeats
from twinline.llm.token_counts import section_token_counts
from twinline.llm.vector_dedup import near_dedup


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    flags = docs.withColumn("_pair", F.struct("doc_id", language_id.held_out().alias("held_out")))
    out = language_id.predict(flags, model, id_col="_pair")
    return out.select("_pair.doc_id", "_pair.held_out", "lang_pred", "score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_archives(read_table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN, digest=True)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(read_table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_token_counts(read_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, rule="start")


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_token_counts": op10_token_counts,
    "op11_vector_dedup": op11_vector_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_warc": r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM w""",
    "op1_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm, length(coalesce(text, '')) AS len
  FROM documents),
g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op11_vector_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM link l WHERE l.a = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
       coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) >= e.vec_id AS kept
FROM embeddings e""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
p AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM p, c GROUP BY term, n_docs),
s AS (
  SELECT item_id, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20""",
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS u
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.u, b.u)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
