"""The registered queries of the training-data operators.

Each takes ``(spark, sf_dir)``, applies its operator with production
parameters to its whole table and derives the result columns from the
operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import fill_in_middle, license_scan


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import simhash

    out = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import warc

    out = warc.archive_pages(spark, _table(spark, sf_dir, "pages"))
    return out.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import language_id

    docs = _table(spark, sf_dir, "documents")
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % 4 == 2, F.lit(False))
    model = language_id.learn(spark, docs, ~held("doc_id"))
    return language_id.predict(docs, model).select("doc_id", held("doc_id").alias("held_out"), "lang_pred", "score")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import quality

    out = quality.apply_rules(spark, _table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select("doc_id", *base, "kept", "log_perplexity", "lower", "upper")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import token_counts

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import packing

    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op7_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import bpe_replay

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_replay.encode(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, digests_only=True).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import embedding_dedup

    return embedding_dedup.near_duplicates(spark, _table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    held = lambda c: F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.learn(spark, docs, _table(spark, sf_dir, "labels"), train=lambda c: ~held(c))
    return toxicity.score(docs, model).select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.transform(_table(spark, sf_dir, "documents"), digests_only=True)


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import piece_bpe

    return piece_bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digests_only=True)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabularium.llm import hard_negatives

    label = F.col("label").cast("long")
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(spark, vectors, is_anchor=lambda c: c % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_zstd": op1_warc_zstd,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_token_counts": op5_token_counts,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_bpe_replay": op7_bpe_replay,
    "op8_packing": op8_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op1_warc_zstd": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS main FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN main > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN main > page_id THEN main END AS refers_to FROM m
""",
    "op4_license_scan": license_scan.oracle_sql(),
    "op11_fill_in_middle": fill_in_middle.oracle_sql(),
    "op13_hard_negatives": """
WITH g AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
