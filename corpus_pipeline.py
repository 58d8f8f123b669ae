"""A training-data pipeline: each stage reads what the one before has kept.

Toxic documents go, then documents that fail the quality rules; of each group
of near-duplicates one document stays, and what is left is packed into
sequences. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import packing, quality, simhash, toxicity
from tabularium.llm.common import Scratch

#: Near-duplicates share at least 0.8 of their five-word shingles. Candidates: SimHashes of two-word shingles, which an
#: edit changes least, differ in at most so many bits.
SHINGLE, NEAR_BITS = 2, 10
#: Of those, the ones that have 0.8 of their five-word shingles in common, by an exact comparison.
CHECK = (5, 0.8)


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct, so that no other column's name can clash; the stages read the text from within it."""
    return docs.select(F.struct("*").alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity stays below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(spark, docs, labels, train=lambda c: F.crc32(c.cast("string")) % 5 != 0)
    return toxicity.score(_rows(docs), model, keep=("row",), text_col="row.text").where("predicted = 0").select("row.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band."""
    return quality.apply_rules(spark, _rows(docs), text_col="row.text", lang_col="row.lang", keep=["row"]).where("kept").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(spark, docs, shingle=SHINGLE, max_bits=NEAR_BITS, check=CHECK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Learned models decide two stages, which SQL can't express; tests hold each stage against plain versions of its rule.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = scratch.write(docs, str(number))
            if number:
                scratch.drop(str(number - 1))
    return docs
