"""The registered queries, and the pipeline stage by stage."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tabularium.llm import packing, quality, queries, simhash, toxicity

COLUMNS = {
    "op1_": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_": "doc_id held_out lang_pred score",
    "op3_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_": "doc_id license dice n_matches",
    "op5_": "doc_id n_bytes n_tokens over_limit",
    "op6_": "doc_id fingerprint component_id",
    "op7_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9_": "vec_id n_links component_id kept",
    "op10_": "doc_id held_out score predicted",
    "op11_": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, sf, name):
    out = entry.queries()[name](spark, sf)
    wanted = COLUMNS[name[: name.index("_") + 1]].split()
    assert out.columns[: len(wanted)] == wanted
    table = {"op1_": "pages", "op9_": "embeddings", "op13_": "embeddings"}.get(name[: name.index("_") + 1], "documents")
    rows = out.collect()
    key = wanted[0]
    if key == "anchor_id":
        assert rows and all(r.anchor_id % 100 == 0 for r in rows)
    else:
        assert {r[key] for r in rows} == {r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect()}
    if name not in queries.ORACLES:
        return
    db = duckdb.connect()
    db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    cursor = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(out.columns)
    assert Counter(tuple(r[c] for c in columns) for r in rows) == Counter(cursor.fetchall())


def test_stages_keep_columns_and_apply_their_decisions(spark, docs, sf, tmp_path):
    kept, by_name = docs, dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["toxicity", "quality rules", "near duplicates", "packing"]
    for name in list(by_name)[:-1]:
        before = kept
        out = by_name[name](spark, before, sf)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        ids = Counter(r[0] for r in kept.select("doc_id").collect())
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            model = toxicity.learn(spark, before, labels, train=lambda c: F.crc32(c.cast("string")) % 5 != 0)
            want = toxicity.score(before, model).where("predicted = 0")
        elif name == "quality rules":
            want = quality.apply_rules(spark, before).where("kept")
        else:
            found = simhash.near_duplicates(spark, before, shingle=corpus_pipeline.SHINGLE, max_bits=corpus_pipeline.NEAR_BITS, check=corpus_pipeline.CHECK)
            want = found.groupBy("label").agg(F.min("doc_id").alias("doc_id"))
        assert ids == Counter(r[0] for r in want.select("doc_id").collect())
    packed = by_name["packing"](spark, kept, sf)
    assert {r[0] for r in packed.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}


def test_near_copies_go_and_clean_documents_stay(spark, sf):
    own = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) between 800 and 4000 and lang = 'en'").orderBy("doc_id").limit(40).collect()]
    rows, copies = [], []
    for k, text in enumerate(dict.fromkeys(own)):
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        rows += [(k, text), (1000 + k, text), (2000 + k, " ".join(words)), (3000 + k, "".join(c.upper() if c.isascii() else c for c in text))]
        copies += [1000 + k, 2000 + k, 3000 + k]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(spark, docs, shingle=corpus_pipeline.SHINGLE, max_bits=corpus_pipeline.NEAR_BITS, check=corpus_pipeline.CHECK).collect()}
    assert sorted(kept & set(copies)) == []
    assert len(kept) >= 0.9 * (len(rows) // 4)


def test_near_duplicates_share_the_stated_part_of_their_shingles(spark, sf):
    """Nearly all copies above 0.8 go (the index finds most, not all), and no document goes without such a pair."""
    rng = random.Random(6)
    rows, copies, others = [], [], []
    for k in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(300)]
        # 5 of 300 words apart are an overlap of 271 / 321 = 0.84, 9 of 251 / 341 = 0.74.
        for j, (apart, kind) in enumerate(((5, copies), (9, others))):
            text = words.copy()
            for at in range(apart):
                text[20 + 28 * at] = f"other{apart}-{at}"
            rows.append((1000 * (j + 1) + k, " ".join(text)))
            kind.append(rows[-1][0])
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()}
    assert kept >= set(range(60))
    assert len(kept & set(copies)) <= 3
    assert kept >= set(others)


def test_run_on_the_small_tables(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0 < len({r.doc_id for r in rows}) < documents
    whole = Counter()
    for r in rows:
        whole[r.doc_id] += r.length
    assert all(whole[r.doc_id] == r.doc_tokens for r in rows)


@pytest.mark.parametrize("stage", range(3))
def test_stages_of_an_empty_table(spark, none, sf, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, none, sf).count() == 0
    assert packing.pack_documents(none, queries.public_tokenizers.path("word_bpe_49k.json")).count() == 0
