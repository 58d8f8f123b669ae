"""The pipeline's first three stages against plain versions of their rules, text by text."""

from __future__ import annotations

import math
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from test_near_duplicates import edited, plain_bag, plain_fingerprint, reach
from test_text_models import PlainKneserNey, plain_base, plain_features

from tabularium.llm import quality, toxicity


def all_features(text, lexicon):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = max(1, len(words))
    shouted = sum(sum(c.isupper() for c in w) >= 2 and not any(c.islower() for c in w) for w in words)
    stretched = sum(any(a == b == c and ord(a) > 64 for a, b, c in zip(w, w[1:], w[2:])) for w in map(str.lower, words))
    obfuscated = sum(bool(re.search(r"[^\W\d_][0-9@$!*]+[^\W\d_]", w)) for w in words)
    punctuation = sum(not (c.isalpha() or c.isdigit() or c in " \t\n\f\r") for c in text)
    more = {"shouted_words": shouted / n, "punctuation": punctuation / n, "obfuscated": obfuscated / n, "stretched": stretched / n}
    found = plain_features(text, lexicon) | more
    return [found[c] for c in toxicity.FEATURES]


@pytest.fixture(scope="module")
def small(spark, sf, tmp_path_factory):
    """Texts of the driver's, every third with insults and a label that says so, near copies of the first ones, and odd rows."""
    own = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet").where("length(text) between 300 and 900").orderBy("doc_id").limit(240).collect()
    rows, marks = [], []
    for k, r in enumerate(own):
        insult = " you are a worthless fool, you stupid idiot!" * 2 if k % 3 == 0 else ""
        rows.append((r.doc_id, r.text + insult, r.lang, r.source, 0))
        marks.append((r.doc_id, 1, int(k % 3 == 0)))
    for k, r in enumerate(own[1:40:3]):
        words = r.text.split(" ")
        rows.append((50_000 + k, edited(words, [len(words) // 2]), r.lang, r.source, 0))
    rows += [(60_000, None, "en", "s", 0), (60_001, "", None, "s", 0), (None, own[1].text, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    at = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return docs, at


def test_toxicity_stage(spark, small, monkeypatch):
    docs, at = small
    held = {}
    learn = toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda *a, **k: held.setdefault("model", learn(*a, **k)))
    kept = corpus_pipeline.drop_toxic(spark, docs, at).collect()
    model = held["model"]
    xs, ys = zip(*model.steps, strict=True)
    want = Counter()
    for r in docs.collect():
        raw = model.trees.predictProbability(Vectors.dense(all_features(r.text or "", model.lexicon)))[1]
        if 0.999 * np.interp(raw, xs, ys) + 0.001 * raw < 0.5:
            want[tuple(r)] += 1
    assert Counter(map(tuple, kept)) == want
    assert len([r for r in kept if r.text and "you stupid idiot" in r.text]) <= 4 and len(kept) > 150


def test_quality_stage(spark, small):
    docs, at = small
    rows = docs.collect()
    kept = Counter(map(tuple, corpus_pipeline.keep_quality(spark, docs, at).collect()))
    model = PlainKneserNey([r.text for r in rows])
    score = {t: model.log_perplexity(t) for t in {r.text for r in rows}}
    chars = {t: sum(len(w) + 1 for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in score}
    good = [r for r in rows if not plain_base(r.text)[-1]]

    def band(some):
        q1, q2, q3 = (sorted(some)[max(0, math.ceil(p * len(some)) - 1)] for p in (0.25, 0.5, 0.75))
        reach_ = quality.BAND * max(q3 - q1, 0.01)
        return q1 - reach_, q2, q3 + reach_

    different = lambda lang=None: [score[t] for t in {r.text for r in good if lang is None or r.lang == lang}]
    sure = 0
    for r in good:
        own = different(r.lang) if r.lang else []
        lower, middle, upper = band(own if len(own) >= quality.LEAST_TEXTS else different())
        wider = 1 + math.sqrt(quality.SHORT_CHARS / max(1, chars[r.text]))
        lower, upper = middle - (middle - lower) * wider, middle + (upper - middle) * wider
        if min(abs(score[r.text] - lower), abs(score[r.text] - upper)) > 2e-3:  # scores are held in single precision
            sure += 1
            assert (kept[tuple(r)] > 0) == (lower <= score[r.text] <= upper)
    assert sure > 0.9 * len(good) and sum(kept.values()) > 0.8 * len(good)
    assert not [r for r in rows if plain_base(r.text)[-1] and kept[tuple(r)]]


def test_near_duplicate_stage(spark, small):
    docs, at = small
    rows = docs.collect()
    bits = np.array([plain_fingerprint(r.text, corpus_pipeline.SHINGLE) for r in rows], dtype=np.uint64)
    bags = [plain_bag(r.text) for r in rows]
    share = corpus_pipeline.CHECK[1]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            near = np.bitwise_count(bits[a] ^ bits[b]) <= corpus_pipeline.NEAR_BITS
            sets = len(bags[a].keys() & bags[b].keys()) >= share * len(bags[a].keys() | bags[b].keys())
            alike = sets or (bags[a] & bags[b]).total() >= share * (bags[a] | bags[b]).total()
            if bags[a] == bags[b] or near and alike:
                pairs.append((a, b))
    label = reach(len(rows), pairs)
    first: dict = {}
    for r, k in zip(rows, label, strict=True):
        if k not in first or (r.doc_id is None, r.doc_id or 0) < (first[k].doc_id is None, first[k].doc_id or 0):
            first[k] = r
    got = corpus_pipeline.drop_near_duplicates(spark, docs, at).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, first.values()))
    assert len(got) < len(rows) - 10


def test_scratch_tables_go(spark, small):
    from tabularium.llm.common import Scratch

    folder = Scratch(spark, "gone")
    folder.write(spark.range(3), "a")
    jvm = spark._jvm.org.apache.hadoop.fs.Path(folder.root)
    files = jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(jvm)
    made = list(Scratch.made)
    Scratch.made[:] = [folder]
    Scratch.clear()
    Scratch.made[:] = [m for m in made if m is not folder]
    assert not files.exists(jvm)
    assert spark.range(1).select(F.lit(1)).first()[0] == 1
