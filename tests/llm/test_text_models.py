"""Quality rules, language identification, toxicity and licence scans."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabularium.llm import language_id, license_scan, quality, toxicity
from tabularium.llm.common import split_words


# --- quality rules ---


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        len(words) < 20 or 100 * len(repeated) > 30 * len(words),
    )


class PlainKneserNey:
    """Interpolated modified Kneser-Ney over characters, straight from its recursion."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            top.update(self.grams(t))
        self.counts = {quality.ORDER: top}
        for k in range(quality.ORDER - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.cuts = {}
        for k, counts in self.counts.items():
            of = Counter(counts.values())
            n1, n2, n3, n4 = (max(1, of[i]) for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
            self.cuts[k] = [min(max(d, 0.05), i - 0.05) for i, d in zip((1, 2, 3), raw)]
        self.after = {k: defaultdict(list) for k in self.counts}
        for k, counts in self.counts.items():
            for g, n in counts.items():
                self.after[k][g[:-1]].append(n)

    @staticmethod
    def grams(text):
        framed = " " * (quality.ORDER - 1) + "".join(w + " " for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        return [framed[i : i + quality.ORDER] for i in range(len(framed) - quality.ORDER + 1)]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.counts[1]) + 1)
        seen = self.after[k].get(gram[:-1])
        if not seen:
            return self.p(gram[1:])
        n, cut = self.counts[k][gram], lambda n: self.cuts[k][min(n, 3) - 1] if n else 0
        return (n - cut(n) + sum(map(cut, seen)) * self.p(gram[1:])) / sum(seen)

    def log_perplexity(self, text):
        logs = [math.log(self.p(g)) for g in self.grams(text)]
        return -sum(logs) / max(1, len(logs))


def test_quality_rules(spark, docs, texts):
    out = quality.apply_rules(spark, docs).collect()
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *(r[c] for c in base)) for r in out) == Counter((i, *plain_base(t)) for i, t in texts)
    model = PlainKneserNey([t for _, t in texts])
    unique = {i: t for i, t in texts if i is not None}
    for r in out:
        if r.doc_id is not None and r.n_words < 2000:
            assert r.log_perplexity == pytest.approx(model.log_perplexity(unique[r.doc_id]), abs=1e-4)
        assert r.kept == (not r.base_failed and r.lower <= r.log_perplexity <= r.upper)
    good = [r for r in out if not r.base_failed]
    assert sum(r.kept for r in good) > 0.9 * len(good)


def test_unlikely_and_too_likely_texts_are_rejected(spark, docs):
    rng = np.random.default_rng(4)
    noise = " ".join("".join(chr(c) for c in rng.integers(33, 127, 7)) for _ in range(300))
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(7001, noise, "en")], "doc_id long, text string, lang string"))
    verdict = {r.doc_id: r.kept for r in quality.apply_rules(spark, rows).collect()}
    assert verdict[7001] is False
    # 40,000 times the same word fails the base rules.
    assert verdict[9008] is False


def test_the_order_of_words_counts(spark, sf):
    """English texts with their words shuffled are rejected mostly, the texts themselves are kept."""
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.where("length(text) > 1500 and lang = 'en'").orderBy("doc_id").limit(60).collect()
    rng = np.random.default_rng(1)
    rows = [(10**6 + r.doc_id, " ".join(rng.permutation(np.array(r.text.split(), dtype=object)).tolist()), r.lang) for r in clean]
    out = {r.doc_id: r for r in quality.apply_rules(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema))).collect()}
    higher = [out[10**6 + r.doc_id].log_perplexity > out[r.doc_id].log_perplexity for r in clean if not out[r.doc_id].base_failed]
    assert sum(higher) > 0.9 * len(higher)
    good = [r.doc_id for r in clean if out[r.doc_id].kept]
    assert len(good) > 0.9 * sum(not out[r.doc_id].base_failed for r in clean)
    kept = sum(out[10**6 + i].kept for i in good)
    print(f"{kept} of {len(good)} shuffled texts kept")
    assert kept < 0.5 * len(good)


def test_shards_hold_one_sorted_model(spark, docs, monkeypatch):
    whole = {r.doc_id: r.log_perplexity for r in quality.apply_rules(spark, docs).collect()}
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 500)
    cut = {r.doc_id: r.log_perplexity for r in quality.apply_rules(spark, docs).collect()}
    assert whole == pytest.approx(cut, abs=1e-9)


def test_texts_wait_for_a_model_that_does_not_fit(spark, docs):
    """A model larger than what is kept in memory gives the same result, and its shards are read once for all texts of a task."""
    model = quality.fit(spark, docs)
    texts = pa.array([t or "" for (t,) in docs.select("text").collect()])
    parts = [texts.slice(0, 60), texts.slice(60)]
    waiting = quality.Waiting()
    for part in parts:
        waiting.add(part)
    ready = list(waiting.each(model))
    for part, (again, logs_of) in zip(parts, ready, strict=True):
        assert again.equals(part.cast(pa.string()))
        want = quality.log_perplexity(split_words(part), lambda found: quality.gram_logs(found.examples, model))
        got = quality.log_perplexity(split_words(again), logs_of)
        assert got[0] == pytest.approx(want[0]) and (got[1] == want[1]).all()
    some = docs.select("doc_id", "text")
    small, large = (quality.statistics(some, quality.Model(model.path, model.unseen, n), [F.col("doc_id")]) for n in (1, 10**9))
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))


def test_quality_of_empty_tables_and_empty_texts(spark, none):
    assert quality.apply_rules(spark, none).count() == 0
    rows = spark.createDataFrame([(1, None, None), (2, "", "en")], "doc_id long, text string, lang string")
    assert [r.kept for r in quality.apply_rules(spark, rows).collect()] == [False, False]


# --- language identification ---


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.learn(spark, docs, ~held)
    out = language_id.predict(docs, model).join(docs.select("doc_id", "lang", held.alias("held")), "doc_id").where("held and lang is not null").collect()
    assert len(out) > 100
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(spark, docs, texts, none):
    model = language_id.learn(spark, docs, F.lit(True))
    out = language_id.predict(docs, model).collect()
    assert len(out) == len(texts)
    undetermined = {i for i, t in texts if t is None or not any(c.isalpha() for c in t)}
    assert {r.doc_id for r in out if r.lang_pred == "und"} == undetermined
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    assert language_id.learn(spark, none, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


def test_scores_are_counts_times_weights(spark, sf, docs, texts):
    """What predicts, sums over distinct words, equals each text's own counts times the weights, and the query's rows follow from it."""
    own = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.learn(spark, own, ~held)
    some = pa.array([t or "" for _, t in texts], pa.string())
    plain = language_id.counts(some).astype(np.float64) @ model.weights + model.bias
    assert np.abs(language_id.linear_scores(some, model) - plain).max() < 1e-3
    number, score = language_id.decide(plain, model)
    clear = {}
    for (i, t), k, p, z in zip(texts, number, score, plain):
        if i is not None and t and any(c.isalpha() for c in t) and np.sort(np.abs(z[len(model.families) :])).min(initial=1) > 1e-2:
            clear.setdefault(i, (model.languages[k], p))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect() if r.doc_id in clear}
    assert len(got) > 100
    assert all(got[i].lang_pred == lang and got[i].score == pytest.approx(p, abs=0.02) for i, (lang, p) in clear.items())


def test_families_come_first_and_pairs_decide_within():
    rng = np.random.default_rng(0)
    centres = {"en": 0, "de": 1, "nl": 2, "fr": 10, "es": 11, "fi": 20}
    x, y = [], []
    for lang, k in centres.items():
        for _ in range(40):
            row = rng.random(language_id.BUCKETS) * 0.01
            row[k] += 1
            row[100 + k // 10] += 1
            x.append(row / row.sum())
            y.append(lang)
    model = language_id.fit(np.array(x, dtype=np.float32), y)
    assert model.families == ["germanic", "romance", "uralic"] and len(model.pairs) == 3 + 1
    got, _ = language_id.decide(np.array(x) @ model.weights + model.bias, model)
    assert [model.languages[k] for k in got] == y


# --- toxicity ---


def auc(pairs):
    ranked = sorted(pairs)
    ranks, k = {}, 0
    while k < len(ranked):
        j = k
        while j < len(ranked) and ranked[j][0] == ranked[k][0]:
            j += 1
        ranks[ranked[k][0]] = (k + j + 1) / 2
        k = j
    toxic = [s for s, t in pairs if t]
    return (sum(ranks[s] for s in toxic) - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * (len(pairs) - len(toxic)))


def test_toxicity_of_held_out_documents(spark, sf):
    at = f"{sf.rsplit('/', 1)[0]}/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    held = lambda c: F.crc32(c.cast("string")) % 5 == 0
    model = toxicity.learn(spark, docs, labels, train=lambda c: ~held(c))
    out = toxicity.score(docs, model).join(labels, "doc_id").where(held(F.col("doc_id"))).collect()
    pairs = [(r.score, r.toxic) for r in out]
    assert len(pairs) > 300 and auc(pairs) > 0.95
    clean = [r.predicted for r in out if not r.toxic]
    assert sum(clean) <= 0.02 * len(clean)
    brier = sum((s - t) ** 2 for s, t in pairs) / len(pairs)
    print(f"held-out Brier score {brier:.4f}")
    assert brier < 0.03


def test_parts_of_the_labelled_rows_share_no_row(spark, sf, monkeypatch):
    at = f"{sf.rsplit('/', 1)[0]}/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    seen = {}

    def noting(name, f):
        def call(rows, *more):
            seen[name] = {r.id for r in rows.select("id").collect()}
            return f(rows, *more)

        return call

    monkeypatch.setattr(toxicity, "learn_lexicon", noting("lexicon", toxicity.learn_lexicon))
    monkeypatch.setattr(toxicity, "fit_trees", noting("trees", toxicity.fit_trees))
    monkeypatch.setattr(toxicity, "fit_curve", noting("curve", toxicity.fit_curve))
    model = toxicity.learn(spark, docs, labels, train=lambda c: F.crc32(c.cast("string")) % 5 != 0)
    assert all(seen.values()) and sum(map(len, seen.values())) == len(set.union(*seen.values()))
    raw = spark.createDataFrame([(x / 50,) for x in range(51)], "raw double")
    xs, ys = zip(*model.steps, strict=True)
    for r in raw.select("raw", toxicity._calibrated(F.col("raw"), model.steps).alias("p")).collect():
        assert r.p == pytest.approx(0.999 * np.interp(r.raw, xs, ys) + 0.001 * r.raw, abs=1e-9)


def test_toxicity_of_odd_rows(spark, docs, texts, none):
    labels = docs.where("doc_id is not null").select("doc_id", F.when(F.col("text").contains("the"), 1).otherwise(0).alias("toxic"), F.lit("x").alias("text"))
    labels = labels.unionByName(spark.createDataFrame([(None, 1, "x"), (1, None, "x"), (10**9, 1, "x")], "doc_id long, toxic int, text string"))
    model = toxicity.learn(spark, docs, labels)
    out = toxicity.score(docs, model).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in texts)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert toxicity.score(none, model).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0")):
        base = toxicity.learn(spark, docs, few)
        assert {r.score for r in toxicity.score(docs, base).collect()} == {0.0}


def test_toxicity_features():
    lexicon = {"fool": 2.0, "stup*": 1.5}
    rows = ["You are a F00L and st.u.p.i.d!!", "a quiet day", "", "fool " * 10, "far fool " + "word " * 20 + "you"]
    x = dict(zip(toxicity.FEATURES, toxicity.text_features(pa.array(rows), lexicon).T))
    assert x["entry_density"].tolist() == pytest.approx([2 / 6, 0, 0, 1, 1 / 23])
    assert x["near_person"].tolist() == pytest.approx([2 / 6, 0, 0, 0, 0])
    assert x["largest_weight"].tolist() == [2, 0, 0, 2, 2]
    assert x["exclamations"].tolist() == pytest.approx([2 / 6, 0, 0, 0, 0])
    assert x["obfuscated"][0] > 0 and x["shouted_words"][0] > 0


def plain_features(text, lexicon):
    """The features of one text, word by word."""
    person, back = set(toxicity.PRONOUNS.split()), str.maketrans(toxicity.LEET_FROM, toxicity.LEET_TO)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    weights, persons = [], []
    for w in words:
        plain = re.sub(r"^[^\w]+|[^\w]+$", "", w.lower().replace("_", " ")).strip()
        clear = "".join(c for c in w.lower().translate(back) if c.isalpha()) if any(c.isalpha() for c in w) else plain
        keys = ([clear] if len(clear) > 1 else []) + [clear[:k] + "*" for k in toxicity.STEMS if len(clear) >= k]
        weights.append(max([0.0, *(lexicon.get(k, 0.0) for k in keys)]))
        persons.append(plain in person)
    n, hits = max(1, len(words)), [x > 0 for x in weights]
    near = sum(h and any(persons[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, h in enumerate(hits))
    letters = sum(c.isalpha() for c in text)
    capitals = sum(c.isupper() for c in text)
    return {
        "weighted_density": sum(weights) / n, "entry_density": sum(hits) / n, "largest_weight": max([0.0, *weights]), "near_person": near / n, "person_density": sum(persons) / n,
        "capital_share": capitals / max(1, letters), "exclamations": text.count("!") / n, "log_words": math.log1p(len(words)),
    }


def test_features_of_documents_word_by_word(spark, sf):
    rows = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("text is not null and length(text) < 6000").orderBy("doc_id").limit(60).collect()]
    rows += ["YOU st.u.p.i.d f00l, (you) are!! 12 34 x", "tu es un fou", "word " * 30 + "you fool"]
    lexicon = {"fool": 2.0, "stup*": 1.5, "the": 0.5, "ting*": 0.25, "fou": 1.0}
    got = dict(zip(toxicity.FEATURES, toxicity.text_features(pa.array(rows), lexicon).T, strict=True))
    want = [plain_features(t, lexicon) for t in rows]
    for name in want[0]:
        assert got[name].tolist() == pytest.approx([w[name] for w in want], abs=1e-9), name


# --- licences ---


def plain_scan(text):
    units = {u for t in [text or ""] for u in (*t.split("\n"), *re.split(r"\n[ \t\r]*\n", t), t)}
    words = license_scan.normal_words(text or "")
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    best, names = (0, 0.0, None), set()
    for name, template in license_scan.TEMPLATES:
        h, width = set(license_scan.bigrams(template)), len(license_scan.normal_words(template)) - 1
        sets = [set(license_scan.bigrams(u)) for u in units] + [set(pairs[i : i + width]) for i, p in enumerate(pairs) if p in h]
        for g in sets:
            dice = 2 * len(g & h) / (len(g) + len(h)) if g else 0.0
            if dice >= license_scan.THRESHOLD:
                names.add(name)
                best = min(best, (-len(g & h), -dice, name), key=lambda x: (*x[:2], x[2] or ""))
    return best[2], -best[1] if best[2] else 0.0, len(names)


def test_licences(spark, docs, texts):
    own = [(20_000 + k, f"Intro line.\n{t.upper()}\n\nrest of {k}", None) for k, (_, t) in enumerate(license_scan.TEMPLATES)]
    near = [(30_000, "Released under the MIT Licence now.", None), (30_001, "All rights reserved", None), (30_002, "all  RIGHTS-reserved... once", None), (30_003, "MIT License", None)]
    mit = next(t for name, t in license_scan.TEMPLATES if name == "MIT" and len(t) > 500)
    cut = re.sub(r"(conditions:|Software\.) ", r"\1\n\n", mit)
    lines = re.sub(r"((?:\S+ ){9})", r"\1\n", mit)
    prose = "one of the other words that a page can hold before and after its licence " * 9
    inside = [
        (31_000, f"{prose}\n\n{cut}\n\n{prose}", None), (31_001, f"{prose}\n{lines}\n{prose}", None), (31_002, f"{prose} {mit} {prose}", None),
        (31_003, f"{prose} Licensed under CC BY 4.0. {prose}", None), (31_004, f"{prose} {mit[: len(mit) // 2]} {prose}", None),
    ]
    assert cut.count("\n\n") == 2 and lines.count("\n") > 10
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(own + near + inside, "doc_id long, text string, lang string"))
    out = license_scan.scan(rows.withColumn("license", F.lit("clash")), keep=["doc_id"]).collect()
    every = [*texts, *((i, t) for i, t, _ in own + near + inside)]
    assert Counter((r.doc_id, r.license, round(r.dice, 9), r.n_matches) for r in out) == Counter((i, name, round(d, 9), n) for i, name, d, n in ((i, *plain_scan(t)) for i, t in every))
    found = {r.doc_id: r.license for r in out}
    assert [found[20_000 + k] for k in range(len(license_scan.TEMPLATES))] == [name for name, _ in license_scan.TEMPLATES]
    assert [found[31_000 + k] for k in range(5)] == ["MIT", "MIT", "MIT", "CC-BY-4.0", None]


def test_anchors_lose_no_match():
    for t in (0.6, 0.8, 0.9):
        chosen = license_scan.anchors(license_scan.TEMPLATES, t)
        for _, text in license_scan.TEMPLATES:
            grams = license_scan.bigrams(text)
            bare = [g for g in grams if g not in chosen and not set(g.split()) & set(chosen)]
            assert len(bare) < license_scan.size_bounds(len(grams), t)[0]


def test_licence_query_equals_sql(spark, sf):
    documents = duckdb.read_parquet(f"{sf}/documents.parquet")  # noqa: F841
    want = duckdb.sql(license_scan.oracle_sql()).fetchall()
    got = license_scan.scan(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"]).select("doc_id", "license", "dice", "n_matches").collect()
    assert sorted(map(tuple, got)) == sorted(want) if all(r[1] for r in want) else Counter(map(tuple, got)) == Counter(want)


def test_licences_of_an_empty_table(none):
    assert license_scan.scan(none).count() == 0


def test_words_are_split_at_ascii_white_space_only():
    texts = ["a b\tc\nd\x0be\x0cf\rg", "", " x ", "a\u00a0b\u2003c"]
    words = split_words(pa.array(texts))
    assert np.diff(words.starts).tolist() == [7, 0, 1, 1]


def test_a_curve_of_many_corners(spark):
    rng = np.random.default_rng(6)
    xs, ys = np.sort(rng.random(1500)), np.sort(rng.random(1500))
    xs[100] = xs[101]
    steps = list(zip(xs.tolist(), ys.tolist(), strict=True))
    raw = [0.0, 1.0, *xs[[0, 5, 700, 1499]].tolist(), *rng.random(300).tolist()]
    got = spark.createDataFrame([(x,) for x in raw], "raw double").select("raw", toxicity._calibrated(F.col("raw"), steps).alias("p")).collect()
    for r in got:
        assert abs(r.p - (0.999 * np.interp(r.raw, xs, ys) + 0.001 * r.raw)) < 1e-9
    assert len(got) == len(raw)
