"""Fill-in-the-middle, SentencePiece rounds and hard negatives against plain versions and the library itself."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabularium.llm import fill_in_middle, hard_negatives, piece_bpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_cut(key, text):
    """The rule, written out by code points."""
    digits = sha(f"1:{'' if key is None else key}")
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return key, n, "plain", None, None, sha(text), sha(text)
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return key, n, "spm" if spm else "psm", a, b - a, sha(out), sha(text)


def test_cuts_equal_the_rule(docs, texts):
    got = fill_in_middle.transform(docs)
    want = Counter(plain_cut(k, t or "") for k, t in texts)
    assert Counter(tuple(r)[:7] for r in got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert all(sha(r.output) == r.output_sha256 for r in got.select("output", "output_sha256").collect())


def test_cuts_of_odd_texts():
    rng = random.Random(5)
    signs = ["<P>", "<S>", "<M>", "<", "P", "S>", "<P", "é", "😀", "\n", "\r\n", "\x00", "á", "ab ", "​", "\U0010ffff"]
    seen = Counter()
    for k in range(600):
        text = "".join(rng.choice(signs[3:] if k % 3 else signs) for _ in range(rng.choice([0, 1, 2, 5, 40, 127, 128, 129, 700])))
        one = fill_in_middle.cut(text, k)
        seen[one.form] += 1
        assert (k, one.n, one.form, one.prefix_chars, one.middle_chars, sha(one.output), sha(fill_in_middle.restore(one.output, one.form))) == plain_cut(k, text)
    assert min(seen.values()) > 20 and len(seen) == 3
    assert fill_in_middle.cut("abc", 1, share=0).form == "plain"
    assert {fill_in_middle.cut("abc", k, share=100, spm_share=100).form for k in range(20)} == {"spm"}


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(docs, texts, library):
    want = Counter()
    for k, t in texts:
        ids = library.encode(t or "")
        want[k, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += 1
    got = piece_bpe.encode(docs, MODEL)
    assert Counter(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
    back = piece_bpe.decode(got.select("doc_id", "ids"), MODEL)
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, got.select("doc_id", "decoded").collect()))


def test_pieces_of_odd_texts_equal_the_library(library):
    of, rng = piece_bpe.model(MODEL), random.Random(7)
    # Runs of blanks of every length before, between and after words: all their pieces have one score, and the leftmost pair is due.
    texts = [a + " " * k + b for k in [*range(40), 63, 64, 65, 500, 20_000] for a in ("", "a") for b in ("", "x", "the", "=", "é")]
    texts += ["", "▁x ▁▁ y", "\x00a", "<s>x</s> <0x0A> <unk>", "x" * 30_000, "ab" * 5000, "日本語のテキスト" * 200, "".join(rng.choice("abcdefgh") for _ in range(30_000))]
    parts = ["a", "b", " ", "  ", "the", "ing", "\n", "é", "日", "😀", "▁", "=", "==", "-", "\t", "aa", "       ", "()", "//", "0", "1", "　", "﻿"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    ids, starts = piece_bpe.encode_texts(texts, of)
    decoded = piece_bpe.decode_ids(ids, starts, of)
    for k, want in enumerate(library.encode(texts, num_threads=1)):
        assert ids[starts[k] : starts[k + 1]].tolist() == want, texts[k][:60]
        assert decoded[k].decode() == library.decode(want)


def test_any_ids_decode_as_in_the_library(spark, library):
    rng = random.Random(9)
    rows = [(k, [rng.choice([rng.randrange(300), rng.randrange(259, 32_000), 28705, 259]) for _ in range(rng.randint(0, 8))]) for k in range(400)]
    odd = [(1000, None), (1001, [32_000]), (1002, [-1]), (1003, [5, None])]
    got = dict(map(tuple, piece_bpe.decode(spark.createDataFrame(rows + odd, "doc_id long, ids array<int>"), MODEL).collect()))
    assert all(got[k] == library.decode(ids) for k, ids in rows)
    assert all(got[k] is None for k, _ in odd)


def test_merges_that_make_an_earlier_pair_due():
    """Words in which a merge makes a pair of the same or a better rank, one merge after another."""

    def one_by_one(symbols, of):
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, made = of.of_pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
            at = int(rank.argmin())
            if rank[at] == piece_bpe.NEVER:
                break
            symbols[at : at + 2] = [int(made[at])]
        return symbols

    class Toy(piece_bpe.Model):
        def __init__(self, pairs):
            keys = sorted((a << 32 | b, m, r) for (a, b), (m, r) in pairs.items())
            self.pairs, self.made, self.rank = (np.array(c, dtype=np.int64) for c in zip(*keys, strict=True))

    rng = random.Random(11)
    for _ in range(60):
        # Any ranks, ties among them; what is made has a number of its own, or an existing one.
        toy = Toy({(rng.randrange(6), rng.randrange(6)): (rng.randrange(8), rng.randrange(5)) for _ in range(14)})
        words = [[rng.randrange(4) for _ in range(rng.randint(1, 14))] for _ in range(40)]
        flat, owner = np.array(sum(words, [])), np.repeat(np.arange(len(words)), list(map(len, words)))
        got, word = piece_bpe.rounds(flat.copy(), owner, toy)
        for k, w in enumerate(words):
            assert got[word == k].tolist() == one_by_one(w, toy)


def test_other_models_raise(tmp_path):
    for raw in (b"", b"\x0a\x05\x0a\x01a\x18\x01"):
        at = tmp_path / f"{len(raw)}.model"
        at.write_bytes(raw)
        with pytest.raises((ValueError, KeyError)):
            piece_bpe.Model(str(at))


def plain_negatives(rows, positives=5, negatives=5):
    """All pairs in Python's integers; a repeated row is another row."""
    good = [(i, lab, [math.floor(256 * v) for v in x]) for i, lab, x in rows if lab is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    last = lambda i: (i is None, i)
    out = Counter()
    for k, (i, lab, x) in enumerate(good):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, other == lab) for m, (j, other, y) in enumerate(good) if m != k and len(x) == len(y)]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for top, j, _ in [s for s in scored if s[2]][:positives]:
            below = [s for s in scored if not s[2] and 80 * top <= 100 * s[0] <= 100 * top][:negatives]
            for rank, (score, m, _) in enumerate(below, 1):
                out[i, j, rank, m, top, score] += 1
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, block string, pos int")


def test_negatives_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 12))
    rows = []
    for i in range(700):
        x = centre[rng.integers(6)] + 0.4 * rng.standard_normal(12)
        rows.append((i, int(rng.integers(4)), np.round(x, 2 if i % 2 else 6).tolist()))
    rows += [(100, 1, rows[100][2]), rows[200], rows[200], (None, 2, rows[300][2]), (None, None, None), (900, None, [1.0]), (1000, 1, None), (1100, 1, [float("nan")] * 12)]
    rows += [(1200, 1, [None] * 12), (1300, 1, [float("inf")] * 12), (1400, 3, []), (1401, 3, []), (1402, 2, []), (1500, 0, [1.0, 2.0]), (1501, 0, [1.0, 2.0]), (1502, 1, [0.9, 2.0])]
    rows += [(2000 + i, i % 2, [0.5] * 12) for i in range(150)]
    got = hard_negatives.mine(spark, vectors_of(spark, rows).repartition(5), is_anchor=lambda c: c % 100 == 0)
    want = plain_negatives(rows)
    assert len(want) > 100
    assert Counter(map(tuple, got.collect())) == want


def test_negatives_in_small_blocks_and_rounds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(10 * i, int(rng.integers(3)), np.round(rng.standard_normal(4) + 1, 1).tolist()) for i in range(300)]
    for name, value in (("BLOCK_BYTES", 640), ("ANCHOR_ROWS", 3), ("TILE", 2), ("HELD_ROWS", 10)):
        monkeypatch.setattr(hard_negatives, name, value)
    got = hard_negatives.mine(spark, vectors_of(spark, rows).repartition(3), is_anchor=lambda c: c % 100 == 0, round_bytes=1500)
    assert Counter(map(tuple, got.collect())) == plain_negatives(rows)


def test_negatives_of_very_large_components(spark):
    """Products beyond the exact range of doubles, where neighbouring integers would be one double."""
    big = float(1 << 22)
    rows = [(i, i % 2, [big, float(i % 5), 1.0]) for i in range(0, 220, 4)]
    got = Counter(map(tuple, hard_negatives.mine(spark, vectors_of(spark, rows), is_anchor=lambda c: c % 100 == 0).collect()))
    rows = [(i, i // 4 % 2, x) for i, _, x in rows]
    mixed = Counter(map(tuple, hard_negatives.mine(spark, vectors_of(spark, rows), is_anchor=lambda c: c % 100 == 0).collect()))
    assert not got and mixed == plain_negatives(rows) and mixed
    huge = [(100, 0, [1e30]), (101, 0, [1e30]), (102, 1, [0.9e30])]
    (row,) = hard_negatives.mine(spark, vectors_of(spark, huge), is_anchor=lambda c: c % 100 == 0).collect()
    assert tuple(row) == (100, 101, 1, 102, 2**63 - 2, 2**63 - 2)


def test_empty_tables(spark, none):
    assert not fill_in_middle.transform(none).collect()
    assert not piece_bpe.encode(none, MODEL).collect()
    assert not hard_negatives.mine(spark, vectors_of(spark, [(1, 1, [1.0])]).where("false"), is_anchor=lambda c: c % 100 == 0).collect()
    assert hard_negatives.mine(spark, vectors_of(spark, [(1, 1, [1.0])]), is_anchor=lambda c: F.lit(True)).count() == 0
