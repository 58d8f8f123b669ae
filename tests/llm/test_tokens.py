"""Token counts, merge replay and packing against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabularium.llm import bpe_replay, packing, token_counts

JSON, RANKS, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def test_counts_equal_the_library(docs, texts):
    library = Tokenizer.from_file(JSON)
    want = Counter((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in texts)
    got = token_counts.token_counts(docs, JSON).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert Counter(map(tuple, got)) == want


def test_every_prefix_and_budget():
    library, of = Tokenizer.from_file(JSON), token_counts.tables(JSON)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    words = ["don't", "the", " ", "   ", "\n\n", "'re", "1234567", "éa", "😀😀", "<|endoftext|>", "!!!", "aaaaaaaa", "'s", "\t", "international", "..."]
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(8))
        table = token_counts.PrefixCounts(text, of)
        prefixes = [count(text[:k]) for k in range(len(text) + 1)]
        assert [table.at(k) for k in range(len(text) + 1)] == prefixes
        for budget in (0, 1, 3, 7, len(table)):
            assert table.longest_within(budget) == max(k for k, n in enumerate(prefixes) if n <= budget)
        ends = table.cuts(4)
        assert ends[-1] == len(text) and all(count(text[a:b]) <= 4 for a, b in zip([0, *ends], ends))


def test_plain_texts_split_alike_and_pieces_at_hand_are_kept(monkeypatch):
    of = token_counts.PrefixTables(JSON)
    signs = [c for c in map(chr, range(0x3000)) if token_counts.PLAIN.fullmatch(c)]
    assert len(signs) > 500
    rng = random.Random(5)
    for text in [*(f"a{c}1{c}{c} {c}  {c}'s'{c}" for c in signs), *("".join(rng.choices([*signs, *" \n\t'st19"], k=40)) for _ in range(500))]:
        assert token_counts.PLAIN_PATTERN.findall(text) == of.pattern.findall(text)
    # What the texts at hand have in common with those before isn't made again, even where room is made.
    monkeypatch.setattr(token_counts, "TABLES_KEPT", 3)
    of.fill(["one", " two", " three", " four"])
    held = of.tables[" two"]
    of.make_room(at_hand := [" two", " six"])
    of.fill(at_hand)
    assert set(of.tables) == set(at_hand) and of.tables[" two"] is held


def test_a_single_piece_of_any_length_is_cut():
    table = token_counts.PrefixCounts("q" * 200_000, token_counts.tables(JSON))
    k = table.longest_within(512)
    assert table.at(k) <= 512 < table.at(k + 1)


def test_counts_of_an_empty_table(none):
    assert token_counts.token_counts(none, JSON).count() == 0


def test_replay_equals_the_library(docs, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    out = bpe_replay.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert Counter(map(tuple, out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
    back = bpe_replay.decode(out.select("doc_id", "ids"), RANKS, public_tokenizers.PATTERN)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in texts)


def test_decode_of_bad_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [10**8]), (4, [None]), (5, [-1])], "doc_id long, ids array<int>")
    assert dict(map(tuple, bpe_replay.decode(rows, RANKS, public_tokenizers.PATTERN).collect())) == {1: None, 2: "", 3: None, 4: None, 5: None}


@pytest.mark.parametrize("group", [8192, 50])
def test_packing(docs, texts, group):
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(docs, WORDS, group_pieces=group).collect()
    tokens, places = defaultdict(Counter), defaultdict(list)
    for i, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for a in range(0, len(ids), 4096):
            tokens[i][a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)] += 1
    got = defaultdict(Counter)
    for r in rows:
        got[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert got == tokens
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    if group == 8192:
        total = sum(r.length for r in rows)
        assert len(places) <= total // 4096 + 8 + 1


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 4097, 500)
    sequence, _ = packing.first_fit_decreasing(sizes, 4096)
    room: list[int] = []
    for i in np.argsort(-sizes, kind="stable"):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if k == len(room):
            room.append(4096)
        room[k] -= sizes[i]
        assert sequence[i] == k


def test_packing_an_empty_table(none):
    assert packing.pack_documents(none, WORDS).count() == 0


def test_many_equal_rows_are_dealt_over_all_partitions(spark):
    """20,000 equal documents without ids: no partition packs much more than its share, and each piece is placed once."""
    docs = spark.range(20_000, numPartitions=8).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same few words in all of them").alias("text"))
    rows = packing.pack_documents(docs, WORDS).collect()
    per_task = Counter(r.sequence_id >> 40 for r in rows)
    assert len(rows) == 20_000 and len(per_task) == 8 and max(per_task.values()) < 2 * 20_000 / 8
    filled = Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    places = Counter((r.sequence_id, r.offset) for r in rows)
    assert max(places.values()) == 1 and max(filled.values()) <= 4096
