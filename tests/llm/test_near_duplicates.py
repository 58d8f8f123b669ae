"""SimHash and embedding near-duplicates against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tabularium.llm import components, embedding_dedup, simhash


def reach(n: int, pairs) -> list[int]:
    """The smallest number that each of ``n`` items reaches."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def least_ids(ids, labels):
    """Of each item's component the smallest id, null only if it has none."""
    best: dict = {}
    for i, label in zip(ids, labels):
        if i is not None and (best.get(label) is None or i < best[label]):
            best[label] = i
    return [best.get(label) for label in labels]


def plain_fingerprint(text: str, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def test_simhash_components(spark, docs, texts):
    fps = np.array([plain_fingerprint(t) for _, t in texts], dtype=np.uint64)
    differ = np.bitwise_count(fps[:, None] ^ fps[None, :])
    labels = reach(len(texts), zip(*np.nonzero(differ <= 2)))
    ids = [i for i, _ in texts]
    want = Counter(zip(ids, fps.tolist(), least_ids(ids, labels)))
    got = simhash.near_duplicates(spark, docs, shingle=3, max_bits=2).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want


@pytest.mark.parametrize(("max_bits", "split_over"), [(2, 10**6), (2, 5), (8, 5), (3, 40)])
def test_gray_index_loses_no_link(spark, max_bits, split_over):
    rng = np.random.default_rng(max_bits)
    seeds = rng.integers(0, 2**63, 30, dtype=np.uint64)
    codes = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(20):
            for b in rng.integers(0, 64, rng.integers(1, 12)).tolist():
                s ^= 1 << b
            codes.add(s)
    codes = np.array(sorted(codes), dtype=np.uint64)
    want = reach(len(codes), zip(*np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= max_bits)))
    frame = spark.createDataFrame([(int(c), int(c)) for c in codes.view(np.int64)], "fp long, node long")
    place = {int(c): k for k, c in enumerate(codes.view(np.int64))}
    edges = [(place[r.a], place[r.b]) for r in simhash.link_classes(spark, frame, max_bits, split_over).collect()]
    assert reach(len(codes), edges) == want
    for a, b in edges:
        assert want[a] == want[b]


def plain_bag(text: str, shingle: int = 5) -> Counter:
    words = (text or "").encode().lower().split()
    return Counter(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else Counter()


def edited(words: list[str], at: list[int]) -> str:
    return " ".join(f"{w}x{k}" if k in at else w for k, w in enumerate(words))


@pytest.mark.parametrize(("split_over", "block"), [(10**6, (2048, 3000)), (5, simhash.BLOCK), (5, (2, 8 << 20))])
def test_links_hold_against_the_shingles(spark, docs, texts, split_over, block):
    rng = np.random.default_rng(3)
    more = []
    for k in range(12):
        words = [f"w{x}" for x in rng.integers(0, 400, 120)]
        more += [(50_000 + 10 * k + j, edited(words, rng.integers(0, 120, j).tolist())) for j in range(8)]
    more += [(60_000, "a b c a b c a b c d e f g"), (60_001, "d e f g a b c a b c a b c"), (60_002, "x y"), (60_003, "X  y")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    every = [*texts, *more]
    fps = np.array([plain_fingerprint(t, 2) for _, t in every], dtype=np.uint64)
    bags = [plain_bag(t) for _, t in every]
    sets = [set(b) for b in bags]
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) or (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total()
    first: dict = {}
    pairs = [(k, first.setdefault(frozenset(held.items()), k)) for k, held in enumerate(bags)]
    near = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps) <= 10, 1))
    pairs += [(a, b) for a, b in zip(*near) if alike(a, b)]
    ids = [i for i, _ in every]
    want = Counter(zip(ids, least_ids(ids, reach(len(every), pairs))))
    found = simhash.near_duplicates(spark, rows, shingle=2, max_bits=10, check=(5, 0.8), split_over=split_over, block=block)
    assert Counter(map(tuple, found.select("doc_id", "component_id").collect())) == want


def test_comparisons_grow_with_the_members_of_a_component(monkeypatch):
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    sets, n = simhash.HeldBags(), 400
    for k in range(n):
        sets.add(np.sort(np.append(base, np.uint64(2**63 + k))).tobytes())
    seen = []
    monkeypatch.setattr(simhash.CommonBits, "of", staticmethod(lambda bags: None))
    monkeypatch.setattr(simhash.HeldBags, "get", lambda self, i, f=simhash.HeldBags.get: seen.append(i) or f(self, i))
    label = simhash.exact_links(np.zeros(n, dtype=np.uint64), np.arange(n), sets, 8, 0.8)
    assert set(label.tolist()) == {0}
    assert len(seen) <= 2 * n


@pytest.mark.parametrize("block", [(8, 8 << 20), (2048, 4000)])
def test_blocks_of_a_large_component_lose_no_link(spark, block):
    """One candidate component of 90 texts: chains of edits, far texts that hang on by a few, and one large group of near copies."""
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 900, 150)]
    texts = [edited(base, [k]) for k in range(40)]
    for k in range(50):
        texts.append(edited(base, rng.integers(0, 150, 2 + k // 3).tolist()))
    bags = [plain_bag(t) for t in texts]
    rows, digests = [], []
    for t in texts:
        digest, held = simhash.shingle_bag(simhash.words_of(t), 5)
        digests.append(int(np.uint64(digest).view(np.int64)))
        rows.append((1, 0, digests[-1], len(held), bytearray(held)))
    frame = spark.createDataFrame([*rows, rows[0]], "candidate long, fp long, check long, size long, held binary")
    blocks = max(-(-len(rows) // block[0]), -(-sum(r[3] for r in rows) // block[1]))
    large = spark.createDataFrame([(1, blocks)], "candidate long, blocks long")
    found = simhash._labels_by_blocks(spark, simhash.Scratch(spark, "blocks"), frame, large, 10, 0.8, block)
    label = dict(map(tuple, found.collect()))
    sets = [set(b) for b in bags]
    want = reach(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    got = [label.get(d, d) for d in digests]
    assert [got.index(x) for x in got] == [want.index(x) for x in want]
    assert 2 < len(set(want)) < 60


def test_texts_that_share_enough_meet_in_a_band():
    """Pairs at 0.8 of different shingles, and pairs at 0.8 with repeats that have few different shingles in common."""
    rng = np.random.default_rng(12)
    meet = 0
    for k in range(200):
        common = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a, b = (np.sort(np.concatenate([common, rng.integers(0, 2**63, 10, dtype=np.uint64)])) for _ in range(2))
        if k % 2:
            many = np.repeat(common[:4], 20)
            a, b = (np.sort(np.concatenate([many, rng.integers(0, 2**63, 10, dtype=np.uint64)])) for _ in range(2))
        meet += bool(set(simhash.bands(a.tobytes())) & set(simhash.bands(b.tobytes())))
    assert meet >= 198
    assert len(simhash.bands(b"")) == 0


def test_common_shingles_as_bits(monkeypatch):
    """Held as bits or compared one by one, shingles with their repeats link the same texts."""
    rng = np.random.default_rng(8)
    bags, codes, digests = simhash.HeldBags(), [], []
    for _ in range(150):
        words = [f"w{x}" for x in rng.integers(0, 6, 60)] + [f"v{x}" for x in range(80)]
        for at in rng.integers(0, 140, rng.integers(0, 6)):
            words[at] = f"e{rng.integers(0, 9)}"
        words = " ".join(words).encode().split()
        digest, held = simhash.shingle_bag(words, 2)
        bags.add(held)
        digests.append(digest)
        codes.append(simhash.fingerprint(words, 2))
    given = np.array(codes, dtype=np.uint64), np.array(digests, dtype=np.uint64).view(np.int64), bags, 12, 0.8
    assert simhash.CommonBits.of(bags) is not None
    fast = simhash.exact_links(*given)
    monkeypatch.setattr(simhash.CommonBits, "of", staticmethod(lambda bags: None))
    assert (fast == simhash.exact_links(*given)).all()
    assert 1 < len(set(fast.tolist())) < 150


def test_keep_one_keeps_one_of_each_group(spark, docs, none):
    out = simhash.keep_one(spark, docs, shingle=3, max_bits=2)
    assert out.columns == docs.columns
    found = simhash.near_duplicates(spark, docs, shingle=3, max_bits=2)
    groups = found.select("label").distinct().count()
    assert out.count() == groups
    least = Counter(r[0] for r in found.groupBy("label").agg({"doc_id": "min"}).select("min(doc_id)").collect())
    assert Counter(r[0] for r in out.select("doc_id").collect()) == least
    assert simhash.keep_one(spark, none).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "cycle", "random", "odd"])
def test_components(spark, shape):
    rng = np.random.default_rng(5)
    n = 300
    name = rng.permutation(n)
    pairs = {
        "path": [(i, i + 1) for i in range(n - 1)],
        "star": [(0, i) for i in range(1, n)],
        "cycle": [(i, (i + 1) % n) for i in range(n)],
        "random": rng.integers(0, n, (200, 2)).tolist(),
        "odd": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[shape]
    edges = [(int(name[a]), int(name[b])) for a, b in pairs]
    rows = spark.createDataFrame([*edges, (None, 5), (7, None)], "a long, b long")
    want = reach(n, edges)
    used = {x for e in edges if e[0] != e[1] for x in e}
    assert dict(map(tuple, components.components(spark, rows).collect())) == {x: want[x] for x in used}


def test_components_of_no_edges(spark):
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def links(vectors, threshold):
    good = []
    for v in vectors:
        ok = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None)
    pairs = defaultdict(set)
    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                pairs[i].add(j)
                pairs[j].add(i)
    return pairs


@pytest.mark.parametrize("cell_rows", [4096, 7])
def test_embeddings(spark, sf, cell_rows, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "link_classes", lambda s, c, t, f=embedding_dedup.link_classes: f(s, c, t, cell_rows, cell_rows))
    own = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{sf}/embeddings.parquet").limit(150).collect()]
    rng = np.random.default_rng(2)
    base = rng.standard_normal(64)
    near = [(5000 + k, (base + 0.03 * rng.standard_normal(64)).tolist()) for k in range(60)]
    odd = [
        (9000, None), (9001, []), (9002, [0.0] * 64), (9003, [float("nan")] + [1.0] * 63), (9004, [float("inf")] + [1.0] * 63), (9005, [None] + [1.0] * 63),
        (9006, [1.0, 0.0]), (9007, [2.0, 0.0]), (9007, [2.0, 0.0]), (None, [1.0, 0.001]), (9008, [-0.0, 1.0]), (9009, [0.0, 1.0]), (9010, [3.0]), (9011, [-3.0]),
        (9012, [1e-30] * 64), (9013, [1e30] * 64),
    ]
    rows = own + near + odd
    ids = [i for i, _ in rows]
    pairs = links([v for _, v in rows], 0.95)
    labels = reach(len(rows), [(a, b) for a in pairs for b in pairs[a]])
    least = least_ids(ids, labels)
    want = Counter((i, len(pairs[k]), least[k], i is not None and i == least[k]) for k, i in enumerate(ids))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("id", "x", "no", "label", "size", "kept"):
        frame = frame.selectExpr("*", f"'clash' AS {name}")
    got = embedding_dedup.near_duplicates(spark, frame, threshold=0.95)
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("cell_rows", [4096, 50])
def test_vectors_that_share_a_block_only_are_no_candidates(spark, cell_rows):
    where, rng = embedding_dedup.space(64, 0.95), np.random.default_rng(5)
    turned = rng.standard_normal((200, 64))
    # All are equal in the first block, of the same length in the rest; the last ten are also near as a whole.
    turned[:, where.blocks[0]] = turned[0, where.blocks[0]]
    turned[190:] = turned[190] + 0.01 * rng.standard_normal((10, 64))
    rest = np.concatenate([np.arange(64)[b] for b in where.blocks[1:]])
    turned[:, rest] *= 7 / np.linalg.norm(turned[:, rest], axis=1, keepdims=True)
    rows = [(k, 64, x.tolist()) for k, x in enumerate(turned @ where.rotation.T)]
    found = embedding_dedup.candidates(spark, spark.createDataFrame(rows, "no long, dim int, x array<double>"), 0.95, cell_rows).collect()
    reached = {v for e in found for v in (e.a, e.b)}
    assert reached == set(range(190, 200))


def test_embeddings_of_an_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
