"""SimHash near-duplicate detection with a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles. Texts with equal
fingerprints are one class from the start. Two classes link where their
fingerprints differ in at most ``max_bits`` bits, and documents of one
connected component are near-duplicates.

Candidates: the fingerprint is cut into ``max_bits + 1`` blocks. Fingerprints
within ``max_bits`` bits agree on one block at least, so each is sent once for
each block under that block's value. A value that more than ``split_over``
fingerprints share is keyed anew by blocks of its other bits, by the same
argument, up to ``DEEPEST`` times, so no link is lost. Each time makes
``max_bits + 1`` copies of the fingerprints that need it; what is still large
then are near copies, which the tree below passes quickly.

Within a group the fingerprints are sorted by Gray rank. Windows of
neighbours share most of their bits: those bits (a mask and a pattern) move up
into a node, windows of nodes again into a node above, and what is left below
are the residual bits. A search carries the differing bits found so far down
the tree and drops a whole node once they exceed ``max_bits``; it also drops a
node whose members are all known to be in the query's component already, so a
group of thousands of near copies costs about as many steps as it has members.

With a share to hold links against, the index only proposes. Groups are then
bands of a MinHash of the shingles, those of the different ones and those of all with
their repeats: a text goes to ``BANDS`` groups (more where repeats change a band)
and meets only texts that have its least shingles, so copies and work grow with
the input; a band that more than ``split_over`` texts share is cut by blocks of the
fingerprint as above. Texts that share 0.8 of their shingles meet in one band at least
but for 3 in 10,000 pairs. Documents of one candidate component come together
with the hashes of their shingles, and two of them link if they have that share
of their shingles in common (Jaccard), of the different ones or of all with
their repeats. Documents with the same shingles as often are one class. A class
that hangs together with another already is not compared with it again, so a
component of thousands of near copies takes about as many comparisons as it has members.

No task holds a large component. Beyond two blocks it is dealt to blocks by a hash.
Each block is compared within itself and with the first one, which joins near copies
of whatever number; then only members outside the component's largest
class are left to compare, in blocks, with those of other classes in every block. That is
linear where few are left, and at worst (a component of which nothing links) all pairs
of blocks, each of them a small task.

Results defined for odd input: a null text is read as empty; a text without
words has fingerprint zero and links like any other (held against a
share, it has no shingles and links with its like only); repeated rows give
repeated result rows; a null id gets a fingerprint and its component's
smallest id (null where the component has none). Columns other than id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.llm.common import SLICE_BYTES, Scratch, free_names, mix64, release, text_slices, texts_of
from tabularium.llm.components import components

#: Fixed by the definition of the fingerprint: the seed of XXH64.
SEED = 42
#: Members of a window of the index.
FANOUT = 8
#: A block value with more fingerprints than this is keyed anew by a further block.
SPLIT_OVER = 20_000
#: How often values are keyed anew.
DEEPEST = 2
#: Bands of a MinHash under which candidates meet, and the minima in each.
BANDS, BAND_ROWS = 8, 2
#: Queries that go down the tree together.
QUERIES_AT_ONCE = 128
#: Members of a block of a candidate component and bytes of their hashes; a task compares two blocks at most.
BLOCK = (2048, 8 << 20)
#: Bytes of hashes up to which shingles in common are held as bits.
BITS_FROM = 24 << 20
#: Bytes of those bits.
BITS_HELD = 32 << 20


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    # bytes.lower() changes A-Z only, and bytes.split() splits at the six ASCII white space characters.
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each shingle of a text's words; a text of fewer words is one shingle, an empty one has none."""
    if not words:
        return np.zeros(0, dtype="<u8")
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) > shingle else [words]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(p), SEED) for p in parts), dtype="<u8", count=max(1, len(words) - shingle + 1))


def fingerprint(words: list[bytes], shingle: int) -> int:
    """SimHash of a text's words: a bit is set if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(words, shingle)
    if len(hashes) <= 1:
        return int(hashes.sum())
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def shingle_bag(words: list[bytes], shingle: int) -> tuple[int, bytes]:
    """A digest of a text's shingles and how often each occurs, and their sorted hashes, repeated ones as often."""
    held = np.sort(shingle_hashes(words, shingle)).tobytes()
    return xxhash.xxh3_64_intdigest(held, SEED), held


def occurrence(hashes: np.ndarray) -> np.ndarray:
    """For sorted hashes: how many equal ones come before each."""
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, dtype=np.int64)
    return np.arange(len(hashes)) - np.repeat(first, np.diff([*first, len(hashes)]))


BAND_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _minima(x: np.ndarray) -> np.ndarray:
    least = np.full(len(BAND_FACTORS), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(x), 4096):
        least = np.minimum(least, (x[at : at + 4096, None] * BAND_FACTORS).min(axis=0))
    return least


def bands(held: bytes) -> np.ndarray:
    """The bands of a bag: of its different shingles, and of all with their repeats where those differ; none of an empty one."""
    x = np.frombuffer(held, dtype="<u8")
    if not len(x):
        return np.zeros(0, dtype=np.uint64)
    nth = occurrence(x)
    again = nth > 0
    least = [_minima(x[~again])]
    if again.any():
        least.append(np.minimum(least[0], _minima(mix64(x[again] + nth[again].astype(np.uint64)))))
    keys = []
    for minima in least:
        key = np.arange(BANDS, dtype=np.uint64)
        for column in minima.reshape(BANDS, BAND_ROWS).T:
            key = mix64(key + column)
        keys.append(key)
    return np.unique(np.concatenate(keys))


def fingerprints(rows: DataFrame, keep: list[str], shingle: int = 3, check_shingle: int | None = None) -> DataFrame:
    """``(*keep, fp)`` for every row of ``rows``, by its column ``text``; ``fp`` holds the 64 bits as a signed long.

    With ``check_shingle`` also ``check``, the digest of the bag of those shingles, and its ``bands``.
    """
    made = ["fp", *(["check"] if check_shingle else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out = np.zeros((len(made), part.num_rows), dtype=np.uint64)
            keys: list[np.ndarray] = []
            for i, text in enumerate(texts_of(part).to_pylist()):
                words = words_of(text)
                out[0, i] = fingerprint(words, shingle)
                if check_shingle:
                    out[1, i], held = shingle_bag(words, check_shingle)
                    keys.append(bands(held).view(np.int64))
            columns = [*(part.column(n) for n in keep), *map(pa.array, out.view(np.int64))]
            if check_shingle:
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys))))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made, *(["bands"] if check_shingle else [])])

    longs = [T.StructField(c, T.LongType()) for c in made]
    lists = [T.StructField("bands", T.ArrayType(T.LongType()))] if check_shingle else []
    return rows.select(*keep, "text").mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), *longs, *lists]))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64, copy=True)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Labels:
    """Components of ``n`` items, merged a batch of links at a time; a label is the smallest member's number."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.of[a], self.of[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while (up := self.of[self.of]).tobytes() != self.of.tobytes():
                self.of = up


class GrayIndex:
    """The hierarchical index of one group of fingerprints."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.fanout = fanout
        #: The places of the codes that were given, by Gray rank.
        self.order = order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[order]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        #: From the leaves up: the mask of shared bits and their values, for each node.
        self.masks = [np.full(len(self.codes), full)]
        self.patterns = [self.codes]
        while len(self.codes) > 1 and len(self.masks[-1]) > 1:
            mask, pattern = self.masks[-1], self.patterns[-1]
            starts = np.arange(0, len(mask), fanout)
            first = np.repeat(pattern[starts], np.diff([*starts, len(mask)]))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), starts)
            self.masks.append(shared)
            self.patterns.append(pattern[starts] & shared)
        #: Bits of a node that its parent does not hold.
        self.residual = []
        for level, mask in enumerate(self.masks):
            above = self.masks[level + 1][np.arange(len(mask)) // fanout] if level + 1 < len(self.masks) else np.zeros(1, dtype=np.uint64)
            self.residual.append(mask & ~above)

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level, the label that all members of a node share, or -1."""
        out = [labels]
        for level in range(1, len(self.masks)):
            below = out[-1]
            starts = np.arange(0, len(below), self.fanout)
            low, high = np.minimum.reduceat(below, starts), np.maximum.reduceat(below, starts)
            out.append(np.where(low == high, low, -1))
        return out

    def link(self, max_bits: int, at_once: int = QUERIES_AT_ONCE) -> np.ndarray:
        """Labels of the components at ``max_bits`` differing bits, for ``codes`` in Gray order."""
        n = len(self.codes)
        labels = Labels(n)
        near = np.flatnonzero(np.bitwise_count(self.codes[1:] ^ self.codes[:-1]) <= max_bits)
        labels.link(near, near + 1)
        top = len(self.masks) - 1
        for start in range(0, n, at_once):
            uniform = self._uniform(labels.of)
            query = np.arange(start, min(start + at_once, n))
            node = np.zeros(len(query), dtype=np.int64)
            found = np.zeros(len(query), dtype=np.uint8)
            for level in range(top, -1, -1):
                if level < top:
                    width = len(self.masks[level])
                    node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                    query, found = np.repeat(query, self.fanout), np.repeat(found, self.fanout)
                    # Later members only: a pair is met from its earlier one.
                    keep = (node < width) & ((node + 1) * self.fanout**level > query + 1)
                    node, query, found = node[keep], query[keep], found[keep]
                differ = (self.codes[query] ^ self.patterns[level][node]) & self.residual[level][node]
                found = found + np.bitwise_count(differ)
                keep = (found <= max_bits) & (uniform[level][node] != labels.of[query])
                node, query, found = node[keep], query[keep], found[keep]
            labels.link(query, node)
        return labels.of


def group_links(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of edges that connect what is linked in a group: each member with its component's first."""
    index = GrayIndex(codes)
    label = index.link(max_bits)
    member = np.flatnonzero(label != np.arange(len(label)))
    return index.order[member], index.order[label[member]]


def small_group_links(codes: np.ndarray, group: np.ndarray, max_bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs of many groups of at most ``most`` codes each; members of a group are neighbours."""
    a = []
    for gap in range(1, most):
        hit = np.flatnonzero((group[gap:] == group[:-gap]) & (np.bitwise_count(codes[gap:] ^ codes[:-gap]) <= max_bits))
        a.append(np.stack([hit, hit + gap]))
    both = np.concatenate([np.zeros((2, 0), dtype=np.int64), *a], axis=1)
    return both[0], both[1]


def _links_of_partition(max_bits: int, keys: list[str]):
    """For rows sorted by ``keys``: read group after group, and hold no more than one group and one batch."""
    columns, of_key = [*keys, "node", "fp"], len(keys)

    def solve(held: np.ndarray) -> pa.RecordBatch:
        key, node, codes = held[:of_key], held[-2], held[-1].view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        sizes = np.diff([*starts, len(node)])
        small = np.flatnonzero(np.repeat(sizes <= FANOUT, sizes))
        group = np.repeat(np.arange(len(sizes)), sizes)
        found = [small[np.stack(small_group_links(codes[small], group[small], max_bits, FANOUT))]]
        for i in np.flatnonzero(sizes > FANOUT):
            rows = slice(starts[i], starts[i] + sizes[i])
            found.append(np.stack(group_links(codes[rows], max_bits)) + starts[i])
        a, b = node[np.concatenate(found, axis=1)]
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns]))
            if (held[-1][:of_key, -1] == held[0][:of_key, 0]).all():
                continue
            rows = np.concatenate(held, axis=1)
            whole = np.flatnonzero((rows[:of_key] != rows[:of_key, -1:]).any(axis=0))[-1] + 1
            yield solve(np.ascontiguousarray(rows[:, :whole]))
            release()
            held = [np.ascontiguousarray(rows[:, whole:])]
        if held:
            yield solve(np.concatenate(held, axis=1))

    return run


def free_blocks(mask: int, parts: int) -> list[int]:
    """The bits outside ``mask`` in ``parts`` blocks."""
    bits = [b for b in range(64) if not mask >> b & 1]
    cut = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << bit for bit in bits[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def _keyed(max_bits: int):
    """For rows ``(mask, value, ...)``: one for each block of the other bits, with that block's bits in the mask too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = batch.column("mask").to_numpy(zero_copy_only=False)
            for mask in np.unique(masks).tolist():
                part = batch.filter(pa.array(masks == mask))
                codes = part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                for block in free_blocks(mask % (1 << 64), max_bits + 1):
                    wider = np.full(1, mask % (1 << 64) | block, dtype=np.uint64)
                    key = [np.repeat(wider, len(codes)), codes & wider]
                    yield pa.RecordBatch.from_arrays([*(pa.array(k.view(np.int64)) for k in key), *part.columns[2:]], names=part.schema.names)

    return run


def link_classes(spark: SparkSession, distinct: DataFrame, max_bits: int = 2, split_over: int = SPLIT_OVER) -> DataFrame:
    """``(a, b)``: edges between nodes whose components are those of all links.

    ``distinct`` has the fingerprints ``fp`` and a number ``node`` for each. Where it has ``bands`` too, links are sought
    only among nodes that have one in common, and blocks of the fingerprint cut only those bands that too many share.
    """
    scratch = Scratch(spark, "gray")
    banded = "bands" in distinct.columns
    key = ["mask", "value", *(["band"] if banded else [])]
    band = [F.explode("bands").alias("band")] if banded else []
    level = distinct.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), *band, "node", "fp")
    groups, depth = None, 0
    while True:
        keyed = level if banded and depth == 0 else level.mapInArrow(_keyed(max_bits), level.schema)
        more = F.bit_count(F.bitwise_not("mask")) > max_bits
        large = scratch.write(keyed.where(more).groupBy(*key).count().where(F.col("count") > split_over).select(*key), f"large{depth}")
        last = large.isEmpty() or depth == DEEPEST
        fit = keyed if last else keyed.join(large, key, "left_anti").select(*level.columns)
        groups = fit if groups is None else groups.unionByName(fit)
        if last:
            break
        level = scratch.write(keyed.join(large, key, "left_semi").select(*level.columns), f"level{depth}")
        depth += 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return groups.repartition(parts, *key).sortWithinPartitions(*key, "fp").mapInArrow(_links_of_partition(max_bits, key), "a long, b long")


class HeldBags:
    """Sorted hashes of shingles by number."""

    def __init__(self):
        self.bags: list[bytes] = []
        self.different: list[int] = []
        self.total: list[int] = []
        self.bytes = 0

    def add(self, held: bytes) -> None:
        hashes = np.frombuffer(held, dtype="<u8")
        self.total.append(len(hashes))
        self.different.append(int((hashes[1:] != hashes[:-1]).sum()) + 1 if len(hashes) else 0)
        self.bytes += len(held)
        self.bags.append(held)

    def get(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The different hashes, and how often each occurs."""
        return np.unique(np.frombuffer(self.bags[i], dtype="<u8"), return_counts=True)


def shares(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], share: float) -> bool:
    """Whether two bags have ``share`` of their union in common, as sets or with repeats."""
    both, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if len(both) >= share * (len(a[0]) + len(b[0]) - len(both)) - 1e-9:
        return True
    common = np.minimum(a[1][at_a], b[1][at_b]).sum()
    return bool(common >= share * (a[1].sum() + b[1].sum() - common) - 1e-9)


class CommonBits:
    """Which of the shingles that two or more texts of a component have each text has, as bits: those of the different ones, then those of repeats."""

    @staticmethod
    def of(bags: HeldBags) -> CommonBits | None:
        """None where the hashes or the bits take more than ``BITS_FROM`` or ``BITS_HELD`` bytes."""
        if bags.bytes > BITS_FROM:
            return None
        keys, place = [], []
        for i in range(len(bags.bags)):
            held = np.frombuffer(bags.bags[i], dtype="<u8")
            # The second occurrence of a shingle is an element of its own, and so on: a bag is a set then.
            nth = occurrence(held)
            keys.append(np.where(nth == 0, held & ~np.uint64(1), mix64(held + nth.astype(np.uint64)) | np.uint64(1)))
            place.append(np.full(len(held), i))
        every, column, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = n >= 2
        repeat = (every & np.uint64(1)).astype(bool)
        parts = []
        for own in (shared & ~repeat, shared & repeat):
            number = np.cumsum(own) - 1
            width = -(-int(own.sum()) // 64) * 64
            if len(bags.bags) * width // 8 > BITS_HELD:
                return None
            rows, owner = own[column], np.concatenate(place)
            bits = np.zeros((len(bags.bags), width // 64), dtype=np.uint64)
            cell = number[column[rows]]
            np.bitwise_or.at(bits, (owner[rows], cell // 64), np.uint64(1) << (cell % 64).astype(np.uint64))
            parts.append(bits)
        return CommonBits(*parts)

    def __init__(self, different: np.ndarray, repeats: np.ndarray):
        self.different, self.repeats = different, repeats

    def common(self, k: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many different shingles ``k`` has in common with others, and how many with their repeats."""
        both = [np.bitwise_count(bits[others] & bits[k]).sum(axis=1, dtype=np.int64) for bits in (self.different, self.repeats)]
        return both[0], both[0] + both[1]


def exact_links(codes: np.ndarray, digests: np.ndarray, bags: HeldBags, max_bits: int, share: float, given: np.ndarray | None = None, kind: np.ndarray | None = None) -> np.ndarray:
    """Labels of the components of texts that differ in at most ``max_bits`` bits and share ``share`` of their shingles, or all of them.

    Texts with equal ``given`` are known to hang together. Those of the same ``kind`` are not compared, but for kind 0.
    """
    n = len(codes)
    labels = Labels(n)
    for known in (digests, given):
        if known is not None:
            order = np.argsort(known, kind="stable")
            same = np.flatnonzero(known[order][1:] == known[order][:-1])
            labels.link(order[same], order[same + 1])
    if not labels.of.any():
        return labels.of
    different, total = np.array(bags.different), np.array(bags.total)
    bits = CommonBits.of(bags) if n > 2 else None
    # Bags share so much only if neither is smaller than that part of the other.
    alike = lambda size, k: np.minimum(size[:k], size[k]) >= share * np.maximum(size[:k], size[k]) - 1e-9
    for k in range(1, n):
        may = (np.bitwise_count(codes[:k] ^ codes[k]) <= max_bits) & (labels.of[:k] != labels.of[k]) & (alike(different, k) | alike(total, k))
        if kind is not None and kind[k]:
            may &= kind[:k] != kind[k]
        near, own = np.flatnonzero(may), None
        while bits and len(near):
            # The latest first, some at a time: most are linked with each other already.
            part, near = near[-64:], near[:-64]
            enough = lambda both, size: both >= share * (size[part] + size[k] - both) - 1e-9  # noqa: B023, E731
            sets, repeated = bits.common(k, part)
            hit = part[enough(sets, different) | enough(repeated, total)]
            labels.link(np.full(len(hit), k), hit)
            near = near[labels.of[near] != labels.of[k]]
        while len(near):
            own = bags.get(k) if own is None else own
            j, near = near[-1], near[:-1]
            if shares(own, bags.get(j), share):
                labels.link(np.array([k]), np.array([j]))
                near = near[labels.of[near] != labels.of[k]]
    return labels.of


#: What is known of a text of a candidate component, but for the key of its group.
BAG = ["fp", "check", "kind", "given", "held"]


def _classes_of_partition(max_bits: int, share: float, keys: list[str]):
    """For rows sorted by ``keys``, fp, check and kind: read group after group, and hold no more than one and one batch."""

    def solve(marks: list[tuple[int, int, int, int]], bags: HeldBags) -> pa.RecordBatch:
        codes, digests, kind, given = np.array(marks, dtype=np.int64).T
        label = exact_links(codes.view(np.uint64), digests, bags, max_bits, share, given, kind)
        _, first = np.unique(digests, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(digests[first]), pa.array(digests[label[first]])], names=["check", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, marks, bags = None, [], HeldBags()
        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in keys), strict=True))
            mark = list(zip(*(batch.column(c).to_pylist() for c in BAG[:-1]), strict=True))
            held = batch.column("held")
            for k in range(batch.num_rows):
                if marks and key[k] != now:
                    yield solve(marks, bags)
                    if bags.bytes > SLICE_BYTES:
                        release()
                    marks, bags = [], HeldBags()
                now = key[k]
                if marks and marks[-1] == mark[k]:
                    continue  # the same row of the input once more
                marks.append(mark[k])
                bags.add(held[k].as_py())
        if marks:
            yield solve(marks, bags)

    return run


def _compared(bags: DataFrame, keys: list[str], max_bits: int, share: float) -> DataFrame:
    """``(check, label)``: what each group of texts tells, two blocks of one component at most in a group."""
    parts = int(bags.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = bags.select(*keys, *BAG).repartition(parts, *keys).sortWithinPartitions(*keys, "fp", "check", "kind")
    return rows.mapInArrow(_classes_of_partition(max_bits, share, keys), "check long, label long")


def _blocks(n: str, size: str, block: tuple[int, int]) -> Column:
    """How many blocks so many members with so many bytes make."""
    return F.greatest(F.ceil(F.col(n) / block[0]), F.ceil(F.col(size) / block[1])).cast("long")


def _labels_by_blocks(spark: SparkSession, scratch: Scratch, bags: DataFrame, large: DataFrame, max_bits: int, share: float, block: tuple[int, int]) -> DataFrame:
    """``(check, label)`` for the components of ``large`` (candidate, blocks), which no task holds whole."""
    whole = bags.join(large, "candidate").withColumn("at", F.pmod(F.xxhash64("check"), "blocks"))
    kind = lambda k: F.lit(k).cast("long").alias("kind")
    to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    known = F.col("check").alias("given")
    within = whole.select("candidate", "at", "fp", "check", kind(0), known, "held")
    # The first block goes to all others.
    first = whole.where("at = 0 and blocks > 1").select("candidate", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).alias("at"), "fp", "check", kind(1), known, "held")
    edges = scratch.write(_compared(within.unionByName(first), ["candidate", "at"], max_bits, share).where("check != label"), "edges")

    ends = components(spark, edges, "check", "label").withColumnRenamed("label", "class")
    tags = whole.groupBy("candidate", "check").agg(F.max("size").alias("size"))
    tags = tags.join(ends, tags["check"] == ends["node"], "left").select("candidate", "check", "size", F.coalesce("class", "check").alias("class"))
    tags = scratch.write(tags, "tags")
    classes = tags.groupBy("candidate", "class").agg(F.count("*").alias("n"))
    main = classes.groupBy("candidate").agg(F.max(F.struct("n", "class"))["class"].alias("main"))
    rest = tags.join(main, "candidate").where(F.col("class") != F.col("main"))
    parts = rest.groupBy("candidate").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.first("main").alias("main"))
    parts = scratch.write(parts.select("candidate", "main", _blocks("n", "size", block).alias("parts")), "parts")
    if parts.isEmpty():
        more = edges
    else:
        named = whole.drop("size").join(tags.drop("size"), ["candidate", "check"]).join(parts, "candidate").withColumnRenamed("class", "given")
        every = named.select("candidate", "at", to("parts").alias("part"), "fp", "check", kind(2), "given", "held")
        others = named.where("given != main").withColumn("part", F.pmod(F.xxhash64("check", F.lit(1)), "parts"))
        others = others.select("candidate", to("blocks").alias("at"), "part", "fp", "check", kind(1), "given", "held")
        more = _compared(every.unionByName(others), ["candidate", "at", "part"], max_bits, share).where("check != label").unionByName(edges)
    ends = components(spark, more, "check", "label")
    return ends.select(F.col("node").alias("check"), "label")


def _exact_labels(
    spark: SparkSession, scratch: Scratch, rows: DataFrame, marks: DataFrame, max_bits: int, split_over: int, check: tuple[int, float], block: tuple[int, int]
) -> DataFrame:
    """``(check, label)``: the component of every text that hangs together with another one."""
    shingle, share = check
    classes = scratch.write(marks.groupBy("fp", "check").agg(F.first("bands").alias("bands"), F.min("pick").alias("pick")), "classes")
    # The node is the digest of the shingles: texts with the same ones are one class, however far their fingerprints are apart.
    members = components(spark, link_classes(spark, classes.withColumn("node", F.col("check")), max_bits, split_over))
    named = classes.join(members, classes["check"] == members["node"], "left").select("fp", "check", "pick", F.coalesce("label", "check").alias("candidate"))
    named = scratch.write(named, "candidates")
    busy = named.groupBy("candidate").agg(F.count("*").alias("n")).where("n > 1").select("candidate")
    wanted = named.join(busy, "candidate", "left_semi")
    texts = rows.select("pick", "text").join(wanted, "pick")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            made = [shingle_bag(words_of(t), shingle) for t in texts_of(part).to_pylist()]
            digests = pa.array(np.array([d for d, _ in made], dtype=np.uint64).view(np.int64))
            own = pc.equal(digests, part.column("check"))  # a row that another one's pick met by chance goes
            size = pa.array([len(h) for _, h in made], pa.int64())
            columns = [part.column("candidate"), part.column("fp"), digests, size, pa.array([h for _, h in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["candidate", "fp", "check", "size", "held"]).filter(own)

    bags = texts.select("candidate", "fp", "check", "text").mapInArrow(run, "candidate long, fp long, check long, size long, held binary")
    bags = scratch.write(bags, "bags")
    sizes = bags.groupBy("candidate").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    large = sizes.select("candidate", _blocks("n", "size", block).alias("blocks")).where("blocks > 2")
    large = scratch.write(large, "large")
    small = bags.join(large, "candidate", "left_anti").select("*", F.lit(0).cast("long").alias("kind"), F.col("check").alias("given"))
    found = _compared(small, ["candidate"], max_bits, share)
    return found if large.isEmpty() else found.unionByName(_labels_by_blocks(spark, scratch, bags, large, max_bits, share, block))


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    max_bits: int = 3,
    split_over: int = SPLIT_OVER,
    keep: tuple[str, ...] = (),
    check: tuple[int, float] | None = None,
    block: tuple[int, int] = BLOCK,
) -> DataFrame:
    """``(id_col, *keep, fp, label, component_id)`` for every row.

    ``label`` is the same for all rows of a component, and ``component_id`` is
    the smallest id among them. ``check``, words and a share, holds
    every link against the shingles of so many words, of which they must have
    that share in common (see ``shares``). ``block``, members and bytes, bounds
    what a task compares of a component.
    """
    scratch = Scratch(spark, "simhash")
    pick = [F.xxhash64(id_col, text_col).alias("pick")] if check else []
    rows = docs.select(F.struct(id_col, *keep).alias("row"), F.col(id_col).alias("id"), *pick, F.col(text_col).alias("text"))
    marks = scratch.write(fingerprints(rows, [c for c in rows.columns if c != "text"], shingle, check and check[0]), "marks")
    node = "check" if check else "fp"
    least = marks.groupBy(node).agg(F.min("id").alias("least"))
    if check:
        found = scratch.write(_exact_labels(spark, scratch, rows, marks, max_bits, split_over, check, block), "found").withColumnRenamed("check", "node")
        scratch.drop("classes", "candidates", "bags", "large", "edges", "tags", "parts")
    else:
        classes = scratch.write(marks.select("fp", F.col("fp").alias("node")).distinct(), "classes")
        found = components(spark, link_classes(spark, classes, max_bits, split_over))
    label = least.join(found, least[node] == found["node"], "left").select(node, "least", F.coalesce("label", node).alias("label"))
    label = scratch.write(label, "labels")
    smallest = label.groupBy("label").agg(F.min("least").alias("component_id"))
    named = label.join(smallest, "label").select(node, "label", "component_id")
    return marks.join(named, node).select("row.*", "fp", "label", "component_id")


def keep_one(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, check: tuple[int, float] | None = None
) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    Rows are told apart by hashes of all their columns, so rows with equal or
    null ids are single rows too; of rows equal in every column one stays.
    """
    row = free_names([*docs.columns, "fp", "label", "component_id"], "row", "row2")
    marked = docs.select("*", F.xxhash64(*docs.columns).alias(row[0]), F.hash(*docs.columns).alias(row[1]))
    found = near_duplicates(spark, marked, id_col, text_col, shingle, max_bits, keep=tuple(row), check=check)
    first = found.groupBy("label").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), *(F.col(c) for c in row))).alias("first"))
    kept = marked.join(first.select(*(f"first.{c}" for c in row)), row, "left_semi").dropDuplicates(row)
    return kept.select(*docs.columns)
