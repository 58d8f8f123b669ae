"""Packing of tokenised documents into sequences of one length.

A document's ids, with an end id, are cut at multiples of the sequence length:
whole parts are sequences of their own and the rest is one piece. The rests
are dealt at random into groups, and each group is packed by itself, first-fit
decreasing: pieces from long to short go into the first sequence with room. A
tournament tree holds in each node the largest room below it, so the first fit
is found by walking from the root to the leftmost leaf that is large enough,
and an update climbs back. Only spans are shuffled (some 40 bytes for a
piece), never ids, and a task holds one group at a time.

Tokenising: the vocabulary's pattern drops white space, so ids of a text are
those of its words put together. The library encodes each distinct word of a
slice once; where it is shown to fold case and to cut a mark off its word,
words that differ in that alone count as one. Common words are kept from slice to slice.

Results defined for odd input: a null text is read as empty and still has its
end id; repeated rows are documents of their own, dealt apart as any others; null
ids stay null; other columns are ignored. No row in gives no row out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import bound_batches, ragged_take, split_words, text_slices, texts_of

LENGTH = 4096
#: Pieces that are packed together.
GROUP_PIECES = 8192
SEED = 20
WORDS_AT_ONCE = 500
#: Words whose ids a Python worker keeps.
WORDS_KEPT = 400_000
#: Marks that a vocabulary may cut off a word, and letters whose case it may fold.
MARKS, LETTERS = ".,;:!?", "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[{LETTERS}]+")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = [t.content for t in library.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
    return library, special[0]


def encode_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words one after another, and where each word starts.

    The library takes words joined by its start token, a few hundred at once;
    what stands between two special tokens is encoded by itself. Words that
    hold the start token are encoded alone.
    """
    library, between = tokenizer(path)
    odd = {i for i, w in enumerate(words) if between in w}
    plain = ["" if i in odd else w for i, w in enumerate(words)] if odd else words
    joined = [between.join(plain[a : a + WORDS_AT_ONCE]) + between for a in range(0, len(plain), WORDS_AT_ONCE)]
    # The library's results are large: a few calls' worth of them at a time.
    parts = [
        np.fromiter(chain.from_iterable(e.ids for e in library.encode_batch_fast(joined[a : a + 8], add_special_tokens=False)), dtype=np.uint32)
        for a in range(0, len(joined), 8)
    ]
    ids = np.concatenate([np.zeros(0, dtype=np.uint32), *parts])
    bar = ids == library.token_to_id(between)
    flat, starts = ids[~bar], np.concatenate([[0], (np.cumsum(~bar))[bar]])
    if odd:
        parts = np.split(flat, starts[1:-1])
        for i in odd:
            parts[i] = np.array(library.encode(words[i], add_special_tokens=False).ids, dtype=np.uint32)
        flat, starts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return flat, starts


@lru_cache(maxsize=2)
def folds(path: str) -> bool:
    """Whether the vocabulary folds the case of ``LETTERS`` and cuts ``MARKS`` off a word."""
    library, _ = tokenizer(path)
    if library.normalizer is None or library.pre_tokenizer is None:
        return False
    every = "".join(chr(c) for c in range(0x100) if re.match(f"[{LETTERS}]", chr(c)))
    cut = lambda w: [part for part, _ in library.pre_tokenizer.pre_tokenize_str(w)]
    apart = all(cut(w + m) == cut(w) + cut(m) for w in ("ab", "\u00e9\u00e0") for m in MARKS)
    return apart and all(library.normalizer.normalize_str(c) == c.lower() for c in every)


@lru_cache(maxsize=2)
def word_ends(path: str) -> np.ndarray | None:
    """For each id whether it ends a word, if the vocabulary marks that and folds (see ``folds``)."""
    library, _ = tokenizer(path)
    mark = getattr(library.model, "end_of_word_suffix", None)
    if not mark or not folds(path):
        return None
    known = library.get_vocab()
    out = np.zeros(max(known.values()) + 1, dtype=bool)
    out[[number for token, number in known.items() if token.endswith(mark)]] = True
    return out


def encode_plain(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of words of ``LETTERS`` alone, joined by blanks: the ids say where each ends. None where they don't."""
    library, _ = tokenizer(path)
    joined = [" ".join(words[a : a + WORDS_AT_ONCE]) for a in range(0, len(words), WORDS_AT_ONCE)]
    parts = [
        np.fromiter(chain.from_iterable(e.ids for e in library.encode_batch_fast(joined[a : a + 8], add_special_tokens=False)), dtype=np.uint32)
        for a in range(0, len(joined), 8)
    ]
    ids = np.concatenate([np.zeros(0, dtype=np.uint32), *parts])
    ends = np.flatnonzero(word_ends(path)[ids]) + 1
    return (ids, np.concatenate([[0], ends])) if len(ends) == len(words) and (not len(ids) or ends[-1] == len(ids)) else None


class WordIds:
    """The ids of words, of which the first ``WORDS_KEPT`` stay for later slices."""

    def __init__(self, path: str):
        self.path, self.place = path, {}
        self.flat, self.starts = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _fresh(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Words, plain ones first, with their ids."""
        if word_ends(self.path) is None:
            return words, *encode_words(words, self.path)
        plain, other = [], []
        for w in words:
            (plain if PLAIN.fullmatch(w) else other).append(w)
        found = encode_plain(plain, self.path) or encode_words(plain, self.path)
        rest = encode_words(other, self.path)
        return plain + other, np.concatenate([found[0], rest[0]]), np.concatenate([found[1], rest[1][1:] + found[1][-1]])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and where each starts."""
        at = np.fromiter((self.place.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        new = np.flatnonzero(at < 0).tolist()
        fresh, flat, starts = self._fresh([words[i] for i in new])
        kept = len(self.place)
        number = dict(zip(fresh, range(kept, kept + len(fresh)), strict=True))
        at[new] = np.fromiter((number[words[i]] for i in new), dtype=np.int64, count=len(new))
        flat = np.concatenate([self.flat, flat])
        starts = np.concatenate([self.starts, starts[1:] + self.starts[-1]])
        room = min(len(fresh), max(0, WORDS_KEPT - kept))
        if room:
            self.place.update(zip(fresh[:room], range(kept, kept + room), strict=True))
            self.starts = starts[: kept + room + 1].copy()
            self.flat = flat[: self.starts[-1]].copy()
        out, lengths = ragged_take(flat, starts, at)
        return out, np.concatenate([[0], np.cumsum(lengths)])


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encode_types(types: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words one after another, and where each starts."""
    if not folds(path):
        return word_ids(path).encode(types.to_pylist())
    plain = pc.match_substring_regex(types, f"^[{LETTERS}]+[{MARKS}]?$")
    stem = pc.if_else(plain, pc.utf8_rtrim(pc.utf8_lower(types), MARKS), types)
    last = pc.utf8_slice_codeunits(types, -1)
    last = pc.if_else(pc.and_(plain, pc.is_in(last, value_set=pa.array(list(MARKS)))), last, "")
    coded = pa.chunked_array([stem, last]).dictionary_encode().unify_dictionaries().combine_chunks()
    units = coded.dictionary.to_pylist()
    flat, starts = word_ids(path).encode(units)
    # Each word's stem, then its mark (an empty unit has no ids).
    codes = coded.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T.ravel()
    out, lengths = ragged_take(flat, starts, codes)
    return out, np.concatenate([[0], np.cumsum(lengths)])[::2]


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text starts; for vocabularies that drop white space."""
    words = split_words(texts)
    flat, starts = encode_types(words.types, path)
    out, lengths = ragged_take(flat, starts, words.codes)
    return out, np.concatenate([[0], np.cumsum(lengths)])[words.starts]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, start, length, ids_crc32, doc_tokens)``: each document cut at multiples of ``length``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            flat, ends = encode_texts(texts_of(part), vocabulary)
            row, start, size, crc, total = [], [], [], [], []
            for i in range(part.num_rows):
                ids = np.append(flat[ends[i] : ends[i + 1]], np.uint32(end_id)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at : at + length]
                    row.append(i)
                    start.append(at)
                    size.append(len(piece))
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids))
            long = [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row, pa.int64())), *long], names=[id_col, "start", "length", "ids_crc32", "doc_tokens"])

    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )


class Tournament:
    """Rooms of sequences under a tree of maxima."""

    def __init__(self, n: int, length: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [length] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first sequence with room: its number, and the room that it had."""
        room, node, leaves = self.room, 1, self.leaves
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        at = node
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return node - leaves, had


def first_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece."""
    tree = Tournament(max(1, len(sizes)), length)
    sequence, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        number, had = tree.place(size)
        sequence[i], offset[i] = number, length - had
    return sequence, offset


def pack(cut: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``. Sequence ids are unique, not gapless."""
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40

        def packed(group: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal first
            table = pa.Table.from_batches(group).combine_chunks()
            sequence, offset = first_fit_decreasing(table.column("length").to_numpy(), length)
            columns = [table.column(n).combine_chunks() for n in names]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(sequence + first), pa.array(offset)], names=[*names, "sequence_id", "offset"])
            first += int(sequence.max()) + 1
            return out

        group: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, group_pieces - sum(b.num_rows for b in group))
                group.append(part)
                at += part.num_rows
                if sum(b.num_rows for b in group) == group_pieces:
                    yield packed(group)
                    group = []
        if group:
            yield packed(group)

    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The order by a seeded hash is the random deal; the further columns make it the same whenever a task is run again.
    # Equal rows are told apart by their place in the task that made them, so that they are dealt over all partitions too.
    salted = cut.withColumn("salt", F.monotonically_increasing_id())
    dealt = salted.withColumn("deal", F.xxhash64(F.lit(seed), *(F.col(c) for c in names), "salt"))
    dealt = dealt.repartition(parts, "deal").sortWithinPartitions("deal", *names).drop("deal", "salt")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)``."""
    return pack(pieces(docs, vocabulary, end_id, length, id_col, text_col), length, group_pieces, seed, id_col)
