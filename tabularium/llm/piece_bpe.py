"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised as the model says (blanks become ``U+2581``, one more in
front) and falls into words, which no piece of the vocabulary crosses. The
distinct words of a slice of texts are one flat array of symbols, at first one
per character. In each round every word finds the lowest rank of its pairs by
a segmented minimum and merges all pairs of that rank from left to right at
once; symbols that were merged away are compacted out, and words without a pair
left are done. What no piece stands for is written in byte pieces.

The library merges one pair after another, the leftmost of the best score
first. To merge a word's pairs at once is the same unless a merge makes a pair
that would be due before the next one: such a word merges up to and including
that pair, and goes on in the next round. A long run of blanks would take a
round per blank, as all pieces of blanks have one score; it is cut after each
longest such piece, where the library's merges end too.

Boundaries come from the vocabulary: two neighbouring characters that stand
side by side in no piece are never merged, so a word ends between them.

Results defined for odd input: a null text is read as empty (no ids, empty
text); strings of control pieces in a text are ordinary text; texts and words
of any length are encoded whole; repeated rows give repeated result rows;
other columns are ignored, whatever their names. Models that normalise
characters, that are no BPE models, lack byte fallback or hold unused or
user-defined pieces raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import Pieces, ragged_take, release, split_pieces, text_slices, texts_of

BLANK = "▁"
#: Code of a symbol that is a single character without a piece: this much more than its code point.
NO_PIECE = 1 << 30
NEVER = np.iinfo(np.int64).max
#: Kinds of pieces in a model file, and numbers of its fields: fixed values of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALISER = 1, 2, 3
BPE = 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        size = number() if size is None else size
        yield tag >> 3, raw[at : at + size]
        at += size


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))]).astype(np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), starts


class Model:
    """Pieces, ranks of mergeable pairs and word boundaries of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            sections: dict[int, list[bytes]] = {}
            for key, value in _fields(f.read()):
                sections.setdefault(key, []).append(value)
        trainer, normaliser = ({k: v for part in sections.get(s, []) for k, v in _fields(part)} for s in (TRAINER, NORMALISER))
        if trainer.get(3) != BPE or not trainer.get(35):
            raise ValueError("the model must be a BPE model with byte fallback")
        if normaliser.get(2) or normaliser.get(6) or not normaliser.get(5, 1) or trainer.get(24):
            raise ValueError("the model must not normalise characters, and must write blanks as U+2581 before words")
        self.dummy_prefix, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        text, score, kind = [], [], []
        for part in sections[PIECES]:
            one = dict(_fields(part))
            text.append(one[1].decode())
            score.append(float(np.frombuffer(one.get(2, b"\0\0\0\0"), "<f4")[0]))
            kind.append(one.get(3, NORMAL))
        if {USER_DEFINED, UNUSED} & set(kind):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.text, self.kind = text, np.array(kind)
        self.byte = np.full(256, -1, dtype=np.int64)
        for i, k in enumerate(kind):
            if k == BYTE:
                self.byte[int(text[i][1:-1], 16)] = i
        normal = {t: i for i, (t, k) in enumerate(zip(text, kind, strict=True)) if k == NORMAL}
        self._characters(normal)
        self._pairs(normal, score)
        self._blanks(normal, score)
        self._output()

    def _characters(self, normal: dict[str, int]) -> None:
        single = sorted((ord(t), i) for t, i in normal.items() if len(t) == 1)
        self.points, self.point_id = (np.array(c, dtype=np.int64) for c in zip(*single, strict=True))
        #: Two code points that stand side by side in some piece.
        self.beside = np.unique(np.array([ord(a) << 32 | ord(b) for t in normal for a, b in zip(t, t[1:], strict=False)], dtype=np.int64))

    def _pairs(self, normal: dict[str, int], score: list[float]) -> None:
        #: Ranks: the higher the score the lower, equal for equal scores.
        order = {s: r for r, s in enumerate(sorted({score[i] for i in normal.values()}, reverse=True))}

        def code(part: str) -> int | None:
            return normal.get(part, NO_PIECE + ord(part) if len(part) == 1 else None)

        rows = []
        for piece, i in normal.items():
            for at in range(1, len(piece)):
                a, b = code(piece[:at]), code(piece[at:])
                if a is not None and b is not None:
                    rows.append((a << 32 | b, i, order[score[i]]))
        rows.sort()
        self.pairs, self.made, self.rank = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))

    def _blanks(self, normal: dict[str, int], score: list[float]) -> None:
        runs = {len(t): score[i] for t, i in normal.items() if len(t) > 1 and set(t) == {BLANK}}
        longest = max(runs, default=1)
        mixed = any(BLANK * 2 in t and set(t) != {BLANK} for t in normal)
        inner = any(BLANK in t.lstrip(BLANK) for t in normal)
        # Of pieces with one score the leftmost pair merges first: the first blanks become the longest piece before any later pair is touched.
        whole = BLANK in normal and len(rounds(np.full(longest, normal[BLANK]), np.zeros(longest, dtype=np.int64), self)[0]) == 1
        #: Length of the pieces that a long run of blanks falls into, 0 where the vocabulary doesn't allow to tell.
        self.run = longest if longest > 1 and not mixed and len(set(runs.values())) == 1 and whole else 0
        #: A word is a run of blanks and what follows; where a piece may hold a blank after something else, the whole text.
        cut = f"(?s:{BLANK}{{{self.run}}}(?={BLANK})|{BLANK}+[^{BLANK}]*|[^{BLANK}]+)" if self.run else f"(?s:{BLANK}+[^{BLANK}]*|[^{BLANK}]+)"
        self.find = regex.compile("(?s:.+)" if inner else cut).findall

    def _output(self) -> None:
        spoken = [b"" if k == CONTROL else self.unknown_text.encode() if k == UNKNOWN else bytes([int(t[1:-1], 16)]) if k == BYTE else t.replace(BLANK, " ").encode() for t, k in zip(self.text, self.kind.tolist(), strict=True)]
        self.bytes_flat, self.bytes_starts = _flat(spoken)
        self.opens = np.array([t.startswith(BLANK) for t in self.text]) & (self.kind == NORMAL)
        self.digits_flat, self.digits_starts = _flat([b"%d," % i for i in range(len(self.text))])

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = regex.sub(" {2,}", " ", text).strip(" ")
        text = text.replace(" ", BLANK)
        return BLANK + text if text and self.dummy_prefix else text

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NEVER`` where it doesn't merge), and the piece that it makes."""
        if not len(self.pairs):
            return np.full(len(a), NEVER), np.zeros(len(a), dtype=np.int64)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], NEVER), self.made[at]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def rounds(symbols: np.ndarray, word: np.ndarray, of: Model) -> tuple[np.ndarray, np.ndarray]:
    """``symbols`` of words (``word`` ascends) after all merges, and the word of each symbol that is left.

    A round looks up the pairs of the words that still merge, and no others.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank = np.full(len(symbols), NEVER)
        made = np.zeros(len(symbols), dtype=np.int64)
        rank[pair], made[pair] = of.of_pairs(symbols[pair], symbols[pair + 1])
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.concatenate([start, [len(symbols)]]))
        best = np.repeat(np.minimum.reduceat(rank, start), size)
        over = best == NEVER
        if over.any():
            done.append((symbols[over], word[over]))
            symbols, word, rank, made, best = (x[~over] for x in (symbols, word, rank, made, best))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == best)
        # In a run such as aaaa the pairs overlap: from the left, every second one merges.
        chained = np.concatenate([[False], np.diff(at) == 1])
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        at = at[run % 2 == 0]
        at = at[_in_turn(symbols, word, at, made[at], best[at], of)]
        symbols[at] = made[at]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, word = symbols[keep], word[keep]
    if not done:
        return symbols, word
    out, owner = (np.concatenate(c) for c in zip(*done, strict=True))
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


def _in_turn(symbols: np.ndarray, word: np.ndarray, at: np.ndarray, made: np.ndarray, best: np.ndarray, of: Model) -> np.ndarray:
    """Which of the merges at ``at`` come before any pair that they themselves make: those up to the first that makes one due at once."""
    merged = np.full(len(symbols) + 1, -1, dtype=np.int64)
    merged[at] = made
    # Right of a merge stands what is not merged yet; left of it what its left neighbour has become.
    right = at + 2
    inside = right < len(symbols)
    right = np.minimum(right, len(symbols) - 1)
    soon = inside & (word[right] == word[at])
    soon[soon] = of.of_pairs(made[soon], symbols[right[soon]])[0] <= best[soon]
    left = np.maximum(at - 1, 0)
    became = np.where((at >= 2) & (merged[np.maximum(at - 2, 0)] >= 0), merged[np.maximum(at - 2, 0)], symbols[left])
    before = (at >= 1) & (word[left] == word[at])
    before[before] = of.of_pairs(became[before], made[before])[0] <= best[before]
    early = soon | before
    if not early.any():
        return np.ones(len(at), dtype=bool)
    first = np.flatnonzero(np.concatenate([[True], word[at[1:]] != word[at[:-1]]]))
    earlier = np.cumsum(early) - early
    return earlier == np.repeat(earlier[first], np.diff(np.concatenate([first, [len(at)]])))


def encode_words(words: list[str], of: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and where each word starts."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.minimum(np.searchsorted(of.points, points), len(of.points) - 1)
    symbols = np.where(of.points[at] == points, of.point_id[at], NO_PIECE + points)
    if len(points):
        key = points[:-1] << 32 | points[1:]
        found = np.minimum(np.searchsorted(of.beside, key), len(of.beside) - 1)
        apart = (of.beside[found] != key) | (owner[1:] != owner[:-1])
        part = np.concatenate([[0], np.cumsum(apart)])
        owner_of_part = owner[np.concatenate([[True], apart])]
        symbols, part = rounds(symbols, part, of)
        owner = owner_of_part[part]
    plain = symbols < NO_PIECE
    if not plain.all():
        symbols, owner = _bytes_of_missing(symbols, owner, plain, of)
    return symbols, np.searchsorted(owner, np.arange(len(words) + 1))


def _bytes_of_missing(symbols: np.ndarray, owner: np.ndarray, plain: np.ndarray, of: Model) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece replaced by the pieces of their bytes."""
    point, which = np.unique(symbols[~plain] - NO_PIECE, return_inverse=True)
    flat, starts = _flat([chr(p).encode("utf-8", "surrogatepass") for p in point.tolist()])
    size = np.ones(len(symbols), dtype=np.int64)
    size[~plain] = np.diff(starts)[which]
    out = np.repeat(symbols, size)
    out[np.repeat(~plain, size)] = of.byte[ragged_take(flat, starts, which)[0]]
    return out, np.repeat(owner, size)


def encode_texts(texts: list[str], of: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text starts."""
    found: Pieces = split_pieces([of.normalise(t) for t in texts], of.find)
    ids, at = encode_words(found.distinct, of)
    out, lengths = ragged_take(ids, at, found.codes)
    return out, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)[found.starts]


def decode_ids(ids: np.ndarray, starts: np.ndarray, of: Model) -> list[bytes]:
    """The text of each run of ids in UTF-8; bytes that are no UTF-8 become U+FFFD, one each."""
    flat, lengths = ragged_take(of.bytes_flat, of.bytes_starts, ids)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    view = memoryview(np.ascontiguousarray(flat))
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        while a < b and of.kind[ids[a]] == CONTROL:
            a += 1
        lead = int(a < b and bool(of.opens[ids[a]]) and (of.dummy_prefix or of.squeeze))
        raw = bytes(view[ends[a] + lead : ends[b]])
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = _mended(raw)
        out.append(raw)
    return out


def _mended(raw: bytes) -> bytes:
    text, at = [], 0
    while at < len(raw):
        size = next((k for k in (1, 2, 3, 4) if _valid(raw[at : at + k], k)), 0)
        text.append(raw[at : at + size] if size else "�".encode())
        at += size or 1
    return b"".join(text)


def _valid(raw: bytes, size: int) -> bool:
    try:
        return len(raw) == size and len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", digests_only: bool = False) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded, ids_sha256, decoded_sha256)`` for every row.

    ``decoded`` is the text that ``ids`` decode to, ``ids_sha256`` the digest of
    the decimal ids joined by commas. ``digests_only`` leaves ``ids`` and ``decoded`` out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model(model_path)
        for part in text_slices(batches):
            ids, starts = encode_texts(texts_of(part).to_pylist(), of)
            digits, lengths = ragged_take(of.digits_flat, of.digits_starts, ids)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)[starts].tolist()
            view = memoryview(np.ascontiguousarray(digits))
            ids_sha = [hashlib.sha256(view[x : max(x, y - 1)]).hexdigest() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            texts = decode_ids(ids, starts, of)
            columns = {
                id_col: part.column("id"),
                "n_tokens": pa.array(np.diff(starts)),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
            if not digests_only:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                columns["decoded"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            release()

    kind = docs.schema[id_col].dataType.simpleString()
    more = "" if digests_only else ", ids array<int>, decoded string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    )


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, decoded)``: the text of each array of ids, null for null or for ids outside the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model(model_path)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                good = ids is not None and all(i is not None and 0 <= i < len(of.text) for i in ids)
                out.append(decode_ids(np.array(ids, dtype=np.int64), np.array([0, len(ids)]), of)[0].decode() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=[id_col, "decoded"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"{id_col} {kind}, decoded string")
