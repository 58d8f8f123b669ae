"""Exact token counts at every prefix of a text, by dynamic programming.

A text is split into pieces by the tokenizer's pattern; merges never cross a
piece. For a piece the table holds, for each of its prefixes, the number of
tokens of that prefix encoded by itself. It is filled from left to right: the
last token of a prefix is the one token ending there that leaves a rest whose
own last token stands beside it unmerged, and the count is the rest's count
plus one. Two tokens stand side by side exactly if, replaying in rank order
the merges that built the left token's right edge and the right token's left
edge, no merge across the boundary comes first; both edges are precomputed.

A text's own table is the running sum over its pieces. With both, the count of
any prefix, the longest prefix within a budget and the number of pieces of a
given size are looked up; nothing is encoded again.

Results defined for odd input: a null text is read as empty (no bytes, no
tokens); a piece of any length is handled whole; repeated rows give repeated
result rows; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import split_pieces, text_slices, texts_of

#: Fixed by the byte-level vocabulary: the split before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTION = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d")
#: The same for texts of signs up to U+024F and some marks, whose kinds can be written out: Python's own engine takes half the time.
PLAIN = re.compile(r"[ \t-\r!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2013\u2014\u2018-\u201f\u2026\u20ac]*")
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
PLAIN_PATTERN = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}0-9]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]"))
#: Pieces whose tables a Python worker keeps, beyond those of the texts at hand, and neighbours of which it knows whether they merge.
TABLES_KEPT, BESIDE_KEPT = 450_000, 3_000_000
#: Bytes of text whose distinct pieces are entered together.
COUNT_BYTES = 16 << 20
NEVER = 1 << 30
MISSING = object()


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write byte b as itself if it is printable, else as the next free code point from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = {}, 256
    for b in range(256):
        if b in shown:
            out[chr(b)] = b
        else:
            out[chr(free)] = b
            free += 1
    return out


class PrefixTables:
    """Prefix tables of pieces under one vocabulary file (``tokenizers`` JSON, byte-level)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_of_symbol()
        raw = lambda token: bytes(symbol[c] for c in token)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pattern = regex.compile(PATTERN)
        cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern, self.cut = pattern, cut
        self.id = {raw(token): number for token, number in spec["model"]["vocab"].items() if token not in self.special}
        self.rank: dict[tuple[int, int], int] = {}
        #: For a token, its edge from a single byte up to the token itself: (token, rank of the merge that absorbs it).
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        for raw_token, number in self.id.items():
            if len(raw_token) == 1:
                self.right[number] = self.left[number] = [(number, NEVER)]
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            x, y = self.id[raw(a)], self.id[raw(b)]
            self.rank[x, y] = rank
            made = self.id[raw(a) + raw(b)]
            if made not in self.right:
                self.right[made] = [*self.right[y][:-1], (y, rank), (made, NEVER)]
                self.left[made] = [*self.left[x][:-1], (x, rank), (made, NEVER)]
        #: Every beginning of a token, with the tokens that it ends with as ``(length, token)``, the longest first; None until asked for.
        self.ending: dict[bytes, tuple[tuple[int, int], ...] | None] = dict.fromkeys(token[:k] for token in self.id for k in range(1, len(token) + 1))
        self.beside: dict[int, bool] = {}
        self.tables: dict[str, bytes | np.ndarray] = {}

    def stand_apart(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` in a row are what their bytes encode to."""
        edge, other = self.right[a], self.left[b]
        i = j = 0
        while True:
            (x, x_goes), (y, y_goes) = edge[i], other[j]
            across = self.rank.get((x, y))
            # Of equal ranks the leftmost merge comes first: the left token's own, then the one across.
            if across is not None and across < x_goes and across <= y_goes:
                return False
            if x_goes == NEVER and y_goes == NEVER:
                return True
            if x_goes <= y_goes:
                i += 1
            else:
                j += 1

    def extend(self, piece: bytes, count: list[int], last: list[int], reach: list[int]) -> None:
        """Carry the table of a prefix of ``piece`` on to all of it. ``count`` and ``last`` hold, for each prefix from
        the empty one on, its number of tokens and its last token; ``reach`` the length of the longest token's beginning
        that the prefix ends with, which grows by one byte at most: no longer token needs to be looked for."""
        ending, beside = self.ending, self.beside
        for end in range(len(count), len(piece) + 1):
            begin = end - 1 - reach[-1]
            while (tokens := ending.get(tail := piece[begin:end], MISSING)) is MISSING:
                begin += 1
            reach.append(end - begin)
            if tokens is None:
                tokens = ending[tail] = tuple((len(tail) - k, self.id[tail[k:]]) for k in range(len(tail)) if tail[k:] in self.id)
            for length, token in tokens:
                before = last[end - length]
                if before >= 0:
                    key = before << 32 | token
                    apart = beside.get(key)
                    if apart is None:
                        apart = beside[key] = self.stand_apart(before, token)
                    if not apart:
                        continue
                elif end > length:
                    continue
                count.append(count[end - length] + 1)
                last.append(token)
                break

    def fill(self, pieces: Iterable[str]) -> None:
        """Enter the tables of ``pieces``. In sorted order a piece takes over the table of what it shares with the one before."""
        if len(self.beside) > BESIDE_KEPT:
            self.beside.clear()
        known = self.tables
        held, count, last, reach = b"", [0], [-1], [0]
        for raw, piece in sorted((p.encode("utf-8", "surrogatepass"), p) for p in pieces if p not in known):
            shared, most = 0, min(len(held), len(raw))
            while shared < most and held[shared] == raw[shared]:
                shared += 1
            del count[shared + 1 :], last[shared + 1 :], reach[shared + 1 :]
            self.extend(raw, count, last, reach)
            known[piece] = bytes(count) if count[-1] < 256 > max(count) else np.array(count, dtype=np.int32)
            held = raw

    def make_room(self, pieces: Iterable[str]) -> None:
        """Where too many tables are known, forget all but those of ``pieces``, which are at hand; most of what recurs is among them."""
        if len(self.tables) > TABLES_KEPT:
            self.tables = {p: self.tables[p] for p in pieces if p in self.tables}

    def table(self, piece: str) -> bytes | np.ndarray:
        if piece not in self.tables:
            if len(self.tables) > 4 * TABLES_KEPT:
                self.tables.clear()
            self.fill([piece])
        return self.tables[piece]

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text in order; a special token is a piece of its own."""
        if self.cut is None or not any(s in text for s in self.special):
            return PLAIN_PATTERN.findall(text) if PLAIN.fullmatch(text) else self.pattern.findall(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self.pattern.findall(text[at : m.start()]), m.group()]
            at = m.end()
        return out + self.pattern.findall(text[at:])

    def total(self, piece: str) -> int:
        return 1 if piece in self.special else int(self.table(piece)[-1])


@lru_cache(maxsize=2)
def tables(path: str) -> PrefixTables:
    return PrefixTables(path)


class PrefixCounts:
    """Token counts at every prefix of one text (prefixes end between characters)."""

    def __init__(self, text: str, of: PrefixTables):
        self.text, self.of = text, of
        self.pieces = of.pieces(text)
        self.ends = np.cumsum([0, *map(len, self.pieces)])
        self.tokens = np.cumsum([0, *map(of.total, self.pieces)])
        self._at, self._width = -1, None

    def __len__(self) -> int:
        return int(self.tokens[-1])

    def at(self, chars: int) -> int:
        """Tokens of ``text[:chars]``. Within a run of one kind the piece's own table has them; elsewhere a cut piece may
        split otherwise, and two pieces of white space may join, so the last three are split anew."""
        k = int(np.searchsorted(self.ends, chars, side="right")) - 1
        if self.ends[k] == chars and k == len(self.pieces):
            return int(self.tokens[k])
        if chars - self.ends[k] >= 2 and (width := self._widths(k)) is not None:
            return int(self.tokens[k]) + int(self.of.table(self.pieces[k])[width[chars - self.ends[k]]])
        before = max(k - 2, 0)
        rest = self.text[self.ends[before] : chars]
        return int(self.tokens[before]) + sum(map(self.of.total, self.of.pieces(rest)))

    def _widths(self, k: int) -> np.ndarray | None:
        """Bytes of each prefix of piece ``k``, or None for a contraction or a special token, whose prefixes aren't pieces."""
        if self._at != k:
            piece = self.pieces[k]
            whole = piece in self.of.special or CONTRACTION.fullmatch(piece)
            self._at = k
            self._width = None if whole else np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in piece)])
        return self._width

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if len(self) <= budget:
            return len(self.text)
        k = int(np.searchsorted(self.tokens, budget, side="right"))
        # Counts needn't rise within a piece, and the next piece's start may still fit when white space joins.
        top = int(self.ends[min(k + 2, len(self.pieces))])
        for chars in range(top, -1, -1):
            if self.at(chars) <= budget:
                return chars
        return 0

    def cuts(self, budget: int) -> list[int]:
        """Character ends of pieces that cover the text, each the longest that holds at most ``budget`` tokens by itself."""
        out, begin = [], 0
        while begin < len(self.text):
            part = PrefixCounts(self.text[begin:], self.of) if begin else self
            step = part.longest_within(budget)
            if not step:
                raise ValueError("a single character takes more tokens than the budget")
            begin += step
            out.append(begin)
        return out


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_table: bool = False,
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit, cut_chars)`` for every row; with ``keep_table`` also the text's table.

    ``cut_chars`` is the length of the longest prefix that ``limit`` tokens
    hold. ``piece_ends`` and ``piece_tokens`` are the running sums of
    characters and of tokens after each piece, from which ``PrefixCounts``
    answers further questions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tables(vocabulary)
        for part in text_slices(batches, limit=COUNT_BYTES):
            texts = texts_of(part)
            strings = texts.to_pylist()
            found = split_pieces(strings, of.pieces)
            of.make_room(found.distinct)
            of.fill(found.distinct)
            total = np.fromiter(map(of.total, found.distinct), dtype=np.int64, count=len(found.distinct))
            width = np.fromiter(map(len, found.distinct), dtype=np.int64, count=len(found.distinct))
            running = np.concatenate([[0], np.cumsum(total[found.codes])])
            n = running[found.starts[1:]] - running[found.starts[:-1]]
            cut = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in np.flatnonzero(n > limit):
                # The table up to the first piece beyond the limit decides where the cut is.
                a = found.starts[i]
                stop = int(np.searchsorted(running[a : found.starts[i + 1] + 1] - running[a], limit, side="right"))
                chars = int(width[found.codes[a : min(a + stop + 2, found.starts[i + 1])]].sum())
                cut[i] = PrefixCounts(strings[i][: chars + 1], of).longest_within(limit)
            columns = [part.column("id"), pc.binary_length(texts).cast("int64"), pa.array(n), pa.array(n > limit), pa.array(cut)]
            names = [id_col, "n_bytes", "n_tokens", "over_limit", "cut_chars"]
            if keep_table:
                for name, values in (("piece_ends", width), ("piece_tokens", total)):
                    sums = np.concatenate([[0], np.cumsum(values[found.codes])])
                    flat = sums[1:] - np.repeat(sums[found.starts[:-1]], np.diff(found.starts))
                    columns.append(pa.ListArray.from_arrays(pa.array(found.starts, pa.int32()), pa.array(flat)))
                    names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    more = ", piece_ends array<long>, piece_tokens array<long>" if keep_table else ""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long{more}"
    )
