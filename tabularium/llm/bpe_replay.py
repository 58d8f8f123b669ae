"""Byte-level BPE by merge replay over slices of the corpus, and its decoding.

Texts are split into pieces by the tokenizer's pattern; merges never cross a
piece, and a corpus has far fewer distinct pieces than pieces. A task takes the
distinct pieces of a slice of ``REPLAY_BYTES`` as one sequence of byte tokens with
links to both neighbours, and an inverted index from the rank of a mergeable
pair to the positions where that pair stands. Ranks are then replayed in
order: all positions of the lowest rank merge at once, from left to right
where they overlap, and only the two pairs at each merge's sides are looked up
and entered anew. What is left of a piece are its tokens; texts are put
together from their pieces. The work grows with the number of merges, not with
merges times pieces, and no piece is ever sent over the network: to replay the
pieces of the whole corpus together, every occurrence would have to meet its
ids again in a join, which shuffles more than the corpus (figures in the README).

Results defined for odd input: a null text is read as empty (no tokens);
bytes without a token of their own raise; pieces of any length are handled
whole; repeated rows give repeated result rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import Pieces, ragged_take, split_pieces, text_slices, texts_of

#: Bytes of text whose pieces are replayed together: the more, the fewer distinct pieces are met twice.
REPLAY_BYTES = 16 << 20


class Ranks:
    """A vocabulary of byte strings with ranks; a token's id is its rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.find = regex.compile(pattern).findall
        self.byte = np.full(256, -1, dtype=np.int64)
        top = max(self.rank.values()) + 1
        text, number = [b""] * top, [str(i).encode() + b" " for i in range(top)]
        keys, made = [], []
        for token, rank in self.rank.items():
            text[rank] = token
            if len(token) == 1:
                self.byte[token[0]] = rank
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        #: Every pair of tokens whose bytes together are a token, sorted, with that token.
        self.pairs, self.made = np.array(keys, dtype=np.int64)[order], np.array(made, dtype=np.int64)[order]
        self.bytes_flat, self.bytes_starts = _flat(text)
        self.digits_flat, self.digits_starts = _flat(number)

    def of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it doesn't merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], -1)


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), starts


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def replay(pieces: list[bytes], of: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces one after another, and where each piece starts."""
    flat, starts = _flat(pieces)
    token = of.byte[flat]
    if (token < 0).any():
        raise ValueError("the vocabulary lacks a token for a single byte")
    n = len(token)
    after = np.arange(1, n + 1)
    after[starts[1:][np.diff(starts) > 0] - 1] = -1
    before = np.full(n, -1)
    linked = np.flatnonzero(after >= 0)
    before[after[linked]] = linked
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(at: np.ndarray) -> None:
        """Enter the pairs that start at ``at`` under their ranks."""
        rank = of.of_pairs(token[at], token[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, group in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if r not in index:
                index[r] = []
                heapq.heappush(waiting, r)
            index[r].append(group)

    enter(linked)
    while waiting:
        rank = heapq.heappop(waiting)
        at = np.unique(np.concatenate(index.pop(rank)))
        # Positions merged meanwhile, or with another neighbour by now, no longer hold this pair.
        at = at[(token[at] >= 0) & (after[at] >= 0)]
        at = at[of.of_pairs(token[at], token[after[at]]) == rank]
        if not len(at):
            continue
        # In a run such as aaaa the pairs overlap: from the left, every second one merges.
        chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        at = at[run % 2 == 0]
        gone = after[at]
        token[at] = rank
        token[gone] = -1
        after[at] = after[gone]
        right = at[after[at] >= 0]
        before[after[right]] = right
        left = before[at]
        enter(np.unique(np.concatenate([right, left[left >= 0]])))
    alive = token >= 0
    return token[alive], np.concatenate([[0], np.cumsum(alive)])[starts]


def encode_texts(texts: list[str], of: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after another, and where each text starts."""
    found: Pieces = split_pieces(texts, of.find)
    ids, at = replay([p.encode("utf-8", "surrogatepass") for p in found.distinct], of)
    out, lengths = ragged_take(ids, at, found.codes)
    return out, np.concatenate([[0], np.cumsum(lengths)])[found.starts]


def decode_ids(ids: np.ndarray, starts: np.ndarray, of: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the token ids, and where each text starts."""
    flat, lengths = ragged_take(of.bytes_flat, of.bytes_starts, ids)
    return flat, np.concatenate([[0], np.cumsum(lengths)])[starts]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests_only: bool = False) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded, ids_sha256, decoded_sha256)`` for every row.

    ``ids`` are the token ids, ``decoded`` the text that they decode to,
    ``ids_sha256`` the digest of the decimal ids joined by one space.
    ``digests_only`` leaves ``ids`` and ``decoded`` out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = ranks(vocabulary, pattern)
        # Digests are taken a few texts at a time: ids, digits and bytes of all texts would not fit beside each other.
        for part in text_slices(batches, limit=REPLAY_BYTES):
            ids, starts = encode_texts(texts_of(part).to_pylist(), of)
            ids_sha, text_sha, decoded = [], [], []
            step = max(1, int(part.num_rows * (4 << 20) / max(1, len(ids))))
            for a in range(0, part.num_rows, step):
                b = min(a + step, part.num_rows)
                own, cut = ids[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
                digits, lengths = ragged_take(of.digits_flat, of.digits_starts, own)
                ends = np.concatenate([[0], np.cumsum(lengths)])[cut]
                view = memoryview(digits)
                ids_sha += [hashlib.sha256(view[x : max(x, y - 1)]).hexdigest() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                flat, ends = decode_ids(own, cut, of)
                view = memoryview(flat)
                text_sha += [hashlib.sha256(view[x:y]).hexdigest() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                if not digests_only:
                    decoded += [str(view[x:y], "utf-8") for x, y in zip(ends[:-1], ends[1:], strict=True)]
            columns = [part.column("id"), pa.array(np.diff(starts)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if not digests_only:
                columns += [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    more = "" if digests_only else ", ids array<int>, decoded string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    )


def decode(tokens: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, decoded)``: the text of each array of token ids, null for null or for ids that are no valid text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = ranks(vocabulary, pattern)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                good = ids is not None and all(i is not None and 0 <= i < len(of.bytes_starts) - 1 for i in ids)
                raw = decode_ids(np.array(ids, dtype=np.int64), np.array([0, len(ids)]), of)[0].tobytes() if good else None
                try:
                    out.append(None if raw is None else raw.decode("utf-8"))
                except UnicodeDecodeError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=[id_col, "decoded"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"{id_col} {kind}, decoded string")
