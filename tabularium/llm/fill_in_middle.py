"""Fill-in-the-middle transformation: documents cut in three and put in another order.

The units of a text are the isolated matches of one code point that a
``Split`` pre-tokenizer of the tokenizers library reports, which needs no
training: the number of its offsets is the length ``n`` of the text, and the
offsets with the ranks of the two cuts are where prefix and middle end. The
pre-tokenizer is given a text block by block, so that no task holds the
offsets of a whole long text; a unit never spans two blocks, and a rank is
looked up in its own block.

Cuts and form depend on the seed and the row's id alone: ``h1`` to ``h4`` are
the first four groups of eight hexadecimal digits of the SHA-256 of
``seed:id``. A text that holds a marker stays plain, so that every output can
be taken apart again by its markers.

Results defined for odd input: a null text is read as empty, and an empty text
stays plain; a null id is read as an empty string of digits; repeated rows give
repeated result rows; texts of any length are cut whole; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from tabularium.llm.common import text_slices, texts_of

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
#: One code point, line ends included.
UNIT = r"[\s\S]"
#: Code points that the pre-tokenizer is given at once: few, as each of its matches costs more the more there are.
BLOCK = 48


@lru_cache(maxsize=1)
def _splitter() -> pre_tokenizers.Split:
    return pre_tokenizers.Split(Regex(UNIT), behavior="isolated")


class Units:
    """The units of a text: how many there are, and where each starts."""

    def __init__(self, text: str):
        self.text, self._split = text, _splitter().pre_tokenize_str
        self._ends = list(accumulate(len(self._offsets(at)) for at in range(0, len(text), BLOCK)))
        self.n = self._ends[-1] if self._ends else 0

    def _offsets(self, at: int) -> list[tuple[str, tuple[int, int]]]:
        return self._split(self.text[at : at + BLOCK])

    def start(self, rank: int) -> int:
        """Where unit ``rank`` starts; the end of the text for the rank after the last."""
        if rank == self.n:
            return len(self.text)
        block = bisect_right(self._ends, rank)
        inside = rank - (self._ends[block - 1] if block else 0)
        return block * BLOCK + self._offsets(block * BLOCK)[inside][1][0]


class Cut(NamedTuple):
    """A transformed text; the lengths are null for a plain one."""

    n: int
    form: str
    output: str
    prefix_chars: int | None
    middle_chars: int | None


def draws(seed: str, key: object) -> list[int]:
    """Four numbers below 2^32 from seed and id."""
    digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]


def cut(text: str, key: object, seed: str = "1", share: int = 90, spm_share: int = 20) -> Cut:
    """``text`` transformed: ``share`` percent of all texts are, and of these ``spm_share`` percent with the suffix first."""
    h1, h2, h3, h4 = draws(seed, key)
    units = Units(text)
    if not text or any(m in text for m in MARKERS) or h3 % 100 >= share:
        return Cut(units.n, "plain", text, None, None)
    low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.start(low), units.start(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_share:
        return Cut(units.n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", low, high - low)
    return Cut(units.n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", low, high - low)


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made from, by its markers alone."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, middle = output.removeprefix(first).split(MIDDLE)
    one, other = head.split(second)
    return one + middle + other if form == "psm" else other + middle + one


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """Without the cyclic collector, which the pairs of offsets would keep busy though none is part of a cycle."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", share: int = 90, spm_share: int = 20, digests_only: bool = False) -> DataFrame:
    """``(id_col, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256)`` for every row.

    ``n`` is the number of code points; ``restored_sha256`` the digest of the
    text rebuilt from ``output`` and ``form``. ``digests_only`` leaves ``output`` out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            with _uncollected():
                done = [cut(t, k, seed, share, spm_share) for t, k in zip(texts_of(part).to_pylist(), part.column("id").to_pylist(), strict=True)]
            columns = {
                id_col: part.column("id"),
                "n": pa.array([c.n for c in done], pa.int64()),
                "form": pa.array([c.form for c in done], pa.string()),
                "prefix_chars": pa.array([c.prefix_chars for c in done], pa.int64()),
                "middle_chars": pa.array([c.middle_chars for c in done], pa.int64()),
                "output_sha256": pa.array([_sha(c.output) for c in done], pa.string()),
                "restored_sha256": pa.array([_sha(restore(c.output, c.form)) for c in done], pa.string()),
            }
            if not digests_only:
                columns["output"] = pa.array([c.output for c in done], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = docs.schema[id_col].dataType.simpleString()
    more = "" if digests_only else ", output string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string{more}"
    )


def oracle_sql(table: str = "documents", seed: str = "1", share: int = 90, spm_share: int = 20) -> str:
    """The digests of :func:`transform` in DuckDB SQL."""
    draw = ", ".join(f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM {table}),
e AS (SELECT doc_id, t, length(t)::BIGINT AS n, {draw} FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {share} THEN 'plain'
    WHEN h4 % 100 < {spm_share} THEN 'spm' ELSE 'psm' END AS form FROM e),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
