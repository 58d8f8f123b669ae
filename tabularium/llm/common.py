"""What the training-data operators share: scratch tables, text batches and word splitting.

All helpers take whole texts. Batches are cut by bytes, never by dropping
rows, so the memory of a task is bounded by ``SLICE_BYTES`` or by its longest text.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import bound_batches as bound_batches

#: Bytes of text that a task works on at once.
SLICE_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset (tests, one machine), a new temporary one."""
    context = spark.sparkContext
    at = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabularium-"))
        at = context.getCheckpointDir()
    return at.rstrip("/")


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted``, each with as many underscores before it as it takes to differ from all of ``taken``, whatever their case."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """Tables written to the shared folder. They cut lineage, so a lost executor costs no more than its own tasks.

    What an operator has used up it drops itself. A result is read from tables
    that must outlive the call: ``Scratch.clear`` removes those once the results are written.
    """

    made: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        bound_batches(spark)
        Scratch.made.append(self)

    @classmethod
    def clear(cls) -> None:
        """Remove all tables of all operators. Data frames made by them can't be read any more."""
        while cls.made:
            one = cls.made.pop()
            _delete(one.spark, one.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        schema = df.schema
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, self.path(name))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release() -> None:
    """Give freed memory back: a Python worker serves one task after another, and its allocators keep what the largest took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices whose ``column`` holds up to ``limit`` bytes, or one longer text; small batches are put together."""
    held: list[pa.RecordBatch] = []
    room = limit
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at] - sizes[at]
            to = max(int(np.searchsorted(ends, before + room, side="right")), at + (not held))
            if to > at:
                held.append(batch.slice(at, to - at))
                room -= int(ends[to - 1] - before)
                at = to
            if at < batch.num_rows:
                yield _together(held)
                release()
                held, room = [], limit
    if held:
        yield _together(held)
        release()


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def array_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Texts in order, null read as empty, in slices of about ``limit`` bytes."""
    for part in text_slices([pa.RecordBatch.from_arrays([texts], names=["text"])], limit=limit):
        yield texts_of(part)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a batch, null read as empty."""
    return pc.fill_null(batch.column(column), "")


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts: text ``i`` has ``codes[starts[i]:starts[i + 1]]``, indices into ``types``."""

    codes: np.ndarray
    starts: np.ndarray
    types: pa.Array

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def split_words(texts: pa.Array) -> Words:
    """Split non-null texts at ASCII white space, and number the distinct words."""
    parts = pc.ascii_split_whitespace(texts)
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    owner = np.repeat(np.arange(len(texts)), lengths)[full]
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64)
    words = flat.filter(pa.array(full)).dictionary_encode()
    return Words(words.indices.to_numpy(zero_copy_only=False), starts, words.dictionary)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``; an empty segment has zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), dtype=np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def codepoints(types: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings one after another, and where each string starts (one more entry than strings)."""
    lengths = pc.utf8_length(types).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(types.to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x81DADEF4BC2DD44D)
        x ^= x >> np.uint64(33)
    return x


def ragged_take(flat: np.ndarray, starts: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of parts ``flat[starts[i]:starts[i + 1]]``, those numbered ``items`` one after another, and the length of each."""
    lengths = (starts[1:] - starts[:-1])[items]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts[:-1][items] - (ends - lengths), lengths)
    return flat[at], lengths


@dataclass
class Pieces:
    """Matches of a pattern in several texts: text ``i`` has ``codes[starts[i]:starts[i + 1]]``, indices into ``distinct``."""

    codes: np.ndarray
    starts: np.ndarray
    distinct: list[str]


def split_pieces(texts: list[str], find) -> Pieces:
    """Number the pieces that ``find`` (text to list of pieces) gives for each text."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    codes, sizes = [], [0]
    for text in texts:
        found = find(text)
        codes.append(np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found)))
        sizes.append(len(found))
    return Pieces(np.concatenate([np.zeros(0, dtype=np.int32), *codes]), np.cumsum(sizes, dtype=np.int64), list(number))


def char_ngrams(types: pa.Array, orders: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order: ``(order, type, hash)`` of every character n-gram of the words, each framed by one space on both sides."""
    framed = pc.binary_join_element_wise("", types, "", " ") if len(types) else types
    points, starts = codepoints(framed)
    owner = np.repeat(np.arange(len(types)), np.diff(starts))
    rolled = np.zeros(len(points), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for order in range(1, orders.stop):
            if order > len(points):
                return
            n = len(points) - order + 1
            rolled = rolled[:n] * np.uint64(0x100000001B3) + points[order - 1 :].astype(np.uint64) + np.uint64(1)
            if order >= orders.start:
                inside = owner[:n] == owner[order - 1 :]
                yield order, owner[:n][inside], mix64(rolled[inside] + np.uint64(order) * np.uint64(0x9E3779B97F4A7C15))


def sampled(docs: DataFrame, id_col: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the id: the same ones wherever and however often it runs."""
    share = min(1.0, rows / max(1, total))
    return docs if share == 1.0 else docs.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) < int(share * (1 << 30)))
