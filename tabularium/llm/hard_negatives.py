"""Hard-negative mining by blocked dense products.

Each component ``x`` of a vector becomes ``floor(scale * x)`` as a double, so
scores are inner products of integers, which doubles hold exactly below 2^53.
Vectors of one length are packed into blocks, a matrix each, and written once.
Anchors are packed into blocks of their own and sent to every task, a round of
at most ``ROUND_BYTES`` at a time; a task multiplies the anchor blocks with the
candidate blocks that it reads. Candidates never travel.

First pass: a task keeps the best rows of an anchor's label as it reads, and
returns its best few per anchor; those of all tasks merge to the anchor's
positives. Second pass: the products are made again, and for each positive the
best rows of other labels are kept whose score lies between ``low`` percent of
the positive's and the positive's. What tasks return grows with anchors times
tasks, not with the rows.

Results defined for odd input: a null label, a null vector or one with null or
non-finite components takes no part; vectors of different lengths have no
score, those without components score zero with each other; repeated rows are
different rows, whether as anchors, positives or negatives; equal scores are
ordered by id, those of equal ids by their place in the blocks; rows with a
null id take part as positives and negatives, after all others of their score;
the id 2^63 - 1 is reserved; where products could leave the exact range of
doubles they are made of Python's integers, and scores beyond 2^63 - 2 count as
that; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabularium.llm.common import Scratch, release

#: Bytes of a block of candidates; rows of a block of anchors; bytes of the anchors that are sent to all tasks at once.
BLOCK_BYTES, ANCHOR_ROWS, ROUND_BYTES = 2 << 20, 1024, 64 << 20
#: Anchors of a tile of scores.
TILE = 256
#: Found rows of an anchor block that a task holds before it keeps the best of them only.
HELD_ROWS = 1 << 16
NO_ID = np.iinfo(np.int64).max
#: The largest score; what is beyond counts as this.
MOST = int(NO_ID) - 1
#: Scores below this stay exact when they are compared as percentages.
EXACT = 2.0**53 / 128

BLOCK = "dim int, n int, ids binary, labels binary, anchors binary, x binary"
ANCHOR = "block long, pos int, dim int, id long, label long, x binary"


def _good(x: Column) -> Column:
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~bad


def _pack(rows: DataFrame, scale: int) -> DataFrame:
    """Rows ``(id, label, anchor, x)`` in blocks of vectors of one length."""

    def block(held: list[pa.RecordBatch], dim: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        x = np.floor(table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        ids = table.column("id").fill_null(NO_ID).to_numpy()
        columns = [dim, len(ids), ids.tobytes(), table.column("label").to_numpy().tobytes(), table.column("anchor").to_numpy().tobytes(), x.tobytes()]
        names = [f.split()[0] for f in BLOCK.split(", ")]
        return pa.RecordBatch.from_pylist([dict(zip(names, columns, strict=True))], schema=pa.schema(list(zip(names, [pa.int32(), pa.int32(), *[pa.binary()] * 4], strict=True))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own, most = batch.filter(pa.array(dims == dim)), max(1, BLOCK_BYTES // (8 * max(1, dim)))
                at = 0
                while at < own.num_rows:
                    take = min(own.num_rows - at, most - sizes.get(dim, 0))
                    held.setdefault(dim, []).append(own.slice(at, take))
                    sizes[dim] = sizes.get(dim, 0) + take
                    at += take
                    if sizes[dim] == most:
                        yield block(held.pop(dim), dim)
                        del sizes[dim]
            # Vectors of very many lengths don't fill their blocks: what is held in all is bounded too.
            while sum(d * n for d, n in sizes.items()) * 8 > 8 * BLOCK_BYTES:
                dim = max(sizes, key=lambda d: d * sizes[d])
                del sizes[dim]
                yield block(held.pop(dim), dim)
        for dim, own in held.items():
            yield block(own, dim)
        release()

    return rows.select("id", "label", "anchor", F.size("x").alias("dim"), "x").mapInArrow(run, BLOCK)


def _anchors(blocks: DataFrame) -> DataFrame:
    """The anchors of all blocks, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ANCHOR.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                pick = np.flatnonzero(np.frombuffer(row["anchors"], dtype=bool))
                x = np.frombuffer(row["x"]).reshape(row["n"], row["dim"])[pick]
                columns = [
                    pa.array(np.full(len(pick), row["block"])),
                    pa.array(pick.astype(np.int32)),
                    pa.array(np.full(len(pick), row["dim"], dtype=np.int32)),
                    pa.array(np.frombuffer(row["ids"], dtype=np.int64)[pick]),
                    pa.array(np.frombuffer(row["labels"], dtype=np.int64)[pick]),
                    pa.array([one.tobytes() for one in x], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.mapInArrow(run, ANCHOR)


class AnchorBlocks:
    """Anchors in blocks, which are read a round at a time."""

    def __init__(self, anchors: DataFrame, scratch: Scratch, name: str, round_bytes: int):
        """``anchors`` with ``tops``, the scores of their positives (empty in the first pass)."""
        size = anchors.agg(F.count("*"), F.max("dim")).first()
        groups, self.row_bytes = -(-(size[0] or 0) // ANCHOR_ROWS) or 1, 8 * (size[1] or 0) + 80
        per_round = max(1, round_bytes // (ANCHOR_ROWS * self.row_bytes))
        group = F.pmod(F.xxhash64("block", "pos"), F.lit(groups)).cast("int")
        self.rounds, self.round_bytes = -(-groups // per_round), round_bytes
        dealt = anchors.withColumn("group", group).repartition("group").sortWithinPartitions("group", "dim")
        packed = dealt.mapInArrow(_pack_anchors, "group int, dim int, a_n int, a_rows binary, a_labels binary, a_x binary, a_tops binary")
        self.packed = scratch.write(packed.withColumn("round", F.floor(F.col("group") / per_round).cast("int")), name)

    def each(self) -> Iterator[DataFrame]:
        sizes = self.packed.groupBy("round").agg(F.sum(F.length("a_x") + F.length("a_tops") + F.length("a_rows")).alias("bytes"))
        most = sizes.agg(F.max("bytes")).first()[0] or 0
        for k in range(self.rounds):
            one = self.packed.where(F.col("round") == k).withColumnRenamed("dim", "a_dim")
            # Groups are dealt by a hash and about equal; were a round larger than it should be, Spark would choose the join.
            yield F.broadcast(one) if most <= 2 * self.round_bytes else one


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def told() -> pa.RecordBatch:
        rows = np.array([(r["block"], r["pos"], r["id"]) for r in held], dtype=np.int64)
        out = {
            "group": held[0]["group"],
            "dim": held[0]["dim"],
            "a_n": len(held),
            "a_rows": rows.tobytes(),
            "a_labels": np.array([r["label"] for r in held], dtype=np.int64).tobytes(),
            "a_x": b"".join(r["x"] for r in held),
            "a_tops": np.array([r["tops"] for r in held], dtype=np.int64).tobytes(),
        }
        kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_pylist([out], schema=pa.schema(list(zip(out, kinds, strict=True))))

    for batch in batches:
        for row in batch.to_pylist():
            if held and (len(held) == 2 * ANCHOR_ROWS or (row["group"], row["dim"]) != (held[0]["group"], held[0]["dim"])):
                yield told()
                held = []
            held.append(row)
    if held:
        yield told()


class Found:
    """Rows found for the anchors of a block: the best ``k`` for each anchor and slot."""

    def __init__(self, k: int):
        self.k, self.parts, self.rows = k, [], 0

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, block: int, pos: np.ndarray) -> None:
        self.parts.append((anchor, slot, score, ids, np.full(len(anchor), block), pos))
        self.rows += len(anchor)
        if self.rows > HELD_ROWS:
            best = self.best()
            self.parts, self.rows = [best], len(best[0])

    def best(self) -> tuple[np.ndarray, ...]:
        if any(p[2].dtype == object for p in self.parts):
            self.parts = [(*p[:2], np.array([int(s) for s in p[2]], dtype=object), *p[3:]) for p in self.parts]
        anchor, slot, score, ids, block, pos = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        if score.dtype == object:
            order = np.array(sorted(range(len(score)), key=lambda i: (anchor[i], slot[i], -score[i], ids[i], block[i], pos[i])), dtype=np.int64)
        else:
            order = np.lexsort((pos, block, ids, -score, slot, anchor))
        group = np.stack([anchor[order], slot[order]])
        starts = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(axis=0)]))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
        order = order[place < self.k]
        return anchor[order], slot[order], score[order], ids[order], block[order], pos[order]


def _products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: as doubles where these can't round, otherwise of Python's integers."""
    most = (np.abs(a).max(initial=0.0) * np.abs(x).max(initial=0.0)) * a.shape[1]
    if most < EXACT:
        return a @ x.T
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (a, x)]
    out = whole[0] @ whole[1].T
    return np.array([[min(max(v, -MOST), MOST) for v in row] for row in out], dtype=object).reshape(out.shape)


def _best_of(score: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(row, column)`` of the ``k`` highest fitting scores of each row, with all that tie with the last of them."""
    if score.dtype == object:
        fits = fits.astype(bool)
        for i in np.flatnonzero(fits.sum(axis=1) > k):
            at = np.flatnonzero(fits[i])
            least = min(heapq.nlargest(k, score[i, at].tolist()))
            fits[i, at] = [v >= least for v in score[i, at]]
        return np.nonzero(fits)
    many = np.flatnonzero(fits.sum(axis=1) > k)
    if len(many):
        masked = np.where(fits[many], score[many], -np.inf)
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        fits[many] &= score[many] >= least[:, None]
    return np.nonzero(fits)


def _search(pairs: DataFrame, k: int, low: int | None) -> DataFrame:
    """The best ``k`` rows of each task: of an anchor's label, or with ``low`` of other labels in the window below each positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[np.ndarray, Found]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                rows = np.frombuffer(row["a_rows"], dtype=np.int64).reshape(-1, 3)
                key = (row["group"], row["a_dim"], rows[0, 0], rows[0, 1])
                if key not in found:
                    found[key] = (rows, Found(k))
                _compare(row, rows, found[key][1], k, low)
        for rows, kept in found.values():
            if not kept.parts:
                continue
            anchor, slot, score, ids, block, pos = kept.best()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*rows[anchor].T.copy(), slot.astype(np.int32), score.astype(np.int64), ids, block.astype(np.int64), pos.astype(np.int32))],
                names=["a_block", "a_pos", "anchor_id", "slot", "score", "id", "block", "pos"],
            )
        release()

    return pairs.mapInArrow(run, "a_block long, a_pos long, anchor_id long, slot int, score long, id long, block long, pos int")


def _compare(row: dict, rows: np.ndarray, found: Found, k: int, low: int | None) -> None:
    """Score the anchors of a pair of blocks against its candidates."""
    a = np.frombuffer(row["a_x"]).reshape(row["a_n"], row["a_dim"])
    x = np.frombuffer(row["x"]).reshape(row["n"], row["dim"])
    labels, ids = np.frombuffer(row["labels"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)
    own = np.frombuffer(row["a_labels"], dtype=np.int64)
    tops = np.frombuffer(row["a_tops"], dtype=np.int64).reshape(row["a_n"], -1)
    for at in range(0, row["a_n"], TILE):
        part = slice(at, at + TILE)
        score = _products(a[part], x)
        same = own[part, None] == labels
        if low is None:
            mine = np.flatnonzero(rows[part, 0] == row["block"])
            same[mine, rows[part, 1][mine]] = False
            i, j = _best_of(score, same, k)
            found.add(i + at, np.zeros(len(i), dtype=np.int64), score[i, j], ids[j], row["block"], j)
            continue
        percent = 100 * score
        for slot in range(tops.shape[1]):
            top = tops[part, slot, None]
            # Scores that are doubles are below EXACT: against them a rounded percentage of a higher one is just as good.
            top_as = top.astype(object if score.dtype == object else np.float64)
            fits = (~same) & (score <= top_as) & (percent >= low * top_as)
            i, j = _best_of(score, fits & (top != NO_ID), k)
            found.add(i + at, np.full(len(i), slot), score[i, j], ids[j], row["block"], j)


def _first(rows: DataFrame, k: int, key: list[str]) -> DataFrame:
    """The best ``k`` rows of what all tasks have found for a key, with ``place`` from 1."""
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), "id", "block", "pos")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _passes(blocks: DataFrame, anchors: AnchorBlocks, k: int, low: int | None) -> DataFrame:
    out = None
    for one in anchors.each():
        found = _search(blocks.drop("anchors").join(one, blocks["dim"] == one["a_dim"]), k, low)
        out = found if out is None else out.unionByName(found)
    return out


def mine(
    spark: SparkSession,
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id ``is_anchor`` accepts. Of each anchor's best
    ``positives`` rows of its label, every one comes with up to ``negatives``
    rows of other labels that score at most as high, and ``low`` percent of it at least.
    """
    scratch = Scratch(spark, "negatives")
    kind = vectors.schema[vector_col].dataType.elementType
    kind = kind if isinstance(kind, (T.FloatType, T.DoubleType)) else T.DoubleType()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast(T.ArrayType(kind)).alias("x"))
    rows = rows.where(F.col("label").isNotNull() & _good(F.col("x"))).withColumn("anchor", F.coalesce(is_anchor(F.col("id")), F.lit(False)))
    blocks = scratch.write(_pack(rows, scale).withColumn("block", F.monotonically_increasing_id()), "blocks")
    anchors = scratch.write(_anchors(blocks), "anchors")
    first = AnchorBlocks(anchors.withColumn("tops", F.array().cast("array<long>")), scratch, "first", round_bytes)
    best = _first(_passes(blocks, first, positives, None), positives, ["a_block", "a_pos"])
    best = scratch.write(best.select("a_block", "a_pos", "anchor_id", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # The scores of an anchor's positives by slot; a slot without one holds the reserved number.
    slots = [F.coalesce(F.max(F.when(F.col("slot") == s, F.col("positive_score"))), F.lit(int(NO_ID))) for s in range(positives)]
    tops = best.groupBy(F.col("a_block").alias("block"), F.col("a_pos").cast("int").alias("pos")).agg(F.array(*slots).alias("tops"))
    second = AnchorBlocks(anchors.join(tops, ["block", "pos"]), scratch, "second", round_bytes)
    worst = _first(_passes(blocks, second, negatives, low), negatives, ["a_block", "a_pos", "slot"])
    worst = worst.select("a_block", "a_pos", "slot", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = lambda c: F.nullif(F.col(c), F.lit(int(NO_ID))).alias(c)
    return worst.join(best, ["a_block", "a_pos", "slot"]).select("anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")

