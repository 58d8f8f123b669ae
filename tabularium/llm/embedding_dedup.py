"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors have a cosine of at least ``t`` if their squared distance is at
most ``2 - 2t``. Vectors are turned by a fixed random rotation, which spreads
every difference over all coordinates, and split into blocks of about
``BLOCK_DIMS`` coordinates. If all blocks of a pair were further apart than
their proportional share of the squared distance, so would the whole be; each
linked pair is therefore within the share of one block at least.

Candidates: of each block a vector's coordinates travel alone, rounded to 16
bits, with the radius widened by what the rounding can change. A grid over the
first coordinates, whose cells are as wide as the radius, sends them to their
own cell and to the neighbours on one side; the more vectors there are, the
more coordinates the grid has. There the block distance is computed for all
members within the radius in a further coordinate, and what is near in the block
is held against the whole radius by a sketch that comes along: all coordinates in
8 bits, scaled to the vector, with the length of what the rounding has changed,
so no link is lost. No pair is written: a cell returns as many edges as it takes
to connect what is near by both.

Verification: vectors that no block connects with another one are done. As
sketches are close (about 0.01 of distance for a pair), candidates are links but for pairs
just below the threshold, and their components hardly larger than those of the links.
The members of each component of the union of candidates come together once, as
they were given, and all their pairs are held against the threshold by cosines
of the unrotated vectors in double precision. Again no pair is written, but how
many links each vector has, and edges that connect what is linked.

Equal vectors are one class from the start. Members of a cell or component
beyond a fixed number are dealt into chunks that are compared two by two, so a
task holds one chunk and streams the others past it. That makes copies in
proportion to the chunks of one cell, so beyond ``CELL_ROWS`` vectors in a cell the
work grows faster than the input, as it must where a block's radius covers a
good part of the space.

Results defined for odd input: vectors that are null, empty, zero or have null
or non-finite components link with nothing; vectors of different lengths don't
link; repeated rows link with each other and give repeated result rows; a row
with a null id takes part, and its component's id is the smallest one there is
(null if there is none); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.llm.common import Scratch
from tabularium.llm.components import components
from tabularium.llm.simhash import Labels

BLOCK_DIMS = 16
#: Coordinates of a block that the grid may use.
GRID_DIMS = 4
#: Members of a chunk of a cell, and of a chunk of a component.
CELL_ROWS, COMPONENT_ROWS = 1 << 16, 4096
#: Rows and columns of a tile of distances.
TILE = (256, 8192)
#: Steps of a coordinate between 0 and 1.
STEPS = 32767
SEED = 7


class Space:
    """Rotation, blocks and radii for vectors of one length."""

    def __init__(self, dim: int, threshold: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        self.rotation = q * np.sign(np.diag(r))
        m = max(1, dim // BLOCK_DIMS)
        cut = [round(i * dim / m) for i in range(m + 1)]
        self.blocks = [slice(a, b) for a, b in zip(cut, cut[1:], strict=False)]
        #: How far apart linked vectors can be in each block: a little more for rounding, of doubles and to steps.
        sizes = [b.stop - b.start for b in self.blocks]
        self.radius = [np.sqrt((2 - 2 * threshold) * k / dim + 1e-9) + np.sqrt(k) / STEPS for k in sizes]
        #: How far apart linked vectors can be as a whole.
        self.reach = np.sqrt(2 - 2 * threshold + 1e-9)


@lru_cache(maxsize=8)
def space(dim: int, threshold: float, seed: int = SEED) -> Space:
    return Space(dim, threshold, seed)


def unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    # Scaled first: the squares of very large or small components leave the range of doubles.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sketched(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in steps of their own, and per row the step and the length of what rounding has changed."""
    step = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    whole = np.rint(x / step[:, None])
    changed = np.linalg.norm(x - whole * step[:, None], axis=1)
    return whole.astype(np.int8), np.stack([step, changed.astype(np.float32)], axis=1)


def _bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _rows(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """What ``_bytes`` was made from, for rows of one width."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _good(column: str) -> Column:
    """Whether a vector can link at all."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def _neighbours(dims: int) -> list[tuple[int, ...]]:
    """Steps to the cells on one side: of each two opposite ones the later."""
    return [step for step in product((-1, 0, 1), repeat=dims) if step > (0,) * dims]


def cells(classes: DataFrame, threshold: float, grid_dims: int, visits: bool) -> DataFrame:
    """``(dim, block, cell, visitor, along, no, part, whole, steps)``: each class once per block in its cell, with ``visits`` also in the neighbours on one side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                where = space(dim, threshold)
                turned = unit(_matrix(own.column("x"), dim)) @ where.rotation
                sketch = [_bytes(column) for column in sketched(turned)]
                x = np.rint(turned * STEPS).astype("<i2")
                n = len(x)
                for b, (block, radius) in enumerate(zip(where.blocks, where.radius, strict=True)):
                    part = np.ascontiguousarray(x[:, block])
                    used = min(grid_dims, part.shape[1])
                    grid = np.floor(part[:, :used] / (STEPS * radius)).astype(np.int64) + (1 << 13)
                    along = part[:, used] if part.shape[1] > used else np.zeros(n, dtype="<i2")
                    raw = _bytes(part)
                    for step in [(0,) * used, *(_neighbours(used) if visits else [])]:
                        cell = np.zeros(n, dtype=np.int64)
                        for k in range(used):
                            cell = (cell << 15) + grid[:, k] + step[k]
                        key = [np.full(n, dim, np.int32), np.full(n, b, np.int32), cell, np.full(n, any(step)), along.astype(np.int32)]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, key), own.column("no"), raw, *sketch], names=names)

    names = ["dim", "block", "cell", "visitor", "along", "no", "part", "whole", "steps"]
    return classes.select("no", "dim", "x").mapInArrow(run, "dim int, block int, cell long, visitor boolean, along int, no long, part binary, whole binary, steps binary")


def chunked(rows: DataFrame, key: list[str], large: DataFrame) -> DataFrame:
    """``rows`` with ``chunk``: members of the groups in ``large`` (key, chunks) belong to one and visit those before it; visitors go to all."""
    if large.isEmpty():
        return rows.withColumn("chunk", F.lit(0))
    dealt = rows.join(large, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    mine = F.pmod(F.xxhash64("no"), F.col("chunks")).cast("int")
    dealt = dealt.withColumn("mine", F.when(F.col("visitor"), F.col("chunks")).otherwise(mine))
    last = F.when(F.col("visitor"), F.col("chunks") - 1).otherwise(F.col("mine"))
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    return dealt.withColumn("visitor", F.col("chunk") != F.col("mine")).select(*rows.columns, "chunk")


def groups_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[bool, bool, pa.RecordBatch]]:
    """Batches cut where the key or ``visitor`` changes: whether a group starts, whether the rows are visitors, and the rows."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*key, "visitor"]], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            now = keys[a, :-1].tolist()
            yield now != last, bool(keys[a, -1]), batch.slice(a, b - a)
            last = now


class Home:
    """The members of a chunk at home. Visitors pass by; what is near is connected, and counted if it is asked for."""

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        self.no = table.column("no").to_numpy()
        self.load(table)
        self.labels = Labels(len(self.no))
        self.found: list[np.ndarray] = []
        for a in range(0, len(self.no), TILE[0]):
            self._pass(self.no[a : a + TILE[0]], self.rows(a, a + TILE[0]), a)

    def visit(self, batch: pa.RecordBatch) -> None:
        guests = type(self).__new__(type(self))
        guests.load(pa.Table.from_batches([batch]))
        no = batch.column("no").to_numpy()
        for a in range(0, len(no), TILE[0]):
            self._pass(no[a : a + TILE[0]], guests.rows(a, a + TILE[0]), None)

    def _pass(self, no: np.ndarray, rows: tuple, at: int | None) -> None:
        """Compare ``rows`` with the members, those after them if the rows are members from ``at`` on."""
        host = np.full(len(no), -1)
        low, high = self.reach(rows)
        for c in range(low if at is None else max(low, at), high, TILE[1]):
            d = min(c + TILE[1], high)
            near = self.near(rows, c, d)
            if at is not None and c < at + len(no):
                near &= np.arange(c, d) > (at + np.arange(len(no)))[:, None]
            self.count(no, rows, near, c, d, at)
            if at is not None:
                # A member is its own host.
                new = near & (self.labels.of[c:d] != self.labels.of[at : at + len(no), None])
                i, j = np.nonzero(new)
                self.labels.link(i + at, j + c)
                continue
            known = np.where(host < 0, -1, self.labels.of[host])
            i, j = np.nonzero(near & (self.labels.of[c:d] != known[:, None]))
            if len(i):
                fresh, first = np.unique(i, return_index=True)
                host[fresh] = np.where(host[fresh] < 0, j[first] + c, host[fresh])
                self.labels.link(host[i], j + c)
        if at is None:
            guests = np.flatnonzero(host >= 0)
            self.found.append(np.stack([np.ones(len(guests), dtype=np.int64), no[guests], self.no[host[guests]]]))

    def count(self, no: np.ndarray, rows: tuple, near: np.ndarray, c: int, d: int, at: int | None) -> None:
        pass

    def edges(self) -> np.ndarray:
        below = np.flatnonzero(self.labels.of != np.arange(len(self.no)))
        own = np.stack([np.ones(len(below), dtype=np.int64), self.no[below], self.no[self.labels.of[below]]])
        return np.concatenate([own, *self.found], axis=1)


class CellHome(Home):
    """Members of a cell, sorted by a coordinate, with those of one block and a sketch of all."""

    threshold = 0.0

    def load(self, table: pa.Table) -> None:
        dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
        where = space(dim, self.threshold)
        self.radius = where.radius[block]
        self.part = _rows(table.column("part"), "<i2").astype(np.float32) / STEPS
        self.norm = (self.part**2).sum(axis=1)
        self.along = table.column("along").to_numpy() / STEPS
        self.whole, self.bound = _rows(table.column("whole"), "i1"), where.reach
        self.step, self.changed = _rows(table.column("steps"), "<f4").T
        self.length = np.einsum("ij,ij->i", self.whole, self.whole, dtype=np.int64).astype(np.float32) * self.step**2

    def rows(self, a: int, b: int) -> tuple:
        return self.part[a:b], self.norm[a:b], self.along[a:b], self.whole[a:b], self.step[a:b], self.changed[a:b], self.length[a:b]

    def reach(self, rows: tuple) -> tuple[int, int]:
        r = self.radius + 1e-6
        return int(np.searchsorted(self.along, rows[2][0] - r)), int(np.searchsorted(self.along, rows[2][-1] + r, side="right"))

    def near(self, rows: tuple, c: int, d: int) -> np.ndarray:
        # Single precision, with room for its rounding.
        distance = rows[0] @ self.part[c:d].T
        distance *= -2
        distance += self.norm[c:d]
        distance += rows[1][:, None]
        near = distance <= self.radius**2 + 1e-5
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if len(i):
            near[np.ix_(i, j)] &= self.whole_near([r[i] for r in rows[3:]], j + c)
        return near

    def whole_near(self, rows: list, j: np.ndarray) -> np.ndarray:
        whole, step, changed, length = rows
        distance = (whole.astype(np.float32) * (-2 * step[:, None])) @ (self.whole[j].astype(np.float32) * self.step[j, None]).T
        distance += self.length[j]
        distance += length[:, None]
        return distance <= (self.bound + changed[:, None] + self.changed[j]) ** 2 + 1e-5


class ComponentHome(Home):
    """Members of a component of candidates, with their unit vectors."""

    threshold = 0.0

    def load(self, table: pa.Table) -> None:
        self.size = table.column("size").to_numpy().astype(np.float64)
        self.x = unit(_matrix(table.column("x").combine_chunks(), table.column("dim")[0].as_py()))
        self.links = np.zeros(len(self.x))

    def rows(self, a: int, b: int) -> tuple:
        return self.x[a:b], self.size[a:b]

    def reach(self, rows: tuple) -> tuple[int, int]:
        return 0, len(self.no)

    def near(self, rows: tuple, c: int, d: int) -> np.ndarray:
        cosine = rows[0] @ self.x[c:d].T
        near = cosine >= self.threshold
        # Close to the threshold the order of a sum decides: there each pair is summed by itself.
        i, j = np.nonzero(np.abs(cosine - self.threshold) < 1e-12)
        near[i, j] = np.einsum("ij,ij->i", rows[0][i], self.x[c + j]) >= self.threshold
        return near

    def count(self, no: np.ndarray, rows: tuple, near: np.ndarray, c: int, d: int, at: int | None) -> None:
        self.links[c:d] += rows[1] @ near
        mine = near @ self.size[c:d]
        if at is not None:
            self.links[at : at + len(no)] += mine
        else:
            self.found.append(np.stack([np.zeros(len(no), dtype=np.int64), no, mine.astype(np.int64)])[:, mine > 0])

    def edges(self) -> np.ndarray:
        linked = np.flatnonzero(self.links)
        counts = np.stack([np.zeros(len(linked), dtype=np.int64), self.no[linked], self.links[linked].astype(np.int64)])
        return np.concatenate([counts, super().edges()], axis=1)


def compare(rows: DataFrame, key: list[str], order: list[str], kind: type[Home], threshold: float) -> DataFrame:
    """``(edge, a, b)`` of all groups of ``rows``: edges between ``a`` and ``b``, or of ``a`` a partial count ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home_kind = type(kind.__name__, (kind,), {"threshold": threshold})
        waiting: list[pa.RecordBatch] = []
        home: Home | None = None

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal home
            if waiting:
                home = home_kind(waiting)
                waiting.clear()
            if home:
                edge, a, b = home.edges()
                yield pa.RecordBatch.from_arrays([pa.array(edge.astype(bool)), pa.array(a.copy()), pa.array(b.copy())], names=["edge", "a", "b"])
            home = None

        for starts, visitor, part in groups_of(batches, key):
            if starts:
                yield from told()
            if not visitor:
                waiting.append(part)
                continue
            if waiting:
                home = home_kind(waiting)
                waiting.clear()
            if home:
                home.visit(part)
        yield from told()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, *key).sortWithinPartitions(*key, "visitor", *order)
    return dealt.mapInArrow(run, "edge boolean, a long, b long")


def candidates(spark: SparkSession, classes: DataFrame, threshold: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(a, b)``: edges that connect all classes that some block finds near."""
    scratch = Scratch(spark, "cells")
    n, grid_dims = classes.count(), 1
    while grid_dims < GRID_DIMS and n / 2.5**grid_dims > cell_rows:
        grid_dims += 1
    at = ["dim", "block", "cell"]
    sizes = cells(classes, threshold, grid_dims, visits=False).groupBy(*at).count().where(F.col("count") > cell_rows)
    large = scratch.write(sizes.select(*at, F.ceil(F.col("count") / cell_rows).cast("int").alias("chunks")), "large")
    sent = chunked(cells(classes, threshold, grid_dims, visits=True), at, large)
    return compare(sent, [*at, "chunk"], ["along", "no"], CellHome, threshold).select("a", "b")


def link_classes(spark: SparkSession, classes: DataFrame, threshold: float, cell_rows: int = CELL_ROWS, component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """``(edge, a, b)``: for links of class ``a`` a partial count ``b``, and edges that connect what is linked."""
    scratch = Scratch(spark, "candidates")
    near = components(spark, candidates(spark, classes, threshold, cell_rows))
    members = classes.join(near, classes["no"] == near["node"]).select(F.col("label").alias("component"), F.lit(False).alias("visitor"), "no", "size", "dim", "x")
    members = scratch.write(members, "members")
    sizes = members.groupBy("component").count().where(F.col("count") > component_rows)
    large = scratch.write(sizes.select("component", F.ceil(F.col("count") / component_rows).cast("int").alias("chunks")), "large")
    return compare(chunked(members, ["component"], large), ["component", "chunk"], ["no"], ComponentHome, threshold)


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row."""
    scratch = Scratch(spark, "vectors")
    kind = vectors.schema[vector_col].dataType.elementType
    kind = kind if isinstance(kind, T.FloatType) else T.DoubleType()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(T.ArrayType(kind)).alias("x"))
    good = rows.where(_good("x")).select("id", F.transform("x", lambda v: v + F.lit(0.0).cast(kind)).alias("x"))  # -0.0 becomes 0.0
    # Equal vectors are told by 128 bits of hashes, so that vectors needn't travel to be joined.
    key = ["key", "key2"]
    keyed = good.select("id", "x", F.xxhash64("x").alias("key"), F.xxhash64(F.lit("x"), "x").alias("key2"))
    grouped = keyed.groupBy(*key).agg(F.count("*").alias("size"), F.min("id").alias("least"), F.any_value("x").alias("x"))
    classes = scratch.write(grouped.select(F.monotonically_increasing_id().alias("no"), *key, "size", "least", F.size("x").alias("dim"), "x"), "classes")
    found = scratch.write(link_classes(spark, classes.select("no", "size", "dim", "x"), threshold), "found")
    counts = found.where(~F.col("edge")).groupBy(F.col("a").alias("no")).agg(F.sum("b").alias("links"))
    labels = components(spark, found.where("edge").select("a", "b"))
    named = classes.drop("x").join(labels, classes["no"] == labels["node"], "left").withColumn("label", F.coalesce("label", "no"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "label").join(counts, "no", "left").select(*key, "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    linked = keyed.select("id", *key).join(named, key).select("id", "n_links", "component_id")
    alone = rows.where(~_good("x")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
