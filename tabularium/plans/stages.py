"""Finished stages, kept from run to run and reused only where nothing that they are made from has changed.

A stage's key is a hash of its name, its version, its options and the keys of its
inputs. The key of a table that comes from outside is a hash of its rows,
whatever their order and partitions; it takes one pass over them. A changed option
or row thus changes the keys of what depends on it and no others.

A stage is finished when the manifest has a row that names its folder, which is
written after the data. What a broken run leaves behind has no such row and is
never read; each attempt has a folder of its own, so runs at the same time don't
meet, and of two that finish one stage the first one's data is used.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, key string, path string, options string, inputs array<string>, finished double"
#: Times to the microsecond; what is null is told apart from what is missing.
_AS_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@dataclass
class Kept:
    """A table and its key."""

    frame: DataFrame
    key: str


def content_key(frame: DataFrame) -> str:
    """A hash of the schema and of all rows as a multiset: sums of two hashes a row, which combine before they are shuffled.

    Rows are hashed as JSON, so maps, which have no hash of their own, can be
    columns; a map whose entries come in another order counts as changed. Column
    order and partitions don't count.
    """
    names = sorted(frame.columns)
    row = F.to_json(F.struct(*(F.col(f"`{n}`") for n in names)), _AS_JSON)
    hashes = [F.sum(F.xxhash64(F.lit(k), "row").cast("decimal(28,0)")) for k in (1, 2)]
    count, *sums = frame.select(row.alias("row")).agg(F.count("*"), *hashes).first()
    types = [[n, frame.schema[n].dataType.simpleString()] for n in names]
    return _hash([types, count, [str(s) for s in sums]])


def _hash(what: Any) -> str:
    return hashlib.sha256(json.dumps(what, sort_keys=True).encode()).hexdigest()[:32]


class Stages:
    """Stages below ``root``, a folder that the driver and all executors share. ``force`` names stages that are computed whatever is there."""

    def __init__(self, spark: SparkSession, root: str, force: tuple[str, ...] = ()):
        self.spark, self.root, self.force = spark, root.rstrip("/"), set(force)
        #: ``(name, key, reused)`` of this run, in order.
        self.told: list[tuple[str, str, bool]] = []

    def source(self, frame: DataFrame) -> Kept:
        """A table from outside, with the key of its rows."""
        return Kept(frame, content_key(frame))

    def manifest(self) -> DataFrame:
        """``MANIFEST``: a row for each time that a stage was finished."""
        at = f"{self.root}/manifest"
        # Whether there is a manifest yet is asked of the file system that the path belongs to.
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(MANIFEST).json(at) if there else self.spark.createDataFrame([], MANIFEST)

    def stage(self, name: str, make: Callable[..., DataFrame], *inputs: Kept, options: dict | None = None, version: str = "1") -> Kept:
        """``make(*frames, **options)``, or what an earlier run has made of the same. ``options`` are what JSON can say; ``version`` stands for the code."""
        return self.keep(name, lambda: make(*(i.frame for i in inputs), **(options or {})), *(i.key for i in inputs), options=options, version=version)

    def keep(self, name: str, make: Callable[[], DataFrame], *keys: str, options: dict | None = None, version: str = "1") -> Kept:
        """Like ``stage``, of a function that has its inputs already; ``keys`` stand for them."""
        key = _hash([name, version, options or {}, list(keys)])
        done = None if name in self.force else self.manifest().where((F.col("name") == name) & (F.col("key") == key)).agg(F.min_by("path", F.struct("finished", "path"))).first()[0]
        self.told.append((name, key, done is not None))
        if done is None:
            done = f"{self.root}/{name}/{key}-{uuid.uuid4().hex[:12]}"
            make().write.parquet(done)
            # A forced stage comes before what it replaces.
            finished = -time.time() if name in self.force else time.time()
            row = (name, key, done, json.dumps(options or {}, sort_keys=True), list(keys), finished)
            self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return Kept(self.spark.read.parquet(done), key)
