"""A session with the settings that the operators are meant for. None of them changes a result."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch on its way to a Python worker; Spark's own limit would let thousands of long texts through at once.
BATCH_BYTES = 4 << 20


def build_session(name: str = "tabularium", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew joins, Arrow batches, UTC. ``conf``: further settings, dots written as ``__``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``, which must be set on a cluster; a temporary one is taken where there is one machine."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tabularium-"))
    return f"{context.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and kept in the folder of ``spark.checkpoint.dir``, its lineage cut.

    What several plans are made from is settled first, so that it isn't computed
    again for each. Where no folder is set (tests, one machine) a new temporary one is taken.
    """
    shared_folder(frame.sparkSession, "settled")
    return frame.checkpoint()


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys``, over all cores.

    A small file is read by one task or a few, which then do all that its rows
    are made into: documents are many times larger than the compressed rows they
    are rendered from. Narrow rows are dealt before that.
    """
    return rows.repartition(*keys)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` into parts that stay apart, several for each core, for work that takes much longer than its rows are large."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def bound_batches(spark: SparkSession) -> None:
    """Let the session bound Arrow batches by ``BATCH_BYTES``, unless its own bound is lower."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(name).lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)
