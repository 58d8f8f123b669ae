"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.common import Scratch


def _fingerprint(edges: DataFrame) -> tuple[int, int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)).alias("h"),
        F.count_if(F.col("shared")).alias("left"),
    ).first()
    return row["n"], int(row["h"]), row["left"]


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, label)`` for every node of an edge; ``label`` is the smallest node that it reaches.

    Alternating small and large stars: each round hangs a node's neighbours
    below the smallest one it knows, which needs O(log^2 n) rounds whatever
    the shape. Minima are aggregated before the shuffle, so a node with a
    third of all edges sends one row per task; the joins have one row for a
    key on one side, so that adaptive execution can split a hot key on the
    other. Rounds are written to the shared folder. Loops and null ends are
    ignored, repeated edges count once; no edges give no rows.
    """
    scratch = Scratch(spark, "components")
    links = (
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).isNull() | F.col(b).isNull() | (F.col(a) == F.col(b)))
        .toDF("hi", "lo", "bad")
        .where(~F.col("bad"))
        .select("hi", "lo")
        .distinct()
    )
    links = scratch.write(links.withColumn("shared", F.lit(True)), "0")
    seen = None
    for k in range(1, max_rounds + 1):
        # Small star: of its smaller neighbours a node keeps the smallest; the others go below that one.
        least = links.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            links.join(least, "hi")
            .select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        # Large star: larger neighbours go below the smallest node known to their neighbour, which is its own parent if it has one.
        parent = small.groupBy(F.col("hi").alias("mid")).agg(F.min("lo").alias("m"))
        large = small.join(parent, small["lo"] == parent["mid"], "left").select(small["hi"], F.coalesce("m", small["lo"]).alias("lo")).distinct()
        # A star forest: every node has one parent, and no parent has one.
        heads = large.groupBy("hi").agg(F.count("*").alias("n"))
        state = large.join(heads, "hi").select("hi", "lo", (F.col("n") > 1).alias("many"))
        inner = heads.select(F.col("hi").alias("lo"), F.lit(True).alias("deep"))
        state = state.join(inner, "lo", "left").select("hi", "lo", (F.col("many") | F.coalesce("deep", F.lit(False))).alias("shared"))
        links = scratch.write(state, str(k))
        now = _fingerprint(links)
        scratch.drop(str(k - 1))
        if now[2] == 0 or now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components have not settled")
    ends = links.select("hi", "lo")
    return ends.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(ends.select("lo", "lo").distinct())
