"""Row numbers within groups of any size.

A window numbers a group in one task. Groups of more than ``HOT_ROWS`` rows are
numbered otherwise: their rows are sorted by ranges over all tasks and written
once, each range counts its rows of a group, and the counts of the ranges before
are added. There are few such groups by their size, and of each a row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import settled

#: Rows of a group that one task numbers.
HOT_ROWS = 1 << 14


def numbered(rows: DataFrame, key: list[str], order: list[str], name: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2 ... within each ``key`` by ``order``. Null keys are equal to each other; ties are in any order.

    Large groups are looked for at once, which reads ``rows``; with ``hot_rows`` None, where it is known that there are none, nothing is.
    """
    within = Window.partitionBy(*key).orderBy(*order)
    plain = lambda part: part.withColumn(name, (F.row_number().over(within) - 1).cast("long"))
    if hot_rows is None:
        return plain(rows)
    sizes = rows.groupBy(*key).agg(F.count("*").alias("__rows")).where(F.col("__rows") > hot_rows)
    hot = settled(sizes.select(*(F.col(c).alias(f"__{c}") for c in key)))
    if hot.isEmpty():
        return plain(rows)
    # Few and narrow, so they go to the rows: a join by key would bring a large group together in one task.
    hot = F.broadcast(hot)
    own = lambda part: _same([rows[c].eqNullSafe(hot[f"__{c}"]) for c in key])
    ranged = rows.join(hot, own(rows), "left_semi").repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)
    placed = settled(ranged.withColumn("__at", F.monotonically_increasing_id()).withColumn("__range", F.shiftright("__at", 33)))
    before = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*key, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    ranges = ranges.withColumn("__earlier", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    given = ranges.select(*(F.col(c).alias(f"__{c}") for c in key), F.col("__range").alias("__r"), "__first", "__earlier")
    found = placed.join(F.broadcast(given), _same([placed[c].eqNullSafe(given[f"__{c}"]) for c in key]) & (placed["__range"] == given["__r"]))
    many = found.select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__earlier")).cast("long").alias(name))
    return plain(rows.join(hot, own(rows), "left_anti")).unionByName(many)


def _same(parts: list[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out & part
    return out
