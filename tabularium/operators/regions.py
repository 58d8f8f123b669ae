"""Anchored regions of documents, found by splitting at their start comments.

Splitting keeps a region's body next to its own start comment, so no offsets
and no range join of starts and ends are needed; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import tidy

#: Fixed values of the format: comments that start and end a region.
START = r'<!--\s*structured-start:id="([^"]+)"\s+kind="([^"]+)"\s+title="([^"]+)"\s*-->'
END = r'<!--\s*structured-end:id="[^"]+"\s*-->'


def _end_of(identity: Column) -> Column:
    """Where the end comment in a segment is, as a struct of text before and after; null without one.

    An end with the region's own id is preferred to the first of any id. One that
    follows its start comment at once does not count.
    """
    segment = F.col("segment")
    own = F.concat(F.lit(r'(?s)^(.+?)<!--\s*structured-end:id="\Q'), identity, F.lit(r'\E"\s*-->(.*)$'))
    any_id = F.lit(rf"(?s)^(.+?){END}(.*)$")
    part = lambda pattern, k: F.call_function("regexp_extract", segment, pattern, F.lit(k))
    pick = lambda pattern: F.struct(part(pattern, 1).alias("body"), part(pattern, 2).alias("rest"))
    return F.when(F.rlike(segment, own), pick(own)).when(F.rlike(segment, any_id), pick(any_id))


def segments(docs: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """``(id_col, pos, id, kind, title, body, after, ended, whole, stop)``: one row per start comment, in order.

    ``body`` reaches to the resolved end, else to the next start; ``after`` is
    what lies between the end and the next start. ``whole`` is the region with
    its comments, and ``stop`` the offset behind it. Null documents have no regions.
    """
    parts = ((0, "comment"), (1, "id"), (2, "kind"), (3, "title"))
    starts = F.arrays_zip(*(F.regexp_extract_all(F.col(html_col), F.lit(START), F.lit(k)).alias(n) for k, n in parts))
    bodies = F.split(F.col(html_col), START, -1)
    rows = docs.select(F.col(id_col), bodies.alias("bodies"), starts.alias("starts"))
    # Each start comes with its own segment only, and with where it stands: one running sum over lengths, made once for a document.
    lengths = F.zip_with("bodies", "starts", lambda b, s: F.length(b) + F.coalesce(F.length(s["comment"]), F.lit(0)))
    none = F.array().cast("array<int>")
    ends = F.aggregate(lengths, none, lambda acc, n: F.concat(acc, F.array(F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), acc), -1) + n, F.lit(0)))))
    own = F.slice("bodies", F.lit(2), F.greatest(F.size("bodies") - 1, F.lit(0)))
    rows = rows.select(id_col, F.posexplode(F.arrays_zip(F.col("starts").alias("start"), own.alias("segment"), ends.alias("end"))).alias("pos", "r")).where("r.start is not null")
    rows = rows.select(id_col, "pos", "r.start.*", (F.col("r.end") - F.length("r.start.comment")).alias("before"), "r.segment")
    found = rows.withColumn("end", _end_of(F.col("id")))
    whole = F.concat("comment", F.left("segment", F.length("segment") - F.coalesce(F.length("end.rest"), F.lit(0))))
    return found.select(
        id_col, "pos", "id", "kind", "title", F.coalesce("end.body", "segment").alias("body"), F.col("end.rest").alias("after"), F.col("end").isNotNull().alias("ended"),
        whole.alias("whole"), (F.col("before") + F.length(whole)).alias("stop"),
    )


def find_regions(docs: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """``(id_col, pos, id, kind, title, body)`` of every region."""
    return segments(docs, id_col, html_col).select(id_col, "pos", "id", "kind", "title", "body")


#: Characters of a gap that may join two tables, and of those that are shown.
MAX_GAP, SHOWN_GAP = 800, 600


def adjacent_tables(docs: DataFrame, max_gap: int = MAX_GAP, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """``(id_col, pos, first_title, second_title, gap_chars, gap_text)``: tables with a little prose between them, a sign of a continuation."""
    order = Window.partitionBy(id_col).orderBy("pos")
    rows = segments(docs, id_col, html_col).select(id_col, "pos", "kind", "title", "after", "ended")
    rows = rows.withColumns({"next_kind": F.lead("kind").over(order), "second_title": F.lead("title").over(order)})
    gap = tidy(F.regexp_replace("after", "<[^>]+>", " "))
    rows = rows.where("kind = 'table' and next_kind = 'table' and ended").withColumn("gap", gap)
    rows = rows.where((F.length("gap") > 0) & (F.length("gap") <= max_gap))
    return rows.select(
        id_col, "pos", F.col("title").alias("first_title"), "second_title", F.length("gap").cast("long").alias("gap_chars"), F.left("gap", F.lit(SHOWN_GAP)).alias("gap_text")
    )
