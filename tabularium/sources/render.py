"""Anchored HTML documents rendered from tables: inputs whose right parse is the table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def region(identity: Column, kind: str, title: Column, body: Column) -> Column:
    start = F.concat(F.lit('<!-- structured-start:id="'), identity, F.lit(f'" kind="{kind}" title="'), title, F.lit('" -->'))
    return F.concat(start, body, F.lit('<!-- structured-end:id="'), identity, F.lit('" -->'))


def row(cells: list[Column], tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), *(x for c in cells for x in (F.lit(f"<{tag}> "), escape(c), F.lit(f"\n</{tag}>"))), F.lit("</tr>"))


def tables(rows: DataFrame, doc: Column, order: str, cells: list[Column], headers: list[str] | None, title: Column, prose: str = "") -> DataFrame:
    """``(doc_id, html)``: one document per value of ``doc`` with one table of its rows."""
    head = "".join(f"<th>{h}</th>" for h in headers) if headers else ""
    made = rows.select(doc.alias("doc_id"), title.alias("title"), F.struct(F.col(order).alias("k"), row(cells).alias("r")).alias("r"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list("r")), lambda x: x["r"]), "")
    table = F.concat(F.lit("<table>" + (f"<thead><tr>{head}</tr></thead>" if headers else "") + "<tbody>"), body, F.lit("</tbody></table>"))
    grouped = made.groupBy("doc_id").agg(table.alias("body"), F.min("title").alias("title"))
    key = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    return grouped.select("doc_id", F.concat(F.lit(f"<h1>Report</h1>{prose}"), region(key, "table", F.col("title"), F.col("body"))).alias("html"))
