"""Regions to records: tables, key/value blocks, lists and repeated text stanzas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions import html
from tabularium.functions.text import field_name, strip
from tabularium.operators.numbering import numbered


def rekey(rows: DataFrame, name, record: str = "rec") -> DataFrame:
    """``rows`` with the keys of a map column renamed by ``name``; of equal new keys the last one's value stays.

    The new entries are a column of their own, so they are made once however often they are looked at.
    """
    made = rows.withColumn("__entries", F.transform(F.map_entries(record), lambda e: F.struct(name(e["key"]).alias("key"), e["value"].alias("value"))))
    later = lambda e, i: F.exists(F.slice("__entries", i + 2, F.size("__entries")), lambda x: x["key"] == e["key"])
    return made.withColumn(record, F.map_from_entries(F.filter("__entries", lambda e, i: ~later(e, i)))).drop("__entries")


def table_records(regions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, kind, title, row, rec)``: the rows of each region of kind table, as maps by camel-cased header.

    A table without header has columns ``col1`` and so on. Rows with another
    number of cells than there are columns are left out; of equal headers the
    last one's cell stays. The kind is tested before anything is parsed, and
    names are made once for a table, not for its rows.
    """
    parsed = regions.where("kind = 'table'").select(id_col, "pos", "kind", "title", html.raw_table(F.col("body")).alias("raw"))
    parsed = parsed.withColumn("table", html.headers_and_rows(F.col("raw"))).drop("raw")
    named = F.transform("table.headers", lambda h: field_name(h))
    last = F.transform("names", lambda n, i: ~F.array_contains(F.slice("names", i + 2, F.size("names")), n))
    tables = parsed.withColumn("names", named).withColumn("last", last)
    rows = tables.select(id_col, "pos", "kind", "title", "names", "last", F.posexplode("table.rows").alias("row", "cells"))
    bare = F.size("names") <= 0
    width = F.greatest(F.size("cells"), F.lit(1))
    numbered = F.transform(F.sequence(F.lit(1), width), lambda i: F.concat(F.lit("col"), i.cast("string")))
    rows = rows.where((bare & (F.size("cells") > 0)) | (F.size("cells") == F.size("names")))
    chosen = lambda c: F.filter(c, lambda x, i: F.get("last", i))
    rec = F.when(bare, F.map_from_arrays(numbered, "cells")).otherwise(F.map_from_arrays(chosen(F.col("names")), chosen(F.col("cells"))))
    return rows.select(id_col, "pos", "kind", "title", "row", rec.alias("rec"))


def pair_records(regions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, kind, title, row, rec)``: one record per region of kind kv, by camel-cased key; regions without a pair are left out."""
    rows = regions.where("kind = 'kv'").select(id_col, "pos", "kind", "title", F.lit(0).alias("row"), html.parse_pairs(F.col("body")).alias("rec"))
    return rekey(rows.where(F.size("rec") > 0), field_name)


def list_records(regions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, kind, title, row, rec)``: one record ``item`` per list item."""
    rows = regions.where("kind = 'list'").select(id_col, "pos", "kind", "title", F.posexplode(html.parse_list(F.col("body"))).alias("row", "item"))
    return rows.select(id_col, "pos", "kind", "title", "row", F.create_map(F.lit("item"), F.col("item")).alias("rec"))


def to_groups(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, group_name, title, ord, rec)``: records of regions with equal title and kind in one group, in document order.

    A group's name is its title in lower case with hyphens.
    """
    name = F.regexp_replace(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-"), "^-|-$", "")
    rows = found.select(id_col, name.alias("group_name"), "title", "kind", "pos", "row", "rec")
    return numbered(rows, [id_col, "title", "kind"], ["pos", "row"], "ord").select(id_col, "group_name", "title", "ord", "rec")


def typed(records: DataFrame, fields: dict[str, str], keep: tuple[str, ...] = ("doc_id", "ord")) -> DataFrame:
    """Records of one group as columns of the given types; texts that don't fit are null beside ``raw<Field>``."""
    out = []
    for name, kind in fields.items():
        raw = F.col("rec")[name]
        out.append(raw.alias(name) if kind == "string" else raw.try_cast({"number": "double", "integer": "bigint"}.get(kind, kind)).alias(name))
        if kind != "string":
            out.append(raw.alias("raw" + name[:1].upper() + name[1:]))
    return records.select(*keep, *out)


def stanzas(texts: DataFrame, fields: list[tuple[str, str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ord, rec)``: blocks of ``len(fields)`` lines, each matching its field's pattern; a line belongs to one block.

    A field is ``(name, pattern)``; a pattern with a group gives the group, else
    the line. A name ``a,b`` takes two groups. Blocks are found from the top, and a
    found block's lines are passed over: the fold runs within each text.
    """
    size = len(fields)
    lines = F.transform(F.split(text_col, "\n"), strip)
    start = lambda i: [F.get("lines", i + k) for k in range(size)]

    def fits(i: Column) -> Column:
        good = F.lit(True)
        for line, (_, pattern) in zip(start(i), fields, strict=True):
            good = good & F.coalesce(F.rlike(line, F.lit(pattern)), F.lit(False))
        return good

    rows = texts.select(id_col, lines.alias("lines"))
    at = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), fits)
    # Of overlapping starts the first stays: a fold over the few places that fit.
    chosen = F.aggregate(
        at, F.array().cast("array<int>"), lambda acc, i: F.when((F.size(acc) == 0) | (i >= F.element_at(acc, -1) + size), F.concat(acc, F.array(i))).otherwise(acc)
    )
    found = rows.select(id_col, "lines", F.posexplode(chosen).alias("ord", "i"))
    entries = []
    for line, (name, pattern) in zip(start(F.col("i")), fields, strict=True):
        names = name.split(",")
        grouped = "(" in pattern.replace("(?", "")
        for k, n in enumerate(names):
            entries += [F.lit(n), F.regexp_extract(line, pattern, k + 1) if grouped else line]
    return found.select(id_col, F.col("ord").cast("long").alias("ord"), F.create_map(*entries).alias("rec"))
