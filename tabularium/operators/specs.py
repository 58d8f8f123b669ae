"""Regions to records by a table of extraction rules: one plan for all documents, each with rules of its own.

A spec row says which regions it is for (``doc_id``, ``kind`` and ``title``, each
null for any), how they are parsed and what becomes of what is found. It is data:
nothing in it is executed but regular expressions.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions import html
from tabularium.functions.text import field_name, strip

#: ``helper``: table, pairs, list or text. ``headers`` of tables: auto (by their look), first (the first row) or none.
#: ``fields``: of tables and pairs the new name of the columns or keys that match ``pattern``, others go; of lists and texts a line each, its groups named ``a,b``.
SPEC = "doc_id long, spec_ord int, kind string, title string, helper string, headers string, group_name string, fields array<struct<name:string,pattern:string>>"
HELPERS = ("table", "pairs", "list", "text")
_STRINGS = "array<string>"
_ROWS = "array<array<string>>"


def chosen_specs(regions: DataFrame, spec: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``regions`` with ``spec``, the row that is for them: with a document before without, then with a title, then with a kind, then by ``spec_ord``.

    A region asks for each of the eight ways to name it, which makes the search
    a join by equal keys; no region meets a rule that isn't for it. Regions without a rule are left out.
    """
    parts = ("doc", "title", "kind")
    ways = [F.array(*(F.col(f"__{p}") if used else F.lit(None).cast("string") for p, used in zip(parts, flags, strict=True))) for flags in product((True, False), repeat=3)]
    key = lambda named: F.to_json(F.struct(named.alias("k")), {"ignoreNullFields": "false"})
    named = {"__doc": F.col(id_col).cast("string"), "__title": F.col("title"), "__kind": F.col("kind")}
    asked = regions.select(id_col, "pos", *(v.alias(k) for k, v in named.items())).select(id_col, "pos", F.posexplode(F.array(*map(key, ways))).alias("way", "__key"))
    own = spec.select(key(F.array(F.col("doc_id").cast("string"), "title", "kind")).alias("__key"), "spec_ord", F.struct("helper", "headers", "group_name", "fields").alias("spec"))
    best = asked.join(own, "__key").groupBy(F.col(id_col).alias("__id"), F.col("pos").alias("__pos")).agg(F.min_by("spec", F.struct("way", "spec_ord")).alias("spec"))
    return regions.join(best, regions[id_col].eqNullSafe(best["__id"]) & (regions["pos"] == best["__pos"])).drop("__id", "__pos")


def stanza_rows(lines: str, fields: str) -> Column:
    """The values of each block of lines of which every one matches the field at its place; blocks are found from the top and don't overlap."""
    size = F.size(fields)
    places = F.sequence(F.lit(0), size - 1)
    fits = lambda i: F.forall(places, lambda j: F.coalesce(F.call_function("rlike", F.get(lines, i + j), F.get(fields, j)["pattern"]), F.lit(False)))
    at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), fits)
    # Of overlapping starts the first stays: a fold over the few places that fit.
    first = F.aggregate(at, F.array().cast("array<int>"), lambda acc, i: F.when((F.size(acc) == 0) | (i >= F.element_at(acc, -1) + size), F.concat(acc, F.array(i))).otherwise(acc))

    def values(i: Column) -> Column:
        def of_line(j: Column) -> Column:
            line, field = F.get(lines, i + j), F.get(fields, j)
            grouped = F.contains(F.replace(field["pattern"], F.lit("(?"), F.lit("")), F.lit("("))
            return F.transform(F.split(field["name"], ","), lambda n, g: F.when(grouped, F.call_function("regexp_extract", line, field["pattern"], g + 1)).otherwise(line))

        return F.flatten(F.transform(places, of_line))

    return F.when(size > 0, F.transform(first, values))


def _list_rows(items: str, fields: str) -> Column:
    """The groups of each item that all fields match; without fields the item."""
    one = lambda x, f: F.transform(F.split(f["name"], ","), lambda n, g: F.call_function("regexp_extract", x, f["pattern"], g + 1))
    good = F.filter(items, lambda x: F.forall(fields, lambda f: F.coalesce(F.call_function("rlike", x, f["pattern"]), F.lit(False))))
    return F.when(F.col(fields).isNull(), F.transform(items, lambda x: F.array(x))).otherwise(F.transform(good, lambda x: F.flatten(F.transform(fields, lambda f: one(x, f)))))


def records_by_spec(regions: DataFrame, spec: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, pos, kind, title, group_name, row, rec)`` of all regions that a rule is for.

    All regions go through one parse: a helper sees the body only where a rule
    asks for it. Rows of a table with another number of cells than there are
    columns are left out; of equal names the last one's value stays; a column or
    key that no field names is left out, and all are in camel case where the rule has no fields.
    """
    rows = chosen_specs(regions, spec, id_col).select(id_col, "pos", "kind", "title", "body", "spec.*")
    asked = lambda helper: F.when(F.col("helper") == helper, F.col("body"))
    parsed = rows.select(
        id_col, "pos", "kind", "title", "helper", "headers", "group_name", "fields",
        html.raw_table(asked("table")).alias("raw"), html.parse_pairs(asked("pairs")).alias("pairs"), html.parse_list(asked("list")).alias("items"),
        F.transform(F.split(html.plain_text(asked("text")), "\n"), strip).alias("lines"),
    )
    tables, bare = html.headers_and_rows(F.col("raw")), F.array().cast(_STRINGS)
    given = F.col("raw.headers").isNotNull()
    first = F.when(given, F.struct("raw.headers", "raw.rows")).otherwise(
        F.struct(F.coalesce(F.get("raw.rows", F.lit(0)), bare).alias("headers"), F.slice("raw.rows", F.lit(2), F.greatest(F.size("raw.rows"), F.lit(1))).alias("rows"))
    )
    policy = F.when(F.col("headers") == "first", first).when(F.col("headers") == "none", F.struct(bare.alias("headers"), F.col("raw.rows").alias("rows"))).otherwise(tables)
    parsed = parsed.withColumn("table", F.when(F.col("helper") == "table", policy))
    names = (
        F.when(F.col("helper") == "table", F.col("table.headers"))
        .when(F.col("helper") == "pairs", F.map_keys("pairs"))
        .when(F.col("fields").isNull(), F.array(F.lit("item")))
        .otherwise(F.flatten(F.transform("fields", lambda f: F.split(f["name"], ","))))
    )
    found = (
        F.when(F.col("helper") == "table", F.col("table.rows"))
        .when((F.col("helper") == "pairs") & (F.size("pairs") > 0), F.array(F.map_values("pairs")))
        .when(F.col("helper") == "list", _list_rows("items", "fields"))
        .when(F.col("helper") == "text", stanza_rows("lines", "fields"))
        .cast(_ROWS)
    )
    keyed = F.col("helper").isin("table", "pairs")
    wanted = lambda h: F.get(F.filter("fields", lambda f: F.coalesce(F.call_function("rlike", h, f["pattern"]), F.lit(False))), F.lit(0))["name"]
    named = F.when(~keyed, F.col("names")).when(F.col("fields").isNull(), F.transform("names", field_name)).otherwise(F.transform("names", wanted))
    parsed = parsed.withColumns({"names": names, "found": found}).withColumn("named", named)
    last = F.transform("named", lambda n, i: n.isNotNull() & ~F.exists(F.slice("named", i + 2, F.size("named")), lambda m: m.eqNullSafe(n)))
    rows = parsed.withColumn("last", last).select(id_col, "pos", "kind", "title", "helper", "group_name", "named", "last", F.posexplode("found").alias("row", "cells"))
    headless = (F.col("helper") == "table") & (F.size("named") <= 0)
    rows = rows.where((headless & (F.size("cells") > 0)) | (F.size("cells") == F.size("named")))
    numbered = F.transform(F.sequence(F.lit(1), F.greatest(F.size("cells"), F.lit(1))), lambda i: F.concat(F.lit("col"), i.cast("string")))
    chosen = lambda c: F.filter(c, lambda x, i: F.get("last", i))
    rec = F.when(headless, F.map_from_arrays(numbered, "cells")).otherwise(F.map_from_arrays(chosen(F.col("named")), chosen(F.col("cells"))))
    return rows.select(id_col, "pos", "kind", "title", "group_name", "row", rec.alias("rec"))
