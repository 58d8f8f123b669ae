"""Structure hints of pages, aggregated over a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import normalise_title, schema_key, strip


def resolve_continuations(hints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``hints`` with ``parent``: of a continuation, the latest earlier hint of its kind that is none.

    Its title must equal ``continues_previous`` where that is given; else it must
    have as many columns (and some). Two windows find both, without a self-join.
    Hints are ordered by page and place; ``parent`` is null where there is none.
    """
    whole = F.struct("title", "kind", "schema_guess")
    wanted = F.lower(strip(F.coalesce("continues_previous", F.lit(""))))
    cols = F.size(F.map_keys(F.coalesce("schema_guess", F.create_map().cast("map<string,string>"))))
    rows = hints.withColumns({"__cont": F.coalesce("is_continuation", F.lit(False)), "__wanted": wanted, "__cols": cols})
    rows = rows.withColumn("__title", F.when(F.col("__cont") & (F.col("__wanted") != ""), normalise_title(F.col("__wanted"))).otherwise(normalise_title(F.col("title"))))
    order = ["page", "place"]
    window = lambda *by: Window.partitionBy(id_col, "kind", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda *by: F.last(F.when(~F.col("__cont"), whole), ignorenulls=True).over(window(*by))
    rows = rows.withColumns({"__by_title": earlier("__title"), "__by_cols": earlier("__cols")})
    parent = F.when(F.col("__cont") & (F.col("__wanted") != ""), F.col("__by_title")).when(F.col("__cont") & (F.col("__cols") > 0), F.col("__by_cols"))
    return rows.withColumn("parent", parent).drop("__cont", "__wanted", "__cols", "__title", "__by_title", "__by_cols")


def aggregate_hints(hints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, hint_key, title, kind, schema_guess, pages, total_records, sample_ids, descriptions, first)``.

    ``hints`` has ``(id_col, page, place, id, kind, title, description,
    schema_guess, record_count, is_continuation, continues_previous)``. The key is
    the normalised title and the schema of a hint or of the one that it
    continues. Lists hold each value once, in the order met; a count that is null
    or no number is 0. ``first`` orders groups of equal totals.
    """
    own = F.struct("title", "kind", "schema_guess")
    rows = resolve_continuations(hints, id_col).withColumn("of", F.coalesce("parent", own))
    key = F.concat(normalise_title(F.coalesce("of.title", F.lit(""))), F.lit("::"), schema_key(F.col("of.schema_guess")))
    at = F.struct("page", "place")
    rows = rows.select(id_col, key.alias("hint_key"), "of", at.alias("at"), "page", "id", "description", F.coalesce(F.nanvl("record_count", F.lit(0.0)), F.lit(0.0)).alias("n"))

    out = rows.groupBy(id_col, "hint_key").agg(F.min_by("of", "at").alias("of"), F.sum("n").alias("total_records"), F.min("at").alias("first"))
    # Of each value the first place is kept before anything is gathered: a list grows with its different values, not with the hints.
    lists = {"page": "pages", "id": "sample_ids", "description": "descriptions"}
    value = F.explode(F.array(*(F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("v")) for c in lists))).alias("met")
    met = rows.select(id_col, "hint_key", "at", value).where("met.v <> ''").groupBy(id_col, "hint_key", "met").agg(F.min("at").alias("at"))
    kind = {"page": rows.schema["page"].dataType.simpleString()}
    gathered = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col("met.of") == c, F.struct("at", "met.v")))), lambda x: x["v"])
    met = met.groupBy(id_col, "hint_key").agg(*(gathered(c).cast(f"array<{kind.get(c, 'string')}>").alias(name) for c, name in lists.items()))
    on = out[id_col].eqNullSafe(met[id_col]) & (out["hint_key"] == met["hint_key"])
    nothing = lambda name: F.coalesce(name, F.array().cast(met.schema[name].dataType)).alias(name)
    out = out.join(met, on, "left").select(out["*"], *map(nothing, lists.values()))
    return out.select(id_col, "hint_key", "of.title", "of.kind", "of.schema_guess", "pages", "total_records", "sample_ids", "descriptions", "first")
