"""Types of fields, found from all their values and kept through the steps that change groups.

A value is null, boolean, integer, number, date or string; a field's type is the
least one that holds all its values: integers are numbers, and what has nothing
else in common is string. How many values are of each kind adds up, so types are
an aggregate that combines before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import field_name, not_blank
from tabularium.operators.groups import KEY, _members

FIELDS = "array<struct<name:string,type:string>>"
KINDS = ("booleans", "integers", "numbers", "dates")
#: A number with a zero before its digits is a code, and stays text.
INTEGER, NUMBER, DATE = r"^-?(0|[1-9][0-9]{0,17})$", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]{1,3})?$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def is_kind(value: Column, kind: str) -> Column:
    """Whether a text that isn't null is of a kind."""
    if kind == "booleans":
        return F.lower(value).isin("true", "false")
    if kind == "dates":
        return F.rlike(value, F.lit(DATE)) & value.try_cast("date").isNotNull()
    return F.rlike(value, F.lit(INTEGER if kind == "integers" else NUMBER))


def type_of(counts: dict[str, Column], total: Column) -> Column:
    """The type of ``total`` values, of which ``counts`` are of each kind; ``null`` without any."""
    every = lambda kind: counts[kind] == total
    return (
        F.when(total == 0, "null").when(every("booleans"), "boolean").when(every("integers"), "integer").when(every("numbers"), "number").when(every("dates"), "date").otherwise("string")
    )


def field_types(records: DataFrame) -> DataFrame:
    """``(doc_id, group_name, name, first, total, booleans, integers, numbers, dates, type)`` of every field; blank values count for none.

    ``first`` is where the field is met first.
    """
    rows = records.select(*KEY, "ord", F.posexplode(F.map_entries("rec")).alias("pos", "e")).select(*KEY, "ord", "pos", F.col("e.key").alias("name"), not_blank(F.col("e.value")).alias("v"))
    kinds = [F.count_if(is_kind(F.col("v"), k)).alias(k) for k in KINDS]
    out = rows.groupBy(*KEY, "name").agg(F.min(F.struct("ord", "pos")).alias("first"), F.count("v").alias("total"), *kinds)
    return out.withColumn("type", type_of({k: F.col(k) for k in KINDS}, F.col("total")))


def infer_groups(records: DataFrame) -> DataFrame:
    """``(doc_id, group_name, title, fields)``: the fields of each group in the order met, with their types; a field without values is a string."""
    named = F.struct("first", "name", F.when(F.col("type") == "null", "string").otherwise(F.col("type")).alias("type"))
    titles = records.groupBy(*KEY).agg(F.min("title").alias("title"))
    listed = field_types(records).groupBy(*KEY).agg(F.transform(F.sort_array(F.collect_list(named)), lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).alias("fields"))
    return titles.join(listed, list(KEY))


def _by_name(parts: list[DataFrame]) -> DataFrame:
    """One row for each group name of a document, with the fields of all its rows in order; of equal names the first one's type holds."""
    rows = None
    for k, part in enumerate(parts):
        # An order of its own for each part, whatever the rows of a part are ordered by.
        own = part.select(*KEY, "title", F.lit(k).alias("src"), (F.col("at") if "at" in part.columns else F.lit("")).alias("at"), F.posexplode_outer("fields").alias("pos", "f"))
        rows = own if rows is None else rows.unionByName(own)
    at = F.struct("src", "at", "pos")
    titled = rows.groupBy(*KEY).agg(F.min_by("title", at).alias("title"))
    first = rows.where("f is not null").groupBy(*KEY, F.col("f.name").alias("name")).agg(F.min(at).alias("first"), F.min_by("f.type", at).alias("type"))
    listed = first.groupBy(*KEY).agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "name", "type"))), lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).alias("fields"))
    return titled.join(listed, list(KEY), "left").withColumn("fields", F.coalesce("fields", F.array().cast(FIELDS)))


def merged_groups(groups: DataFrame, plan: DataFrame, camel: bool) -> DataFrame:
    """``groups`` after the merges that ``groups.merge_groups`` makes of their records.

    Fields come in the order of the groups in the plan; of those that get one
    name the first one's type holds. A merged group's title is its name.
    """
    members = _members(groups, plan)
    plain = field_name if camel else (lambda c: c)
    # The names are a column of their own: next to the new group name, the old one would be looked up under it.
    rows = members.join(groups.select(*KEY, "fields"), list(KEY)).withColumn("names", F.col("field_maps")[F.col("group_name")])
    renamed = F.transform("fields", lambda f: F.struct(F.coalesce(F.col("names")[f["name"]], plain(f["name"])).alias("name"), f["type"].alias("type")))
    place = F.concat_ws(" ", "plan_id", F.lpad(F.col("src_pos").cast("string"), 9, "0"))
    merged = rows.select("doc_id", F.col("target").alias("group_name"), F.col("target").alias("title"), place.alias("at"), renamed.alias("fields"))
    untouched = groups.join(members.select(*KEY).distinct(), list(KEY), "left_anti").select(*KEY, "title", "fields")
    return _by_name([merged, untouched])


def pivoted_groups(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """``groups`` after the pivots that ``groups.unpivot_group`` makes of their records.

    The target field comes first, with the type of the first pivoted column that
    the group has, else string; the kept fields follow with their own types.
    """
    good = plan.where(F.size("pivot_fields") >= 2).withColumnRenamed("target", "__target")
    rows = groups.join(good, list(KEY))
    typed = lambda name: F.get(F.filter("fields", lambda f: f["name"] == name), F.lit(0))["type"]
    kinds = F.filter(F.transform("pivot_fields", typed), lambda t: t.isNotNull())
    target = F.array(F.struct(F.col("target_field").alias("name"), F.coalesce(F.get(kinds, F.lit(0)), F.lit("string")).alias("type")))
    kept = F.filter(F.transform("keep_fields", lambda n: F.struct(n.alias("name"), F.coalesce(typed(n), F.lit("string")).alias("type"))), lambda f: f["name"] != F.col("target_field"))
    made = rows.select("doc_id", F.col("__target").alias("group_name"), F.col("__target").alias("title"), F.concat(target, kept).alias("fields"))
    untouched = groups.join(good.select(*KEY).distinct(), list(KEY), "left_anti").select(*KEY, "title", "fields")
    return _by_name([made, untouched])


def after(step: str, groups: DataFrame) -> DataFrame:
    """``(step, doc_id, group_name, pos, name, type)`` of all fields."""
    return groups.select(F.lit(step).alias("step"), *KEY, F.posexplode("fields").alias("pos", "f")).select("step", *KEY, "pos", "f.name", "f.type")
