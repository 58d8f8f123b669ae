"""Groups of records, and the plans that rename, merge and unpivot them.

Groups are two tables: ``groups(doc_id, group_name, title, fields)`` with
``fields array<struct<name,type>>`` in order, and ``records(doc_id,
group_name, ord, rec)``. Plans are tables too, with a row per document, so one
job serves any number of documents; they are joined, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import field_name
from tabularium.operators.numbering import HOT_ROWS, numbered
from tabularium.operators.records import rekey

KEY = ("doc_id", "group_name")
PAIR = "array<struct<src:string,dst:string>>"


def _suffixed(pairs: Column) -> Column:
    """Pairs ``(src, dst)`` in order, each ``dst`` with the first suffix (none, 2, 3 ...) that no earlier one has."""

    def free(acc: Column, dst: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(1), F.size(acc) + 1), lambda i: F.when(i == 1, dst).otherwise(F.concat(dst, i.cast("string"))))
        return F.element_at(F.filter(tries, lambda t: ~F.exists(acc, lambda a: a["dst"] == t)), 1)

    return F.aggregate(
        pairs, F.array().cast(PAIR), lambda acc, x: F.concat(acc, F.array(F.struct(x["src"].alias("src"), free(acc, x["dst"]).alias("dst"))))
    )


def plan_order(plan: DataFrame, last: bool = False) -> list[Column]:
    """The order of plan rows of one group: by ``plan_ord``, the latest first if ``last``, and then by all they say, so that ties are settled alike in every run."""
    own = [F.desc("plan_ord") if last else F.col("plan_ord")] if "plan_ord" in plan.columns else []
    rest = [c for c in plan.columns if c not in (*KEY, "plan_ord")]
    return [*own, F.to_json(F.struct(*(F.col(c) for c in rest)))]


def rename_plan(groups: DataFrame, mapping: DataFrame) -> DataFrame:
    """``groups`` with ``pairs``: the new name of every field, in the order of the renamed schema; null without a mapping.

    ``mapping`` has ``(doc_id, group_name, field_map)``; of several rows for a
    group the one with the largest ``plan_ord`` holds (if there is that column).
    """
    best = mapping.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*plan_order(mapping, last=True)))).where("__n = 1").select(*KEY, "field_map")
    names = F.transform("fields", lambda f: f["name"])
    proposed = F.filter(F.map_entries("field_map"), lambda e: F.array_contains(names, e["key"]))
    given = F.transform(proposed, lambda e: F.struct(e["key"].alias("src"), e["value"].alias("dst")))
    rest = F.transform(
        F.filter(names, lambda n: ~F.exists(given, lambda g: g["src"] == n)), lambda n: F.struct(n.alias("src"), field_name(n).alias("dst"))
    )
    joined = groups.join(best, list(KEY), "left")
    return joined.withColumn("pairs", F.when(F.col("field_map").isNotNull(), _suffixed(F.concat(given, rest)))).drop("field_map")


def rename_fields(groups: DataFrame, records: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and records with renamed fields. Record keys outside the schema become camel case; of equal names the last value stays."""
    planned = rename_plan(groups, mapping)
    kind = lambda src: F.coalesce(F.element_at(F.filter("fields", lambda f: f["name"] == src), 1)["type"], F.lit("string"))
    fields = F.transform("pairs", lambda p: F.struct(p["dst"].alias("name"), kind(p["src"]).alias("type")))
    new_groups = planned.withColumn("fields", F.coalesce(fields, F.col("fields"))).drop("pairs")
    rows = records.join(planned.select(*KEY, F.map_from_entries("pairs").alias("__names")), list(KEY), "left")
    untouched = F.col("__names").isNull()
    return new_groups, rekey(rows, lambda k: F.when(untouched, k).otherwise(F.coalesce(F.col("__names")[k], field_name(k)))).drop("__names")


def _members(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """``(doc_id, plan_id, src_pos, group_name, target, ...)``: the groups that a plan names and that exist, of plans with two at least."""
    named = plan.select("*", F.posexplode("groups").alias("src_pos", "group_name"))
    found = named.join(groups.select(*KEY).distinct(), list(KEY), "left_semi")
    return found.withColumn("__n", F.count("*").over(Window.partitionBy("doc_id", "plan_id"))).where("__n >= 2").drop("__n", "groups")


def merge_groups(groups: DataFrame, records: DataFrame, plan: DataFrame, camel: bool, hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(untouched groups, records)`` after merging groups by name.

    ``plan`` has ``(doc_id, plan_id, groups array, target, field_maps
    map<group, map<src, dst>>)``. Fields without a new name become camel case
    where ``camel`` holds (a row-merge), else they stay (a merge). Record order
    is the order of the groups in the plan, then their own. A plan with fewer than
    two known groups does nothing; a group in two plans is used twice.
    """
    members = _members(groups, plan)
    own = members.select(*KEY, "plan_id", "target", "src_pos", F.col("field_maps")[F.col("group_name")].alias("__names"))
    rows = records.join(own, list(KEY))
    plain = field_name if camel else (lambda k: k)
    rows = rekey(rows, lambda k: F.coalesce(F.col("__names")[k], plain(k)))
    merged = numbered(rows.withColumnRenamed("ord", "own_ord"), ["doc_id", "plan_id"], ["src_pos", "own_ord"], "ord", hot_rows).select("doc_id", F.col("target").alias("group_name"), "ord", "rec")
    used = members.select(*KEY).distinct()
    return groups.join(used, list(KEY), "left_anti"), merged.unionByName(records.join(used, list(KEY), "left_anti"))


def unpivot_group(records: DataFrame, plan: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Records after unpivoting columns of one group: a record for each pivoted column that is neither null nor empty.

    ``plan`` has ``(doc_id, group_name, pivot_fields array, target_field,
    keep_fields array, target)``; plans with fewer than two pivot fields do nothing.
    """
    good = plan.where(F.size("pivot_fields") >= 2)
    rows = records.join(good, list(KEY)).select("*", F.posexplode("pivot_fields").alias("pivot_pos", "pivot_field"))
    rows = rows.withColumn("value", F.col("rec")[F.col("pivot_field")]).where("value is not null and value <> ''")
    kept = F.map_filter("rec", lambda k, v: F.array_contains("keep_fields", k) & (k != F.col("target_field")))
    rec = F.map_concat(F.create_map("target_field", "value"), kept)
    rows = rows.select(*KEY, "target", F.col("ord").alias("own_ord"), "pivot_pos", rec.alias("rec"))
    out = numbered(rows, list(KEY), ["own_ord", "pivot_pos"], "ord", hot_rows).select("doc_id", F.col("target").alias("group_name"), "ord", "rec")
    return out.unionByName(records.join(good.select(*KEY).distinct(), list(KEY), "left_anti"))


def merged_fields(groups: DataFrame, plan: DataFrame, camel: bool = False) -> DataFrame:
    """``(doc_id, plan_id, target, fields)``: the schema of each merge; of equal names the first in plan order gives the type.

    Fields without a new name become camel case where ``camel`` holds, as in ``merge_groups``.
    """
    plain = field_name if camel else (lambda c: c)
    rows = _members(groups, plan).join(groups.select(*KEY, "fields"), list(KEY))
    rows = rows.select("doc_id", "plan_id", "target", "src_pos", F.col("field_maps")[F.col("group_name")].alias("m"), F.posexplode("fields").alias("f_pos", "f"))
    rows = rows.select("doc_id", "plan_id", "target", F.struct("src_pos", "f_pos").alias("at"), F.coalesce(F.col("m")[F.col("f.name")], plain(F.col("f.name"))).alias("name"), "f.type")
    first = rows.groupBy("doc_id", "plan_id", "target", "name").agg(F.min("at").alias("at"), F.min_by("type", "at").alias("type"))
    listed = F.sort_array(F.collect_list(F.struct("at", "name", "type")))
    return first.groupBy("doc_id", "plan_id", "target").agg(F.transform(listed, lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).alias("fields"))


def combine(*parts: DataFrame) -> DataFrame:
    """All records or groups of several sets, columns by name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def summaries(groups: DataFrame, records: DataFrame, samples: int = 3) -> DataFrame:
    """``groups`` with ``n_records`` and the first ``samples`` records of each.

    The first records are chosen by a window before anything is gathered, so no
    list grows with its group.
    """
    head = records.withColumn("__n", F.row_number().over(Window.partitionBy(*KEY).orderBy("ord"))).where(F.col("__n") <= samples)
    listed = head.groupBy(*KEY).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", F.map_entries("rec").alias("e")))), lambda x: F.map_from_entries(x["e"])).alias("samples"))
    sizes = records.groupBy(*KEY).agg(F.count("*").alias("n_records"))
    out = groups.join(sizes, list(KEY), "left").join(listed, list(KEY), "left")
    return out.withColumn("n_records", F.coalesce("n_records", F.lit(0)))


def truncate(record: Column, most: int = 240) -> Column:
    """A record with texts cut to ``most`` characters and three dots."""
    return F.transform_values(record, lambda k, v: F.when(F.length(v) > most, F.concat(F.left(v, F.lit(most)), F.lit("..."))).otherwise(v))


def join_groups(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Records of two groups joined by pairs of fields: ``(doc_id, left_ord, right_ord, rec)``; the left value of a shared name stays."""
    a = left.select("doc_id", F.col("ord").alias("left_ord"), F.col("rec").alias("a"))
    b = right.select(F.col("doc_id").alias("b_doc"), F.col("ord").alias("right_ord"), F.col("rec").alias("b"))
    same = F.col("doc_id") == F.col("b_doc")
    for x, y in on:
        same = same & (F.col("a")[x] == F.col("b")[y])
    extra = F.map_filter("b", lambda k, v: ~F.map_contains_key("a", k))
    return a.join(b, same, how).select(F.coalesce("doc_id", "b_doc").alias("doc_id"), "left_ord", "right_ord", F.coalesce(F.map_concat("a", extra), "a", "b").alias("rec"))


def profile_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """``(n_keys, left_max, right_max, matched_keys, cardinality)`` of a join; keys with a null do not count."""

    def keys(side: DataFrame, k: int, name: str) -> DataFrame:
        key = F.array(*(F.col("rec")[pair[k]] for pair in on))
        rows = side.select("doc_id", key.alias("key")).where(~F.exists("key", lambda v: v.isNull()))
        return rows.groupBy("doc_id", "key").agg(F.count("*").alias(name))

    both = keys(left, 0, "l").join(keys(right, 1, "r"), ["doc_id", "key"], "full_outer")
    out = both.agg(
        F.count("*").alias("n_keys"), F.coalesce(F.max("l"), F.lit(0)).alias("left_max"), F.coalesce(F.max("r"), F.lit(0)).alias("right_max"),
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("matched_keys"),
    )
    side = lambda c: F.when(F.col(c) > 1, "many").otherwise("one")
    return out.withColumn("cardinality", F.concat(side("left_max"), F.lit("-to-"), side("right_max")))


def rank_groups(groups: DataFrame, records: DataFrame) -> DataFrame:
    """``(doc_id, group_name, n_records, n_fields, cells, rank)``: by cells, records, fields (all falling), then name.

    The most prominent group has rank 1, the runner-up 2. A group without fields
    counts as having one; names are ordered as in a dictionary.
    """
    sizes = records.groupBy(*KEY).agg(F.count("*").alias("n_records"))
    rows = groups.join(sizes, list(KEY), "left").select(
        *KEY, F.coalesce("n_records", F.lit(0)).cast("long").alias("n_records"), F.size(F.coalesce("fields", F.array().cast("array<struct<name:string,type:string>>"))).alias("n_fields")
    )
    rows = rows.withColumn("cells", (F.col("n_records") * F.greatest("n_fields", F.lit(1))).cast("long"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("cells"), F.desc("n_records"), F.desc("n_fields"), F.collate("group_name", "UNICODE"))
    return rows.withColumn("rank", F.row_number().over(order))
