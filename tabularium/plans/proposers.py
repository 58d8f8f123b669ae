"""Who proposes plans: given tables, or rules that need no service.

A proposer turns what is known of groups into plan tables (see
``operators.groups``). A client of a language model is one more: it gets small
summaries and returns rows of the same columns. Rules are joins and aggregates
over schemas, which are small beside the records.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.functions.text import camel_case, normalise_title

FIELD_MAPS = "doc_id long, group_name string, field_map map<string,string>"
MERGES = "doc_id long, plan_id string, groups array<string>, target string, field_maps map<string,map<string,string>>"
PIVOTS = "doc_id long, group_name string, pivot_fields array<string>, target_field string, keep_fields array<string>, target string"
JOINS = "doc_id long, left string, right string, on array<struct<left:string,right:string>>, type string, reason string"
ADDRESSES = "doc_id long, group_name string, has_address boolean, confidence string, columns array<string>, join_template string"


class Proposer(Protocol):
    """A ``key``, if there is one, names all that the plans depend on besides their arguments: plans of equal keys may be reused."""

    def field_maps(self, groups: DataFrame, preferred: DataFrame) -> DataFrame: ...

    def row_merges(self, groups: DataFrame) -> DataFrame: ...

    def pivots(self, groups: DataFrame) -> DataFrame: ...

    def merges(self, groups: DataFrame) -> DataFrame: ...

    def joins(self, groups: DataFrame) -> DataFrame: ...

    def addresses(self, groups: DataFrame) -> DataFrame: ...


@dataclass
class GivenPlans:
    """Plans from tables, such as answers of a model that were kept. A plan that isn't given proposes nothing."""

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.spark.createDataFrame([], schema)

    def field_maps(self, groups: DataFrame, preferred: DataFrame) -> DataFrame:
        return self._table("field_maps", FIELD_MAPS)

    def row_merges(self, groups: DataFrame) -> DataFrame:
        return self._table("row_merges", MERGES)

    def pivots(self, groups: DataFrame) -> DataFrame:
        return self._table("pivots", PIVOTS)

    def merges(self, groups: DataFrame) -> DataFrame:
        return self._table("merges", MERGES)

    def joins(self, groups: DataFrame) -> DataFrame:
        return self._table("joins", JOINS)

    def addresses(self, groups: DataFrame) -> DataFrame:
        return self._table("addresses", ADDRESSES)


#: Normalised names that are parts of an address, in the order of writing.
ADDRESS_PARTS = "street address1 address2 address city town district region state province postcode zip country".split()


def _spelt_alike(fields: str) -> Column:
    """The fields of a group, of those that are alike in camel case the first."""
    names = F.transform(fields, lambda f: camel_case(f["name"]))
    return F.filter(fields, lambda f, i: (F.get(names, i) != "") & (F.array_position(names, F.get(names, i)) == i + 1))


class Rules:
    """Plans by rule: equal names and aliases, equal schemas, numbered columns, known parts of addresses."""

    key = "rules 1"

    def field_maps(self, groups: DataFrame, preferred: DataFrame) -> DataFrame:
        """A field takes the preferred name whose name or alias it equals, compared as letters and digits in lower case."""
        plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
        names = preferred.select("pos", "name", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("also"))
        names = names.groupBy(plain("also").alias("key")).agg(F.min_by("name", "pos").alias("name"))
        fields = groups.select("doc_id", "group_name", F.posexplode("fields").alias("pos", "f")).withColumn("key", plain(F.col("f.name")))
        # The preferred fields are one short list for all documents.
        found = fields.join(names, "key").groupBy("doc_id", "group_name").agg(F.sort_array(F.collect_list(F.struct("pos", F.col("f.name").alias("src"), "name"))).alias("e"))
        return found.select("doc_id", "group_name", F.map_from_entries(F.transform("e", lambda x: F.struct(x["src"], x["name"]))).alias("field_map"))

    def row_merges(self, groups: DataFrame) -> DataFrame:
        """Groups of a document with the same set of camel-cased field names are one table."""
        shape = F.array_join(F.array_sort(F.transform("fields", lambda f: camel_case(f["name"]))), "|")
        order = Window.partitionBy("doc_id", "shape")
        rows = groups.withColumn("shape", shape).where("shape <> ''").withColumn("n", F.count("*").over(order)).where("n >= 2")
        listed = F.sort_array(F.collect_list("group_name"))
        out = rows.groupBy("doc_id", "shape").agg(listed.alias("groups"))
        return out.select("doc_id", F.col("shape").alias("plan_id"), "groups", F.concat(F.get("groups", F.lit(0)), F.lit("-all")).alias("target"), F.lit(None).cast("map<string,map<string,string>>").alias("field_maps"))

    def pivots(self, groups: DataFrame) -> DataFrame:
        """Columns that differ only in a number at the end hold one field."""
        rows = groups.select("doc_id", "group_name", "fields", F.posexplode("fields").alias("pos", "f"))
        stem = F.regexp_extract(F.col("f.name"), r"^(.*[^0-9])\d+$", 1)
        found = rows.withColumn("stem", stem).where("stem <> ''").groupBy("doc_id", "group_name", "stem").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "f.name"))), lambda x: x["name"]).alias("pivot_fields"), F.first("fields").alias("fields")
        )
        first = Window.partitionBy("doc_id", "group_name").orderBy(F.desc(F.size("pivot_fields")), "stem")
        found = found.where(F.size("pivot_fields") >= 2).withColumn("n", F.row_number().over(first)).where("n = 1")
        keep = F.array_except(F.transform("fields", lambda f: f["name"]), "pivot_fields")
        return found.select("doc_id", "group_name", "pivot_fields", F.col("stem").alias("target_field"), keep.alias("keep_fields"), F.col("group_name").alias("target"))

    def merges(self, groups: DataFrame) -> DataFrame:
        """Groups of a document with the same title, but for letter case, marks and a "continued" or number at the end, are one entity; of their fields those spelt alike become one."""
        title = F.regexp_replace(normalise_title(F.col("title")), "( (continued|cont|part|page|[0-9]+))+$", "")
        order = Window.partitionBy("doc_id", "key")
        rows = groups.withColumn("key", title).where("key <> ''").withColumn("n", F.count("*").over(order)).where("n >= 2")
        same = F.transform(_spelt_alike("fields"), lambda f: F.struct(f["name"].alias("src"), camel_case(f["name"]).alias("dst")))
        listed = F.sort_array(F.collect_list(F.struct("group_name", same.alias("pairs"))))
        out = rows.groupBy("doc_id", "key").agg(listed.alias("g"))
        names = F.transform("g", lambda x: x["group_name"])
        maps = F.map_from_entries(F.transform("g", lambda x: F.struct(x["group_name"], F.map_from_entries(x["pairs"]))))
        return out.select("doc_id", F.col("key").alias("plan_id"), names.alias("groups"), F.concat(F.get(names, F.lit(0)), F.lit("-merged")).alias("target"), maps.alias("field_maps"))

    def joins(self, groups: DataFrame) -> DataFrame:
        """Two groups of a document that share a field named like a key (its last word is id, key, code or number) are related by it."""
        fields = groups.select("doc_id", "group_name", F.explode(_spelt_alike("fields")).alias("f"))
        named = fields.select("doc_id", "group_name", F.col("f.name").alias("name"), camel_case(F.col("f.name")).alias("key"))
        keys = named.where(F.rlike("key", F.lit(r"(^|[a-z0-9])(id|Id|ID|key|Key|KEY|code|Code|CODE|number|Number|NUMBER)$")) & (F.length("key") > 3))
        a, b = (keys.select("doc_id", "key", F.col("group_name").alias(side), F.col("name").alias(f"{side}_field")) for side in ("left", "right"))
        # The pairs are those of a document's few groups, never of records.
        pairs = a.join(b, ["doc_id", "key"]).where("left < right")
        on = F.sort_array(F.collect_list(F.struct(F.col("left_field").alias("left"), F.col("right_field").alias("right"))))
        out = pairs.groupBy("doc_id", "left", "right").agg(on.alias("on"))
        return out.select("doc_id", "left", "right", "on", F.lit(None).cast("string").alias("type"), F.lit("shared key field").alias("reason"))

    def addresses(self, groups: DataFrame) -> DataFrame:
        """Two or more fields named like parts of an address make one, in the order of writing."""
        rows = groups.select("doc_id", "group_name", F.explode("fields").alias("f")).withColumn("key", F.replace(normalise_title(F.col("f.name")), F.lit(" "), F.lit("")))
        at = F.array_position(F.array(*map(F.lit, ADDRESS_PARTS)), F.col("key"))
        found = rows.withColumn("at", at).where("at > 0").groupBy("doc_id", "group_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "f.name"))), lambda x: x["name"]).alias("columns"))
        template = F.array_join(F.transform("columns", lambda c: F.concat(F.lit("{"), c, F.lit("}"))), ", ")
        sure = F.when(F.size("columns") >= 3, "high").otherwise("medium")
        return found.where(F.size("columns") >= 2).select("doc_id", "group_name", F.lit(True).alias("has_address"), sure.alias("confidence"), "columns", template.alias("join_template"))


class Fallback:
    """What the first proposer says of a document, and where it says nothing of one, what the second does."""

    def __init__(self, first: Proposer, second: Proposer):
        self.first, self.second = first, second

    def _either(self, name: str, *args: DataFrame) -> DataFrame:
        given, other = (getattr(p, name)(*args) for p in (self.first, self.second))
        rest = other.join(given.select("doc_id").distinct(), "doc_id", "left_anti")
        return given.unionByName(rest, allowMissingColumns=True)

    def field_maps(self, groups: DataFrame, preferred: DataFrame) -> DataFrame:
        return self._either("field_maps", groups, preferred)

    def row_merges(self, groups: DataFrame) -> DataFrame:
        return self._either("row_merges", groups)

    def pivots(self, groups: DataFrame) -> DataFrame:
        return self._either("pivots", groups)

    def merges(self, groups: DataFrame) -> DataFrame:
        return self._either("merges", groups)

    def joins(self, groups: DataFrame) -> DataFrame:
        return self._either("joins", groups)

    def addresses(self, groups: DataFrame) -> DataFrame:
        return self._either("addresses", groups)
