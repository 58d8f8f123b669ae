"""Addresses of records, their verification and their places.

A lookup is made once for each distinct address: addresses are made distinct,
looked up, and joined back many-to-one, so a remote service sees no address twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabularium.functions.text import confidence, fill_templates, not_blank
from tabularium.operators.groups import plan_order
from tabularium.operators.numbering import numbered

#: Fields that hold a record's name, by preference.
NAME_FIELDS = (
    "name",
    "fullName",
    "title",
    "company",
    "companyName",
    "organisation",
    "organization",
    "supplier",
    "supplierName",
    "producer",
    "producerName",
    "farmerGroup",
    "group",
    "groupName",
)
#: Errors that pass: first the fixed values of web clients, then what Python's own say.
TRANSIENT = r"HTTP\s+(408|429|5\d{2})|ECONN|ETIMEDOUT|fetch failed|socket hang up|ENETUNREACH|UND_ERR|timed out|Connection (reset|refused|aborted)"
#: What a lookup returns for each query.
GEOCODE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("query", "status", "formatted_address")]
    + [T.StructField(c, T.DoubleType()) for c in ("lat", "lng")]
    + [T.StructField(c, T.StringType()) for c in ("place_id", "location_type")]
    + [T.StructField("partial_match", T.BooleanType()), T.StructField("types", T.ArrayType(T.StringType()))]
    + [T.StructField("error", T.StringType()), T.StructField("calls", T.IntegerType())]
)


def name_field(fields: list[str], override: str | None = None) -> str | None:
    """The field with the entity's name."""
    if override and override in fields:
        return override
    return next((f for f in NAME_FIELDS if f in fields), None)


def name_field_of(fields: Column, override: str | None = None) -> Column:
    """``name_field`` for a column of fields (name, type), so that each group of each document has its own; null where there is none."""
    names = F.transform(fields, lambda f: f["name"])
    wanted = [*([override] if override else []), *NAME_FIELDS]
    return F.get(F.filter(F.array(*map(F.lit, wanted)), lambda n: F.array_contains(names, n)), F.lit(0))


def with_addresses(records: DataFrame, plan: DataFrame) -> DataFrame:
    """Records with an address field filled from their group's template, and ``address_field``, its name (null where nothing is filled).

    ``plan`` has ``(doc_id, group_name, has_address, join_template, columns,
    confidence)``, of which the first row by ``plan_ord`` holds for a group. The
    field is ``address``, or ``fullAddress`` where the record has an ``address``,
    and then with a number if there is a ``fullAddress`` too.
    """
    first = Window.partitionBy("doc_id", "group_name").orderBy(*plan_order(plan))
    best = plan.withColumn("__n", F.row_number().over(first)).where("__n = 1").select("doc_id", "group_name", "has_address", "join_template", "columns")
    usable = F.coalesce(F.col("has_address") & (F.col("join_template") != "") & (F.size("columns") > 0), F.lit(False))
    rows = records.join(best, ["doc_id", "group_name"], "left")
    has = lambda n: F.map_contains_key("rec", F.lit(n))
    name = F.when(~has("address"), "address").when(~has("fullAddress"), "fullAddress").otherwise("fullAddress2")
    filled = F.map_concat("rec", F.create_map(name, fill_templates(F.col("rec"), F.col("join_template"))))
    rows = rows.withColumn("address_field", F.when(usable, name))
    return rows.withColumn("rec", F.when(usable, filled).otherwise(F.col("rec"))).drop("has_address", "join_template", "columns")


def complete_address_plan(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """A row for every group: the first one proposed, else one that says there is no address."""
    order = Window.partitionBy("doc_id", "group_name").orderBy(*plan_order(plan))
    best = plan.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "plan_ord")
    out = groups.select("doc_id", "group_name").join(best, ["doc_id", "group_name"], "left")
    return out.withColumns({"has_address": F.coalesce("has_address", F.lit(False)), "confidence": confidence(F.col("confidence"))})


def pick_address(record: Column, matched: Column | None = None) -> Column:
    """The first of the verified address, ``address`` and ``fullAddress`` that isn't blank, stripped."""
    tries = [not_blank(record["address"]), not_blank(record["fullAddress"])]
    return F.coalesce(*([not_blank(matched)] if matched is not None else []), *tries)


def geocode(records: DataFrame, lookup: Callable[[DataFrame], DataFrame], address: Column | None = None) -> DataFrame:
    """``records`` with ``geocode``, a struct of ``GEOCODE``; null for records without an address.

    ``lookup`` takes a table of distinct ``query`` and returns the columns of ``GEOCODE``, one row for each.
    """
    rows = records.withColumn("__query", pick_address(F.col("rec")) if address is None else address)
    known = rows.where("__query is not null")
    found = lookup(known.select(F.col("__query").alias("query")).distinct()).select(F.col("query").alias("__query"), F.struct(*GEOCODE.names).alias("geocode"))
    joined = known.join(found, "__query", "left")
    # Rows without an address would all meet on one key of the join.
    rest = rows.where("__query is null").withColumn("geocode", F.lit(None).cast(joined.schema["geocode"].dataType))
    return joined.unionByName(rest).drop("__query")


def gazetteer_lookup(gazetteer: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A lookup in a table ``(query, formatted_address, lat, lng)`` with one row per query; what isn't there has status ZERO_RESULTS.

    Further columns of ``GEOCODE`` are taken if the table has them. Each query counts as one call.
    """
    own = {"status": F.when(F.col("lat").isNull(), "ZERO_RESULTS").otherwise("OK"), "calls": F.lit(1)}

    def column(field: T.StructField) -> Column:
        given = own.get(field.name, F.col(field.name) if field.name in gazetteer.columns else F.lit(None))
        if field.name == "partial_match":
            given = F.coalesce(given, F.lit(False))
        elif field.name == "types":
            given = F.coalesce(given, F.array().cast("array<string>"))
        return given.cast(field.dataType).alias(field.name)

    return lambda asked: asked.join(gazetteer, "query", "left").select(*map(column, GEOCODE))


def service_lookup(call: Callable[[str], dict], per_second: float | None = None, attempts: int = 5, partitions: int = 4) -> Callable[[DataFrame], DataFrame]:
    """A lookup by a function of one query, such as a client of a remote service, in ``partitions`` tasks at most at once.

    ``call`` returns ``status`` and what else it has of ``GEOCODE``. Calls that are
    refused for a while (408, 429, 5xx, lost connections) are repeated with growing
    pauses; ``per_second`` bounds the calls of all tasks together. An exception
    is a row of status ERROR.
    """
    arrow = to_arrow_schema(GEOCODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import random
        import re
        import time

        gap, ready = (partitions / per_second if per_second else 0.0), 0.0
        passing = re.compile(TRANSIENT, re.IGNORECASE)

        def one(query: str) -> dict:
            nonlocal ready
            for k in range(attempts):
                time.sleep(max(0.0, ready - time.monotonic()))
                ready = time.monotonic() + gap
                try:
                    row = call(query)
                except Exception as e:  # noqa: BLE001 - a failed call is a result
                    row = {"status": "ERROR", "error": str(e)}
                again = row.get("status") in ("OVER_QUERY_LIMIT", "UNKNOWN_ERROR") or row.get("status") == "ERROR" and passing.search(row.get("error") or "")
                if not again or k + 1 == attempts:
                    return {"partial_match": False, "types": []} | row | {"calls": k + 1}
                time.sleep(min(30.0, 2.0**k) + random.random() / 2)
            raise AssertionError

        for batch in batches:
            found = [{"query": q} | one(q) for q in batch.column("query").to_pylist()]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in arrow.names} for r in found], schema=arrow)

    return lambda asked: asked.repartition(partitions, "query").mapInArrow(run, GEOCODE)


def geocode_meta(geocoded: DataFrame, per_thousand: float = 5.0) -> DataFrame:
    """One row: ``total, located, unique_queries, api_calls, retries, cache_hits, skipped, cost_usd``. Repeated calls cost too."""
    found = geocoded.select("geocode.query", "geocode.calls", F.col("geocode.lat").isNotNull().alias("located"), F.col("geocode").isNull().alias("skipped"))
    # Records of one query are put together first, a row for each query remains.
    per_query = found.groupBy("query").agg(F.count("*").alias("n"), F.count_if("located").alias("located"), F.count_if("skipped").alias("skipped"), F.max("calls").alias("calls"))
    n, asked = F.sum("n"), F.count("query")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    meta = per_query.agg(
        total("n").alias("total"), total("located").alias("located"), asked.alias("unique_queries"), total("calls").alias("api_calls"),
        (total("calls") - F.count("calls")).alias("retries"), (F.coalesce(n, F.lit(0)) - total("skipped") - asked).alias("cache_hits"), total("skipped").alias("skipped"),
    )
    return meta.withColumn("cost_usd", (F.col("api_calls") / 1000 * per_thousand).cast("decimal(18,6)"))


def features(geocoded: DataFrame, keep: tuple[str, ...] = ("doc_id", "ord")) -> DataFrame:
    """``(*keep, feature)``: a GeoJSON point, as text, of each record with a place; its properties are the record and the lookup's fields, which win over equal names."""
    found = geocoded.where("geocode.lat is not null and geocode.lng is not null")
    given = {"formattedAddress": "formatted_address", "placeId": "place_id", "locationType": "location_type", "partialMatch": "partial_match", "geocodeStatus": "status"}
    own = F.to_json(F.map_filter("rec", lambda k, v: ~k.isin(*given, "geocode")))
    more = F.to_json(F.struct(*(F.col(f"geocode.{v}").alias(k) for k, v in given.items())), {"ignoreNullFields": "false"})
    found = found.select(*keep, F.array("geocode.lng", "geocode.lat").alias("at"), own.alias("own"), more.alias("more"))
    properties = F.when(F.col("own") == "{}", F.col("more")).otherwise(F.concat(F.expr("left(own, length(own) - 1)"), F.lit(","), F.substring("more", 2, 1 << 30)))
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.col("at").alias("coordinates")))
    return found.select(*keep, F.concat(F.lit('{"type":"Feature","geometry":'), point, F.lit(',"properties":'), properties, F.lit("}")).alias("feature"))


def batches(records: DataFrame, size: int = 5) -> DataFrame:
    """Records with ``index`` over a group's records and ``batch``: what one call gets."""
    rows = numbered(records, ["doc_id", "group_name"], ["ord"], "index")
    return rows.withColumn("batch", F.floor(F.col("index") / size))


def verification_inputs(records: DataFrame, groups: DataFrame, plan: DataFrame, size: int = 5, override: str | None = None) -> DataFrame:
    """What a verifier is told of each record with an address: ``(doc_id, group_name, ord, index, batch, input)``.

    ``input`` has ``index``, ``name`` where the group has a name field,
    ``address`` (what ``with_addresses`` has filled, in the field that it names)
    and the columns that the address is made of. ``plan`` has a row per group, see ``complete_address_plan``.
    """
    own = groups.select("doc_id", "group_name", name_field_of(F.col("fields"), override).alias("__name"))
    told = plan.where("has_address").select("doc_id", "group_name", F.col("columns").alias("__columns"))
    rows = batches(records.join(told, ["doc_id", "group_name"]), size).join(own, ["doc_id", "group_name"])
    r = F.col("rec")
    address = r[F.coalesce("address_field", F.lit("address"))]
    parts = F.map_filter(r, lambda k, v: F.array_contains("__columns", k) & ~k.isin("index", "name", "address"))
    name = F.when(F.col("__name").isNotNull(), F.create_map(F.lit("name"), r[F.col("__name")])).otherwise(F.create_map().cast("map<string,string>"))
    made = F.map_concat(F.create_map(F.lit("index"), F.col("index").cast("string")), name, F.create_map(F.lit("address"), address), parts)
    return rows.select("doc_id", "group_name", "ord", "index", "batch", made.alias("input"))


def attach_verifications(records: DataFrame, found: DataFrame) -> DataFrame:
    """Records with ``verification``, by place; without one its confidence is ``unknown``. ``found``: ``(doc_id, group_name, ord, confidence, ...)``."""
    given = found.select("doc_id", "group_name", "ord", F.struct(confidence(F.col("confidence"), "unknown").alias("confidence"), "matched_name", "matched_address", "evidence").alias("verification"))
    rows = records.join(given, ["doc_id", "group_name", "ord"], "left")
    nothing = F.struct(F.lit("unknown").alias("confidence"), *(F.lit(None).cast("string").alias(c) for c in ("matched_name", "matched_address", "evidence")))
    return rows.withColumn("verification", F.coalesce("verification", nothing))


def confidence_histogram(verified: DataFrame) -> DataFrame:
    """``(doc_id, high, medium, low, unknown)``; zeros are kept."""
    return verified.groupBy("doc_id").agg(*(F.count_if(F.col("verification.confidence") == c).alias(c) for c in ("high", "medium", "low", "unknown")))
