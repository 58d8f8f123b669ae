"""Verification of addresses by calls: a batch of records a call, answers checked and put back by place.

What a record is called and where it is said to be goes out, what the client has
found comes back. Calls are those of ``plans.calls``: what fails is asked again, and the ledger holds all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators import enrich
from tabularium.plans import calls

STAGE = "verify-addresses"
#: What an answer holds: results of any number; what they hold is looked at one by one, as a batch isn't lost for one record.
RULES = [(STAGE, 0, "$", ["object"], True), (STAGE, 1, "$.results", ["array"], True)]
#: Column of a result, and its name in an answer.
FIELDS = {"confidence": "confidence", "matched_name": "matchedName", "matched_address": "matchedAddress", "evidence": "evidence"}
ASKED = "Confirm each entity's address. Answer as JSON: {\"results\": [{\"index\", \"confidence\" (high, medium, low or unknown), \"matchedName\", \"matchedAddress\", \"evidence\"}]}.\n"


@dataclass
class Verified:
    #: The records with ``verification``; without an answer, or without an address to ask about, its confidence is ``unknown``.
    records: DataFrame
    quarantine: DataFrame
    ledger: DataFrame


def record_inputs(records: DataFrame, size: int = 5, name_field: str | None = None) -> DataFrame:
    """``(doc_id, group_name, ord, index, batch, input)`` of records that have an address, by the fields of each record: for records whose groups have no plan."""
    keys = F.transform(F.map_keys("rec"), lambda k: F.struct(k.alias("name")))
    address = enrich.pick_address(F.col("rec"))
    rows = enrich.batches(records.where(address.isNotNull()), size)
    named = enrich.name_field_of(keys, name_field)
    name = F.when(named.isNotNull(), F.create_map(F.lit("name"), F.col("rec")[named])).otherwise(F.create_map().cast("map<string,string>"))
    made = F.map_concat(F.create_map(F.lit("index"), F.col("index").cast("string")), name, F.create_map(F.lit("address"), address))
    return rows.select("doc_id", "group_name", "ord", "index", "batch", made.alias("input"))


def work_of(inputs: DataFrame) -> DataFrame:
    """A row of work for each batch, of which the prompt lists the inputs in order."""
    listed = F.sort_array(F.collect_list(F.struct("index", F.to_json("input").alias("text"))))
    rows = inputs.groupBy("doc_id", "group_name", "batch").agg(listed.alias("inputs"))
    prompt = F.concat(F.lit(ASKED), F.lit("["), F.array_join(F.transform("inputs", lambda i: i["text"]), ","), F.lit("]"))
    return rows.select(batch_key().alias("key"), F.lit(STAGE).alias("stage"), F.lit(None).cast("string").alias("model"), prompt.alias("prompt"))


def batch_key() -> Column:
    """What names a batch's call."""
    return F.to_json(F.array(*(F.col(c).cast("string") for c in ("doc_id", "group_name", "batch"))))


def results_of(accepted: DataFrame) -> DataFrame:
    """``(key, index, confidence, matched_name, matched_address, evidence)``: the results of all answers, of those of one index in an answer the first."""
    rows = accepted.select("key", F.posexplode(F.try_variant_get("value", "$.results", "array<variant>")).alias("pos", "r"))
    texts = [F.try_variant_get("r", f"$.{name}", "string").alias(c) for c, name in FIELDS.items()]
    rows = rows.select("key", F.try_variant_get("r", "$.index", "long").alias("index"), F.struct("pos", *texts).alias("r")).where("index is not null")
    return rows.groupBy("key", "index").agg(F.min("r").alias("r")).select("key", "index", *(f"r.{c}" for c in FIELDS))


def verify(records: DataFrame, inputs: DataFrame, clients: list[calls.Client], rounds: int = 3, partitions: int = 4) -> Verified:
    """``records`` ``(doc_id, group_name, ord, rec, ...)`` with what ``clients`` answer to ``inputs`` (``record_inputs``, or ``enrich.verification_inputs`` where groups have a plan).

    A result of an index that its call didn't ask about is passed over.
    """
    rules = records.sparkSession.createDataFrame(RULES, calls.RULES)
    out = calls.ask_until_valid(work_of(inputs), rules, clients, rounds, partitions)
    asked = inputs.select(batch_key().alias("key"), "index", "doc_id", "group_name", "ord")
    return Verified(enrich.attach_verifications(records, asked.join(results_of(out.accepted), ["key", "index"])), out.quarantine, out.ledger)
