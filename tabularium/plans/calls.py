"""Calls of a model or service as tables: a work list, checked answers, and the ledger of what they used.

A round of calls is one pass over the rows that are still open; its answers and
their usage are written once and then split. Answers are parsed as ``VARIANT``
and held against rules of their stage, which are a table too. What fails is
asked again with the reason, by the next client once the first has had its
rounds, and what no client answers well is a row of the quarantine.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabularium.operators.enrich import TRANSIENT
from tabularium.session import settled

#: What is asked: ``model`` may be null, for a client's own.
WORK = "key string, stage string, model string, prompt string"
#: What an answer must hold at ``path``: one of ``kinds`` (string, number, boolean, array, object, null); what isn't ``required`` may be missing.
RULES = "stage string, rule_ord int, path string, kinds array<string>, required boolean"
ANSWERS = f"{WORK}, attempt int, answer string, error string, input_tokens long, output_tokens long, tries int"
#: Characters of a refused answer that are shown when it is asked again.
SHOWN = 1000


@dataclass
class Client:
    """``call`` gets a row of work with ``attempt`` and returns ``text``, and ``input_tokens`` and ``output_tokens`` where it knows them."""

    call: Callable[[dict], dict]
    model: str | None = None
    suffix: str = ""


def answers(work: DataFrame, client: Client, partitions: int = 4, tries: int = 5, pause: float = 0.5) -> DataFrame:
    """``ANSWERS`` of one round. Calls that are refused for a while are tried again with growing pauses; an exception is an answer with an error."""
    schema = T.StructType.fromDDL(ANSWERS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = re.compile(TRANSIENT, re.IGNORECASE)

        def one(row: dict) -> dict:
            for k in range(1, tries + 1):
                try:
                    got = client.call(row)
                    return row | {"answer": got.get("text"), "error": None, "input_tokens": got.get("input_tokens"), "output_tokens": got.get("output_tokens"), "tries": k}
                except Exception as e:  # noqa: BLE001 - a failed call is a result
                    failed = str(e)
                    if k == tries or not passing.search(failed):
                        break
                    time.sleep(min(30.0, pause * 2 ** (k - 1)) * (1 + random.random() / 2))
            return row | {"answer": None, "error": failed, "input_tokens": None, "output_tokens": None, "tries": k}

        for batch in batches:
            yield pa.RecordBatch.from_pylist([one(row) for row in batch.to_pylist()], schema=arrow)

    rows = work if client.model is None else work.withColumn("model", F.lit(client.model))
    names = [f.name for f in schema if f.name in work.columns]
    return rows.select(*names).repartition(partitions, "key").mapInArrow(run, schema)


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is computed once however often ``f`` names it: within a lambda Spark shares no common parts."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def kind_of(value: Column) -> Column:
    """The kind of a ``VARIANT``, null where there is none."""

    def kind(name: Column) -> Column:
        starts = lambda *words: F.coalesce(*(F.when(F.startswith(name, F.lit(w)), F.lit(True)) for w in words), F.lit(False))
        return (
            F.when(starts("OBJECT"), "object").when(starts("ARRAY"), "array").when(starts("STRING"), "string").when(starts("BOOLEAN"), "boolean").when(starts("VOID"), "null")
            .when(starts("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"), "number").when(name.isNotNull(), F.lower(name))
        )

    return _bound(F.schema_of_variant(value), kind)


def judged(rows: DataFrame, rules: DataFrame, answer_col: str = "answer", stage_col: str = "stage") -> DataFrame:
    """``rows`` with ``value`` (``VARIANT``) and ``reason``, null for a good answer, else the first rule that it breaks.

    Rules, of which there are few, go to the rows by stage; a stage without rules takes any JSON. A row is
    never dropped: it is typed, or it has a reason.
    """
    listed = F.sort_array(F.collect_list(F.struct("rule_ord", "path", "kinds", "required")))
    own = rules.groupBy(F.col("stage").alias("__stage")).agg(listed.alias("__rules"))
    out = rows.join(F.broadcast(own), F.col(stage_col) == F.col("__stage"), "left").withColumn("value", F.try_parse_json(answer_col))

    def broken(rule: Column) -> Column:
        def fault(kind: Column) -> Column:
            wrong = F.concat(rule["path"], F.lit(" is "), kind, F.lit(", not "), F.array_join(rule["kinds"], " or "))
            return F.when(kind.isNull() & rule["required"], F.concat(F.lit("no "), rule["path"])).when(kind.isNotNull() & ~F.array_contains(rule["kinds"], kind), wrong)

        return _bound(kind_of(F.try_variant_get(F.col("value"), rule["path"], "variant")), fault)

    first = F.get(F.filter(F.transform("__rules", broken), lambda r: r.isNotNull()), F.lit(0))
    reason = F.when(F.col(answer_col).isNull(), F.lit("no answer")).when(F.col("value").isNull(), F.lit("not JSON")).otherwise(first)
    return out.withColumn("reason", reason).drop("__stage", "__rules")


def strings_of(value: Column, path: str) -> Column:
    """The texts of an array of a ``VARIANT``; what is no text is left out, a missing array is empty."""
    items = F.filter(F.try_variant_get(value, path, "array<variant>"), lambda x: kind_of(x) == "string")
    return F.coalesce(F.transform(items, lambda x: F.try_variant_get(x, "$", "string")), F.array().cast("array<string>"))


@dataclass
class Outcome:
    #: ``(key, stage, client, attempt, answer, value)``.
    accepted: DataFrame
    #: ``(key, stage, reason, answer, error)``: what no client answered well, with the last reason.
    quarantine: DataFrame
    #: ``(key, stage, model, input_tokens, output_tokens)``: every call that was answered; ``stage`` names fallback and repeats.
    ledger: DataFrame


def ask_until_valid(work: DataFrame, rules: DataFrame, clients: list[Client], rounds: int = 3, partitions: int = 4) -> Outcome:
    """Ask each row until its answer is good, up to ``rounds`` times by each client in turn. A round calls for the rows that are still open, and no others.

    ``work`` has one row per ``key``.
    """
    open_rows = settled(work.select("key", "stage", "model", "prompt"))
    asked = open_rows
    accepted = ledger = None
    last = None
    for client in clients:
        for attempt in range(1, rounds + 1):
            # Judged in the pass that calls, so that later readers of a round don't judge again.
            told = judged(answers(asked.withColumn("attempt", F.lit(attempt)), client, partitions), rules)
            told = settled(told.withColumn("reason", F.coalesce("error", "reason")).drop("value"))
            label = F.concat("stage", F.lit(client.suffix + ("-jsonfix" if attempt > 1 else "")))
            used = told.where("error is null").select("key", label.alias("stage"), "model", "input_tokens", "output_tokens")
            good = told.where("reason is null").select("key", "stage", F.lit(client.suffix).alias("client"), "attempt", "answer", F.try_parse_json("answer").alias("value"))
            accepted, ledger = (good, used) if accepted is None else (accepted.unionByName(good), ledger.unionByName(used))
            last = told.where("reason is not null").select("key", "stage", "reason", "answer", "error")
            if last.isEmpty():
                return Outcome(accepted, last, ledger)
            begun = F.coalesce(F.left("answer", F.lit(SHOWN)), F.lit(""))
            again = F.concat("prompt", F.lit("\n\nAn earlier answer was refused: "), "reason", F.lit("\nIt began with:\n"), begun)
            asked = open_rows.join(last.select("key", "reason", "answer").hint("merge"), "key").withColumn("prompt", again).drop("reason", "answer")
    return Outcome(accepted, last, ledger)
