"""Work lists, checked answers and ledgers of calls."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabularium import queries
from tabularium.plans import calls

RULES_ROWS = [("s", 0, "$", ["object"], True), ("s", 1, "$.append", ["string"], True), ("s", 2, "$.tail", ["string", "null"], False), ("s", 3, "$.n", ["number"], True)]


def test_answers_are_typed_or_have_a_reason(spark):
    rules = spark.createDataFrame(RULES_ROWS, calls.RULES)
    cases = {
        '{"append": "x", "n": 1}': None, '{"append": "x", "tail": null, "n": 1.5}': None, '{"append": "x", "tail": 3, "n": 1}': "$.tail is number, not string or null", '{"append": 1}': "$.append is number, not string",
        '{"n": 1}': "no $.append", "[1]": "$ is array, not object", "{": "not JSON", '{"append": "x", "n": true}': "$.n is boolean, not number", '{"append": "x", "n": {}}': "$.n is object, not number",
    }
    frame = spark.createDataFrame([("s", a) for a in cases] + [("s", None), ("other", "3")], "stage string, answer string")
    got = {(r.stage, r.answer): r.reason for r in calls.judged(frame, rules).drop("value").collect()}
    assert got == {("s", a): reason for a, reason in cases.items()} | {("s", None): "no answer", ("other", "3"): None}
    sources = spark.createDataFrame([('{"s": ["a", 1, null, {"b": "c"}, "d"]}',), ("{}",), ('{"s": "a"}',)], "t string")
    assert [r.x for r in sources.select(calls.strings_of(F.try_parse_json("t"), "$.s").alias("x")).collect()] == [["a", "d"], [], []]


def test_only_what_failed_is_asked_again(spark, tmp_path):
    log = tmp_path / "log"

    def first(row):
        with open(log, "a") as f:
            f.write(json.dumps([row["key"], row["attempt"], "refused" in row["prompt"]]) + "\n")
        if row["key"] == "twice" and row["attempt"] < 3:
            return {"text": "{" if row["attempt"] == 1 else "[]", "input_tokens": 5, "output_tokens": 2}
        if row["key"] == "never" or row["key"] == "second":
            raise ValueError("it is broken")
        return {"text": '{"append": "a", "n": 1}', "input_tokens": 5}

    def busy(row):
        with open(tmp_path / row["key"], "a") as f:
            f.write("x")
        if row["key"] == "second" and len(open(tmp_path / "second").read()) < 3:
            raise ConnectionError("HTTP 503")
        return {"text": '{"append": "b", "n": 2}' if row["key"] == "second" else "no", "input_tokens": 1, "output_tokens": 1}

    work = spark.createDataFrame([(k, "s", "m1", "p") for k in ("good", "twice", "never", "second")], calls.WORK)
    out = calls.ask_until_valid(work, spark.createDataFrame(RULES_ROWS, calls.RULES), [calls.Client(first), calls.Client(busy, "m2", "-fallback")], rounds=3)
    assert {(r.key, r.client, r.attempt) for r in out.accepted.drop("value").collect()} == {("good", "", 1), ("twice", "", 3), ("second", "-fallback", 1)}
    assert [(r.key, r.reason, r.answer) for r in out.quarantine.collect()] == [("never", "not JSON", "no")]
    asked = [json.loads(x) for x in open(log)]
    assert sorted(map(tuple, asked)) == sorted([("good", 1, False)] + [(k, a, a > 1) for k in ("never", "second", "twice") for a in (1, 2, 3)])
    ledger = sorted((r.key, r.stage, r.model, r.input_tokens, r.output_tokens) for r in out.ledger.fillna(-1).collect())
    assert ledger == [
        ("good", "s", "m1", 5, -1), ("never", "s-fallback", "m2", 1, 1), ("never", "s-fallback-jsonfix", "m2", 1, 1), ("never", "s-fallback-jsonfix", "m2", 1, 1), ("second", "s-fallback", "m2", 1, 1),
        ("twice", "s", "m1", 5, 2), ("twice", "s-jsonfix", "m1", 5, -1), ("twice", "s-jsonfix", "m1", 5, 2),
    ]


def test_an_answer_is_looked_at_once_for_a_rule(spark):
    rules = spark.createDataFrame(RULES_ROWS, calls.RULES)
    frame = spark.createDataFrame([("s", "{}")], "stage string, answer string")
    plan = calls.judged(frame, rules)._jdf.queryExecution().analyzed().toString()
    assert plan.count("schema_of_variant(") == plan.count("variant_get(") == 1


def test_no_work(spark):
    out = calls.ask_until_valid(spark.createDataFrame([], calls.WORK), spark.createDataFrame([], calls.RULES), [calls.Client(lambda row: {})])
    assert out.accepted.count() == out.quarantine.count() == out.ledger.count() == 0


def test_a_refused_batch_is_verified_when_asked_again(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("s_name"), F.lit(0).alias("s_nationkey"))
    rows.write.parquet(str(tmp_path / "supplier.parquet"))
    got = {r.suppkey: (r.confidence, r.matched_name, r.calls) for r in queries.verified_by_calls(spark, str(tmp_path)).collect()}
    # Of those with an address, the eleventh to the fifteenth are the third batch.
    assert got[13] == ("high", "S13", 2) and got[14] == ("low", "S14", 2) and got[1] == ("high", "S1", 1) and got[5] == ("unknown", None, 0)
    # Seven batches of 32 records, of which the third and the sixth are asked twice.
    assert sum(calls for _, _, calls in got.values()) == 32 + 10
