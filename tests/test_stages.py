"""Stages that are kept: what is reused, what isn't, and what a broken run leaves."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tabularium.plans import pipeline
from tabularium.plans.stages import Stages, content_key
from tabularium.sources import render


def reused(stages: Stages) -> dict[str, bool]:
    return {name: again for name, _, again in stages.told}


def test_keys_are_of_rows_not_of_their_order(spark):
    schema = "a long, b string, m map<string,string>, t timestamp"
    rows = [(1, None, {"x": "1"}, datetime(2024, 1, 1, 0, 0, 0, 1)), (None, "1", None, None), (1, None, {"x": "1"}, datetime(2024, 1, 1, 0, 0, 0, 1)), (2, "", {}, None)]
    key = content_key(spark.createDataFrame(rows, schema))
    assert key == content_key(spark.createDataFrame(rows[::-1], schema).repartition(3).select("t", "m", "b", "a"))
    others = [
        rows[1:], [*rows, rows[0]], [(1, None, {"x": "1"}, datetime(2024, 1, 1, 0, 0, 0, 2)), *rows[1:]], [rows[0], (1, None, None, None), *rows[2:]], [*rows[:3], (2, None, {}, None)], [],
    ]
    keys = [content_key(spark.createDataFrame(r, schema)) for r in others] + [content_key(spark.createDataFrame(rows, schema.replace("a long", "a int")))]
    assert len({key, *keys}) == len(others) + 2
    assert content_key(spark.createDataFrame([(1, 2)], "`a.b` int, c int"))


def test_only_what_depends_on_a_change_is_computed(spark, tmp_path):
    made = []

    def run(rows, least, force=()):
        stages = Stages(spark, str(tmp_path), force)
        source = stages.source(spark.createDataFrame(rows, "k long, v long"))

        def total(frame):
            made.append("total")
            return frame.groupBy("k").agg(F.sum("v").alias("v"))

        def above(frame, least):
            made.append("above")
            return frame.where(F.col("v") >= least)

        totals = stages.stage("total", total, source)
        out = stages.stage("above", above, totals, options={"least": least})
        return reused(stages), Counter(map(tuple, out.frame.collect()))

    rows = [(1, 2), (1, 3), (2, 4)]
    assert run(rows, 5) == ({"total": False, "above": False}, Counter([(1, 5)]))
    assert run(rows[::-1], 5) == ({"total": True, "above": True}, Counter([(1, 5)]))
    assert run(rows, 4) == ({"total": True, "above": False}, Counter([(1, 5), (2, 4)]))
    assert run([*rows, (2, 1)], 5) == ({"total": False, "above": False}, Counter([(1, 5), (2, 5)]))
    assert run(rows, 5) == ({"total": True, "above": True}, Counter([(1, 5)]))
    assert made == ["total", "above", "above", "total", "above"]
    assert run(rows, 5, ("total",)) == ({"total": False, "above": True}, Counter([(1, 5)]))
    assert run([], 5) == ({"total": False, "above": False}, Counter())


def test_a_broken_stage_is_made_again(spark, tmp_path):
    def broken(frame):
        return frame.select(F.raise_error(F.lit("lost")).cast("long").alias("k"))

    stages = Stages(spark, str(tmp_path))
    source = stages.source(spark.range(10).withColumnRenamed("id", "k"))
    with pytest.raises(Exception, match="lost"):
        stages.stage("s", broken, source)
    again = Stages(spark, str(tmp_path))
    assert again.stage("s", lambda f: f, source).frame.count() == 10
    assert reused(again) == {"s": False}


def documents(spark, price: str):
    rows = spark.createDataFrame([(d, n, f"item {n}", price if (d, n) == (1, 1) else "3") for d in range(3) for n in range(4)], "doc long, n long, name string, price string")
    return render.tables(rows, F.col("doc"), "n", [F.col("name"), F.col("price")], ["Item name", "Unit price"], F.lit("Items"))


def test_the_pipeline_reuses_what_a_field_list_does_not_change(spark, tmp_path):
    def run(price, fields, check=False):
        preferred = spark.createDataFrame([(k, n, None, a, None) for k, (n, a) in enumerate(fields)], "pos int, name string, description string, aliases array<string>, type string")
        stages = Stages(spark, str(tmp_path))
        result = pipeline.run(documents(spark, price), preferred, stages=stages)
        rows = lambda f: Counter((r.doc_id, r.group_name, r.ord, tuple(sorted(r.rec.items()))) for r in f.collect())
        if check:
            assert rows(result.final) == rows(pipeline.run(documents(spark, price), preferred).final)
        return reused(stages)

    first = run("2", [("title", ["itemName"])])
    assert len(first) > 5 and not any(first.values())
    changed = run("2", [("label", ["itemName"])], check=True)
    assert {name for name, again in changed.items() if again} == {"extracted", "inferred"}
    assert all(run("2", [("title", ["itemName"])], check=True).values())
