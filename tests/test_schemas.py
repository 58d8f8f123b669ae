"""Types of fields, and schemas that go through the steps with their records."""

from __future__ import annotations

import pytest

from tabularium.operators import groups, schemas
from tabularium.operators.numbering import numbered


def fields_of(frame):
    return {(r.doc_id, r.group_name): [(f.name, f.type) for f in r.fields] for r in frame.collect()}


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-20", None, " "], "integer"), (["1", "2.50", "1e3"], "number"), (["007"], "string"), (["0", "0.5"], "number"), (["2024-02-29"], "date"), (["2023-02-29"], "string"),
        (["true", "FALSE"], "boolean"), (["true", "1"], "string"), ([None, ""], "string"), (["1", "2024-02-29"], "string"), (["NaN"], "string"), (["1d"], "string"), (["1" * 19], "number"),
    ],
)
def test_the_least_type_that_holds_all_values(spark, values, kind):
    rows = [(1, "g", "G", k, {"x": v}) for k, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id long, group_name string, title string, ord long, rec map<string,string>").repartition(3)
    assert fields_of(schemas.infer_groups(frame)) == {(1, "g"): [("x", kind)]}
    (counts,) = schemas.field_types(frame).collect()
    assert counts.type == ("null" if counts.total == 0 else kind)


OWN = "doc_id long, group_name string, title string, fields array<struct<name:string,type:string>>"


def test_types_after_pivots_and_merges(spark):
    own = spark.createDataFrame(
        [
            (1, "a", "A", [("Key No", "integer"), ("p1", "number"), ("p2", "string"), ("note", "date")]), (1, "b", "B", [("keyNo", "string"), ("Extra x", "boolean")]),
            (1, "c", "C", [("z", "string")]), (2, "a", "A", [("z", "date")]), (1, "empty", "E", []),
        ], OWN,
    )
    plan = spark.createDataFrame([(1, "a", ["p1", "p2"], "p", ["Key No", "absent"], "a"), (1, "c", ["z"], "q", [], "never")], "doc_id long, group_name string, pivot_fields array<string>, target_field string, keep_fields array<string>, target string")
    out = fields_of(schemas.pivoted_groups(own, plan))
    assert out[1, "a"] == [("p", "number"), ("Key No", "integer"), ("absent", "string")] and out[1, "c"] == [("z", "string")] and out[1, "empty"] == [] and len(out) == 5
    maps = {"b": {"Extra x": "note"}}
    plan = spark.createDataFrame([(1, "m", ["b", "a", "no"], "c", maps)], "doc_id long, plan_id string, groups array<string>, target string, field_maps map<string,map<string,string>>")
    camel = fields_of(schemas.merged_groups(own, plan, camel=True))
    # A merged group that is called as another one is one with it; in plan order the first type holds.
    assert camel[1, "c"] == [("keyNo", "string"), ("note", "boolean"), ("p1", "number"), ("p2", "string"), ("z", "string")] and (1, "a") not in camel
    assert fields_of(schemas.merged_groups(own, plan, camel=False))[1, "c"][:3] == [("keyNo", "string"), ("note", "boolean"), ("Key No", "integer")]


def test_outer_joins_keep_the_document(spark):
    rec = "doc_id long, ord long, rec map<string,string>"
    left, right = spark.createDataFrame([(1, 0, {"k": "a"})], rec), spark.createDataFrame([(1, 0, {"k": "b"}), (2, 0, {"k": "a"})], rec)
    for how, n in (("full_outer", 3), ("right", 2), ("left", 1), ("inner", 0)):
        out = groups.join_groups(left, right, [("k", "k")], how).collect()
        assert len(out) == n and all(r.doc_id is not None for r in out)


def test_numbers_of_large_groups_equal_the_window(spark):
    """Groups above and below the bound, one of half of all rows, a null key, and a group that ends within a range."""
    rows = [(None if k % 10 == 3 else 1 if k % 2 else k % 40, "a" if k % 3 else "b", (k * 7919) % 4001, f"v{k}") for k in range(4000)]
    frame = spark.createDataFrame(rows, "doc long, kind string, at long, v string").repartition(6)
    want = {r.v: r.n for r in numbered(frame, ["doc", "kind"], ["at"], "n", hot_rows=10**9).collect()}
    for bound in (0, 60, 300):
        got = numbered(frame, ["doc", "kind"], ["at"], "n", hot_rows=bound)
        assert {r.v: r.n for r in got.collect()} == want and got.columns == [*frame.columns, "n"]
    assert numbered(frame.limit(0), ["doc"], ["at"], "n").count() == 0
