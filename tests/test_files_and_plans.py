"""Files in and out, proposals, and the program."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from tabularium import cli
from tabularium.operators import enrich, groups
from tabularium.plans import pipeline, proposers
from tabularium.sources import files, render


def test_pages_in(spark, tmp_path):
    for doc, page in (("a", 2), ("a", 10), ("b", 1)):
        folder = tmp_path / doc
        folder.mkdir(exist_ok=True)
        (folder / f"page-{page:03}.html").write_text(f"<p>{doc}\n{page}")
        (folder / f"page-{page:03}.png").write_bytes(bytes([page, 0]))
    (tmp_path / "a" / "notes.txt").write_text("no page")
    html = sorted(map(tuple, files.page_html(spark, str(tmp_path)).collect()))
    assert html == [("a", 2, "<p>a\n2"), ("a", 10, "<p>a\n10"), ("b", 1, "<p>b\n1")]
    images = sorted((r.doc_id, r.page, bytes(r.png)) for r in files.page_images(spark, str(tmp_path)).collect())
    assert images == [("a", 2, b"\x02\0"), ("a", 10, b"\n\0"), ("b", 1, b"\x01\0")]


def test_final_documents(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"groupName": "g", "title": "T", "recommendation": {"summary": "S"}}))
    (tmp_path / "y.json").write_text(json.dumps({"groupName": "h"}))
    assert sorted(map(tuple, files.final_documents(spark, str(tmp_path)).collect())) == [("x.json", "g", "T", "S"), ("y.json", "h", None, None)]
    assert {(r.title, r.summary) for r in files.final_documents(spark, str(tmp_path), title=" N ", summary=" ").collect()} == {("N", "S"), ("N", None)}


def test_files_out(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one\n", 1), ("b", "two", None)], "doc_id string, text string, n int")
    files.write_json(rows, f"{tmp_path}/json")
    assert sorted(json.loads(line)["n"] or 0 for f in (tmp_path / "json").glob("*.json") for line in f.read_text().splitlines()) == [0, 1]
    files.write_texts(rows, "text", f"{tmp_path}/texts")
    assert {p.parent.name for p in (tmp_path / "texts").glob("doc_id=*/part-*")} == {"doc_id=a", "doc_id=b"}
    for _ in range(2):
        files.append_ledger(rows.select("n"), f"{tmp_path}/ledger")
    assert spark.read.json(f"{tmp_path}/ledger").count() == 4


def test_feature_collections(spark, tmp_path):
    rows = spark.range(25).select(F.concat(F.lit('{"type":"Feature","properties":{"n":'), "id", F.lit("}}")).alias("feature"))
    for count in (1, 3):
        files.write_feature_collection(rows, f"{tmp_path}/{count}", count)
        found = [json.loads(p.read_text()) for p in (tmp_path / str(count)).glob("part-*")]
        assert len(found) == count and all(f["type"] == "FeatureCollection" for f in found)
        assert sorted(x["properties"]["n"] for f in found for x in f["features"]) == list(range(25))
    files.write_feature_collection(rows.limit(0), f"{tmp_path}/none", 1)
    assert not [p for p in (tmp_path / "none").glob("part-*") if "Feature\"" in p.read_text()]


def test_truncate(spark):
    out = spark.createDataFrame([({"a": "x" * 300, "b": "y", "c": None},)], "rec map<string,string>").select(groups.truncate(F.col("rec")).alias("r")).first().r
    assert out == {"a": "x" * 240 + "...", "b": "y", "c": None}


def test_ties_between_plans_are_settled_by_what_they_say(spark):
    own = spark.createDataFrame([(1, "g", [("a", "string")])], "doc_id long, group_name string, fields array<struct<name:string,type:string>>")
    maps = [(1, "g", {"a": x}) for x in ("z", "b", "q")]
    found = {groups.rename_plan(own, spark.createDataFrame(order, proposers.FIELD_MAPS)).first().pairs[0].dst for order in (maps, maps[::-1], maps[1:] + maps[:1])}
    assert len(found) == 1


def test_calls_are_repeated_and_counted(spark):
    passing = ["HTTP 503", "HTTP  429", "read ECONNRESET", "connect ECONNREFUSED", "ETIMEDOUT", "fetch failed", "socket hang up", "ENETUNREACH", "UND_ERR_CONNECT", "timed out"]
    lasting = ["HTTP 404", "HTTP503", "bad key"]

    def call(query):
        return {"status": "ERROR", "error": query}

    asked = spark.createDataFrame([(q,) for q in passing + lasting], "query string")
    got = {r.query: r.calls for r in enrich.service_lookup(call, attempts=2, partitions=4)(asked).collect()}
    assert got == {q: 2 for q in passing} | {q: 1 for q in lasting}
    rec = spark.createDataFrame([(k, {"address": q}) for k, q in enumerate(["HTTP 503", "HTTP 503", "bad key", " "])], "ord int, rec map<string,string>")
    meta = enrich.geocode_meta(enrich.geocode(rec, enrich.service_lookup(call, attempts=2))).first().asDict()
    assert {k: int(v) if k != "cost_usd" else float(v) for k, v in meta.items()} == {
        "total": 4, "located": 0, "unique_queries": 2, "api_calls": 3, "retries": 1, "cache_hits": 1, "skipped": 1, "cost_usd": 0.015,
    }


def test_calls_keep_their_distance(spark):
    asked = spark.createDataFrame([(f"q{k}",) for k in range(6)], "query string").coalesce(1)
    began = time.time()
    rows = enrich.service_lookup(lambda q: {"status": "OK", "lat": 1.0, "lng": 2.0}, per_second=5, partitions=1)(asked).collect()
    assert len(rows) == 6 and time.time() - began >= 1.0


def table(title, headers, rows):
    cells = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f'<!-- structured-start:id="{title}" kind="table" title="{title}" --><table><tr>{"".join(f"<th>{h}</th>" for h in headers)}</tr>{cells}</table><!-- structured-end:id="{title}" -->'


def test_proposed_merges_and_joins(spark):
    html = table("Ports", ["Port Code", "Name"], [("1", "Lima"), ("2", "Oslo")]) + table("PORTS, part 2", ["port-code", "Name", "Sea"], [("3", "Riga", "Baltic")])
    html += table("Ships", ["Port Code", "Ship"], [("1", "Ada")]) + table("Other", ["Colour"], [("red",)])
    docs = spark.createDataFrame([(1, html), (2, "no region"), (3, None)], "doc_id long, html string")
    out = pipeline.run(docs)
    assert {r.group_name for r in out.groups.collect()} == {"ports-merged", "ships", "other"}
    assert sorted(r.rec["portCode"] for r in out.records.where("group_name = 'ports-merged'").collect()) == ["1", "2", "3"]
    (join,) = out.joins.collect()
    assert (join.left, join.right, [tuple(x) for x in join.on]) == ("ports-merged", "ships", [("portCode", "portCode")])
    given = pipeline.run(docs, proposer=proposers.GivenPlans(spark))
    assert given.merges.count() == 0 and given.joins.count() == 0 and given.groups.count() == 4
    assert [r.asDict() for r in pipeline.summary(out).collect()] == [
        {"doc_id": 1, "groups": 3, "records": 5, "merges": 1, "joins": 1, "with_address": 0, "prominent": "ports-merged"}
    ]
    assert pipeline.summary(pipeline.run(docs.limit(0))).count() == 0


def test_fallback_speaks_where_the_first_is_silent(spark):
    own = spark.createDataFrame(
        [(d, f"t{k}", "", [("Port code", "string"), ("Size", "number")]) for d in (1, 2) for k in (1, 2)],
        "doc_id long, group_name string, title string, fields array<struct<name:string,type:string>>",
    )
    given = spark.createDataFrame([(1, "p", ["t2", "t1"], "mine", None)], proposers.MERGES)
    plan = proposers.Fallback(proposers.GivenPlans(spark, {"row_merges": given}), proposers.Rules())
    assert sorted((r.doc_id, r.target) for r in plan.row_merges(own).collect()) == [(1, "mine"), (2, "t1-all")]
    assert plan.pivots(own).count() == 0 and plan.joins(own).count() == 2 and plan.addresses(own).count() == 0 and plan.merges(own).count() == 0
    fields = {r.doc_id: [(f.name, f.type) for f in r.fields] for r in groups.merged_fields(own, plan.row_merges(own), camel=True).collect()}
    assert fields == {1: [("portCode", "string"), ("size", "number")], 2: [("portCode", "string"), ("size", "number")]}


def test_program(spark, tmp_path):
    for page, rows in ((1, [("a", "1")]), (2, [("b", "2"), ("c", "3")])):
        folder = tmp_path / "in" / "report"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page-{page:03}.html").write_text(table(f"Page {page}", ["Name", "Size"], rows))
    (tmp_path / "fields.json").write_text('["label"]')
    cli.main([f"{tmp_path}/in", f"{tmp_path}/out", "--fields", f"{tmp_path}/fields.json"])
    got = spark.read.parquet(f"{tmp_path}/out/final").collect()
    assert sorted(r.rec["name"] for r in got) == ["a", "b", "c"]
    assert spark.read.parquet(f"{tmp_path}/out/joins").count() == 0


def test_rendered_tables_are_read_back(spark):
    rows = spark.createDataFrame([(1, 1, "a & b"), (1, 2, "<c>"), (2, 3, "d")], "doc long, k int, v string")
    docs = render.tables(rows, F.col("doc"), "k", [F.col("k").cast("string"), F.col("v")], ["K", "V"], F.lit("T"))
    got = pipeline.extract(docs).select("doc_id", "rec").collect()
    assert sorted((r.doc_id, r.rec["k"], r.rec["v"]) for r in got) == [(1, "1", "a & b"), (1, "2", "<c>"), (2, "3", "d")]
