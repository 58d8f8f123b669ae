"""Fixtures, edge cases, and properties of the document operators."""

from __future__ import annotations

import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.functions import html, text
from tabularium.operators import enrich, groups, hints, numbering, records, regions, sampling
from tabularium.plans import pipeline, proposers
from tabularium.sources import files
from tabularium.streaming import stitch

LOOSE = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def start(i, kind, title):
    return f'<!-- structured-start:id="{i}" kind="{kind}" title="{title}" -->'


def end(i):
    return f'<!-- structured-end:id="{i}" -->'


# --- text ---


def test_labels(spark):
    labels = ["Net weight", "UNIT_PRICE", "ship-date", "EAN Item Number", "PERU", "  indent", "m__n", "Málaga", "東京", "", None, "c!d", "1999"]
    want = ["netWeight", "uNITPRICE", "shipDate", "eANItemNumber", "pERU", "indent", "mN", "mlaga", "", "", None, "cd", "1999"]
    assert column(spark, labels, text.camel_case) == want
    assert column(spark, ["東京", "Q r"], text.field_name) == ["東京", "qR"]
    assert column(spark, ["UNIT_PRICE", "EAN Number"], lambda c: text.camel_case(c, smart=True)) == ["unitPrice", "eanNumber"]


def test_titles_and_white_space(spark):
    assert column(spark, ["Cocoa Farmer-Groups.", "cocoa  farmer groups", None, "É—x"], text.normalise_title) == ["cocoa farmer groups", "cocoa farmer groups", None, "é x"]
    assert column(spark, ["﻿ a \tb \n", ""], text.tidy) == ["a b", ""]
    assert column(spark, [{"b": "2", "a": "1"}, {}, None], text.schema_key, "map<string,string>") == ["a:1|b:2", "", ""]
    assert column(spark, ["HIGH", "odd", None], lambda c: text.confidence(c, "unknown")) == ["high", "unknown", "unknown"]
    assert column(spark, ["a b/ü'(x)"], text.url_component) == ["a%20b%2F%C3%BC'(x)"]


def test_templates(spark):
    recs = [{"a": "A ", "b": "B", "c": "C"}, {"a": "A", "c": "C"}, {"a": "", "c": "C"}, {"a": "A"}, {}, {"a": "A", "b": None, "c": "C"}]
    want = ["A, B, C", "A, C", "C", "A", "", "A, C"]
    assert column(spark, recs, lambda r: text.fill_template(r, "{a}, {b}, {c}"), "map<string,string>") == want
    assert column(spark, recs, lambda r: text.fill_templates(r, F.lit("{a}, {b}, {c}")), "map<string,string>") == want
    assert column(spark, [{"a": "A", "d": "B"}], lambda r: text.fill_template(r, "{a}, {x}, {y}, {d}"), "map<string,string>") == ["A, , B"]


def test_fences(spark):
    assert column(spark, ["```json\n{}\n```", " plain ", "x ```json\n{}\n```", "```\na\n```\n", None], text.strip_fences) == ["{}", "plain", "x ```json\n{}\n```", "a", None]
    for word in ("html", "json", "javascript", "js", "typescript", "ts", "jsx", "tsx", "JSON", "Html"):
        forms = [f"```{word}\na b\n```", f" ```{word} \r\na b```\n", f"```{word} a b```", f"```{word}\n\na b\n\n``` \n"]
        assert column(spark, forms, text.strip_fences) == ["a b"] * 4
    odd = ["```", "````", "``````", "```python\nx\n```", "```{}```", "```json\n`` ` ``\n```", "a```", "```a", "", "```json\n```js\nx\n```\n```"]
    assert column(spark, odd, text.strip_fences) == ["```", "````", "", "python\nx", "{}", "`` ` ``", "a```", "```a", "", "```js\nx\n```"]


def test_programs(spark):
    """Each forbidden construct by itself, and what only looks like one."""
    programs = {
        "eval()": "eval (1)", "new Function": "new  Function", "Function()": "Function(1)", "dynamic import()": "import ('m')", "require()": "require('m')", "process": "process.exit",
        "globalThis": "globalThis.a", "fetch()": "fetch (u)", "XMLHttpRequest": "XMLHttpRequest;", "child_process": "'child_process'", "__proto__": "a['__proto__']", ".constructor": "b.constructor",
    }
    assert [n for _, n in text.FORBIDDEN] == list(programs)
    told = column(spark, [f"let a;{code}" for code in programs.values()], text.forbidden_reason)
    assert [t.split(" at offset ")[0] for t in told] == [f"forbidden token {n}" for n in programs]
    fine = ["evaluate(1)", "import a from 'b'", "important", "processed", "setTimeout(f)", "a.constructors", "Functional(1)", "fetcher(1)", "", None]
    assert column(spark, fine, text.forbidden_reason) == [None] * len(fine)
    long = "x" * 30 + " \n eval(y) " + "z" * 30
    assert column(spark, [long, "eval("], text.forbidden_reason) == [
        f"forbidden token eval() at offset 33: ...{'x' * 17} eval(y) {'z' * 17}...", "forbidden token eval() at offset 0: ...eval(...",
    ]
    declared = ["function extract(a) {}", "export default  function  extract (a) {}", "export const extract = f", "var extract=1", "let extract\n= 2"]
    other = ["function extractAll(a) {}", "const extracted = 1", "extract(a)", "myfunction extract(", "const extract;", ""]
    assert column(spark, [*declared, *other, None], text.defines_extract) == [True] * len(declared) + [False] * len(other) + [None]


@LOOSE
@given(st.lists(st.text(alphabet="a, \t\u00a0", max_size=12), min_size=1, max_size=20))
def test_clean_commas_leaves_no_stray_comma(spark, values):
    for got in column(spark, values, text.clean_commas):
        assert got == got.strip(" ,") and ",," not in got and "  " not in got


# --- HTML ---


def table(spark, source):
    raw = spark.createDataFrame([(source,)], "v string").select(html.raw_table(F.col("v")).alias("raw"))
    got = raw.select(html.headers_and_rows(F.col("raw")).alias("t")).first().t
    return got["headers"], [list(r) for r in got["rows"] or []]


def test_tables(spark):
    cells = lambda *r: "".join("<tr>" + "".join(f"<td>{c}</td>" for c in x) + "</tr>" for x in r)
    assert table(spark, f"<table><tr><th>Name<th>Country</tr>{cells(('Acme', 'UK'), ('B', 'FR'))}</table>") == (["Name", "Country"], [["Acme", "UK"], ["B", "FR"]])
    assert table(spark, f"<table>{cells(('Name', 'Country'), ('Acme', 'UK'))}</table>") == (["Name", "Country"], [["Acme", "UK"]])
    data = [("PERU", "1", "pier"), ("PERU", "2", "pier"), ("PERU", "3", "pier"), ("PERU", "4", "pier")]
    assert table(spark, f"<table>{cells(*data)}</table>") == ([], [list(r) for r in data])
    assert table(spark, "<table><tr><td>a &amp; b<td> c\n d<tr><td>e</table><table><tr><td>no</table>") == (["a & b", "c d"], [["e"]])
    assert table(spark, "<table><tr><th>A</th></tr><tr><td>1</td></tr><tr><th>B</th><td>2</td></tr></table>") == (["A"], [["1"]])
    assert table(spark, "<p>none</p>") == ([], [])
    assert table(spark, None)[1] == []


def test_pairs_lists_and_text(spark):
    source = "<dl><dt>A:</dt><dd>1</dd><dt>B<dt>C<dd>2</dl><p><b>K:</b> v <i>w</i> <strong>L:</strong>x<br>y</p><b>A:</b> other<b>nolabel</b>"
    assert column(spark, [source, None], html.parse_pairs) == [{"A": "1", "B": "2", "C": "2", "K": "v w", "L": "x"}, None]
    assert column(spark, ["<ul><li>a<li>b <ul><li>c</ul></ul>", ""], html.parse_list) == [["a", "b c", "c"], []]
    page = "<h1>T</h1><p>a  b<br>c<script>var x = '</p>'</script><style>p{}</style><div>d</div><div></div><p>e"
    assert column(spark, [page], html.plain_text) == ["T\n\na b\nc\n\nd\n\ne"]
    assert column(spark, ["<p>a<b> b</b>\n&lt;"], html.strip_tags) == ["a b <"]


# --- regions ---


def plain_regions(source):
    starts = list(re.finditer(r'<!--\s*structured-start:id="([^"]+)"\s+kind="([^"]+)"\s+title="([^"]+)"\s*-->', source))
    ends = list(re.finditer(r'<!--\s*structured-end:id="([^"]+)"\s*-->', source))
    out = []
    for k, s in enumerate(starts):
        stop = starts[k + 1].start() if k + 1 < len(starts) else len(source)
        between = [e for e in ends if s.end() < e.start() < stop]
        own = next((e for e in between if e[1] == s[1]), between[0] if between else None)
        out.append((k, *s.groups(), source[s.end() : own.start() if own else stop]))
    return out


PARTS = st.lists(st.sampled_from([start("a", "table", "T"), start("b", "kv", "$x\\E"), end("a"), end("b"), end("a.b"), "text", "\n", "<!-- ad -->", ""]), max_size=12)


@LOOSE
@given(st.lists(PARTS, min_size=1, max_size=8))
def test_regions_equal_their_definition(spark, sources):
    docs = ["".join(p) for p in sources]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, html string")
    got = [tuple(r) for r in regions.find_regions(frame).orderBy("doc_id", "pos").collect()]
    assert got == [(i, *r) for i, d in enumerate(docs) for r in plain_regions(d)]


def test_regions_of_odd_documents(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "no anchors"), (None, start("x", "table", "T") + "b")], "doc_id long, html string")
    assert [tuple(r) for r in regions.find_regions(frame).collect()] == [(None, 0, "x", "table", "T", "b")]


def test_records_skip_rows_of_another_width(spark):
    body = "<table><tr><th>A b</th><th>A b</th></tr><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>"
    frame = spark.createDataFrame([(1, start("x", "table", "My Table!") + body + end("x"))], "doc_id long, html string")
    out = records.to_groups(records.table_records(regions.find_regions(frame))).collect()
    assert [(r.group_name, r.ord, r.rec) for r in out] == [("my-table", 0, {"aB": "2"})]


def test_stanzas_do_not_overlap(spark):
    lines = "Acme Ltd\n12 High Street\nLondon, UK\nprose\nBrokeco SA\n5 Rue de Paix\nParis, FR\n7 Odd\n8 Even\nOslo, NO\n"
    frame = spark.createDataFrame([(1, lines), (2, None), (3, "")], "doc_id long, text string")
    rows = records.stanzas(frame, [("name", r"\S"), ("street", r"\d"), ("city,country", r"^(.+),\s*([A-Z]{2})$")]).orderBy("ord").collect()
    assert [(r.rec["name"], r.rec["street"], r.rec["city"], r.rec["country"]) for r in rows] == [
        ("Acme Ltd", "12 High Street", "London", "UK"), ("Brokeco SA", "5 Rue de Paix", "Paris", "FR"), ("7 Odd", "8 Even", "Oslo", "NO"),
    ]


# --- groups ---


@LOOSE
@given(st.lists(st.sampled_from(["x", "x2", "y", "X", "x-2"]), min_size=1, max_size=6), st.lists(st.sampled_from(["x", "x2", "y"]), max_size=6))
def test_names_are_suffixed_in_order(spark, fields, targets):
    fields = list(dict.fromkeys(fields))
    field_map = dict(zip(fields, targets))
    used: list[str] = []
    want = {}
    camel = {"x": "x", "x2": "x2", "y": "y", "X": "x", "x-2": "x2"}
    for src, dst in [*field_map.items(), *((f, camel[f]) for f in fields if f not in field_map)]:
        k, name = 2, dst
        while name in used:
            name, k = f"{dst}{k}", k + 1
        used.append(name)
        want[src] = name
    own = spark.createDataFrame([(1, "g", "g", [(f, "string") for f in fields])], "doc_id long, group_name string, title string, fields array<struct<name:string,type:string>>")
    # A JSON text keeps the order of its keys; a Python dict on its way to Spark doesn't.
    mapping = spark.createDataFrame([(1, "g", json.dumps(field_map))], "doc_id long, group_name string, m string").select("doc_id", "group_name", F.from_json("m", "map<string,string>").alias("field_map"))
    pairs = groups.rename_plan(own, mapping).first().pairs
    assert {p.src: p.dst for p in pairs} == want


def test_merge_needs_two_groups_and_leaves_others(spark):
    own = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "doc_id long, group_name string").withColumn("fields", F.array(F.struct(F.lit("x").alias("name"), F.lit("number").alias("type"))))
    rec = spark.createDataFrame([(1, "a", 0, {"x": "1"}), (1, "b", 0, {"x": "2"}), (1, "b", 1, {"Y": "3"}), (2, "a", 0, {"x": "4"})], "doc_id long, group_name string, ord long, rec map<string,string>")
    plan = spark.createDataFrame([(d, "p", ["b", "a", "zz"], "m", {"b": {"x": "z"}}) for d in (1, 2)], proposers.MERGES)
    left, out = groups.merge_groups(own, rec, plan, camel=False)
    assert [tuple(r) for r in left.select("doc_id", "group_name").collect()] == [(2, "a")]
    assert [(r.group_name, r.ord, r.rec) for r in out.orderBy("doc_id", "ord").collect()] == [("m", 0, {"z": "2"}), ("m", 1, {"Y": "3"}), ("m", 2, {"x": "1"}), ("a", 0, {"x": "4"})]
    assert [(f.name, f.type) for f in groups.merged_fields(own, plan).first().fields] == [("z", "number"), ("x", "number")]


def test_hint_continuations(spark):
    schema = "doc_id long, page int, place int, id string, kind string, title string, description string, schema_guess map<string,string>, record_count double, is_continuation boolean, continues_previous string"
    rows = [
        (1, 1, 0, "a", "table", "Sup-pliers", "d", {"n": "string"}, 2.0, False, None), (1, 2, 0, "b", "table", "cont", None, {"m": "string"}, 3.0, True, None),
        (1, 3, 0, "c", "table", "x", None, {"q": "string", "r": "string"}, float("nan"), True, " sup pliers"), (1, 4, 0, "d", "table", "y", None, {"q": "s"}, None, True, "nobody"),
        (1, 5, 0, "a", "list", "sup pliers", "d", {"n": "string"}, 1.0, None, None),
    ]
    out = {r.title: r for r in hints.aggregate_hints(spark.createDataFrame(rows, schema)).collect()}
    assert out["Sup-pliers"].pages == [1, 2, 3, 5] and out["Sup-pliers"].total_records == 6.0
    assert out["Sup-pliers"].sample_ids == ["a", "b", "c"] and out["Sup-pliers"].descriptions == ["d"]
    assert out["y"].pages == [4] and out["y"].total_records == 0


def test_a_join_is_profiled(spark):
    side = lambda vs: spark.createDataFrame([(1, i, {"k": v}) for i, v in enumerate(vs)], "doc_id long, ord long, rec map<string,string>")
    row = groups.profile_join(side(["a", "a", "b", None]), side(["a", "c"]), [("k", "k")]).first()
    assert (row.n_keys, row.left_max, row.right_max, row.matched_keys, row.cardinality) == (3, 2, 1, 1, "many-to-one")


# --- lookups ---


def test_a_service_is_asked_once_for_each_address(spark, tmp_path):
    rows = [(1, 0, {"address": " A "}), (1, 1, {"fullAddress": "A"}), (1, 2, {"address": "bad"}), (1, 3, {"address": " "}), (1, 4, {"address": None})]
    rec = spark.createDataFrame(rows, "doc_id long, ord long, rec map<string,string>")
    log = str(tmp_path / "calls")

    def call(query):
        with open(log, "a") as f:
            f.write(query + "\n")
        if query == "bad":
            raise ValueError("no such place")
        return {"status": "OK", "lat": 1.0, "lng": 2.0}

    found = enrich.geocode(rec, enrich.service_lookup(call, partitions=2)).orderBy("ord").collect()
    assert [r.geocode and (r.geocode.status, r.geocode.lat, r.geocode.error) for r in found] == [("OK", 1.0, None), ("OK", 1.0, None), ("ERROR", None, "no such place"), None, None]
    assert sorted(open(log).read().split()) == ["A", "bad"]


def test_addresses_do_not_replace_fields(spark):
    rec = spark.createDataFrame([(1, "g", i, r) for i, r in enumerate([{"s": "S"}, {"s": "S", "address": "x"}, {"s": "S", "address": "x", "fullAddress": "y"}])], "doc_id long, group_name string, ord long, rec map<string,string>")
    plan = spark.createDataFrame([(1, "g", True, "high", ["s"], "{s}, {t}")], proposers.ADDRESSES)
    out = [r.rec for r in enrich.with_addresses(rec, plan).orderBy("ord").collect()]
    assert [r.get("address") for r in out] == ["S", "x", "x"] and out[1]["fullAddress"] == "S" and out[2]["fullAddress"] == "y" and out[2]["fullAddress2"] == "S"
    own = spark.createDataFrame([(1, "g"), (1, "h")], "doc_id long, group_name string")
    assert {r.group_name: (r.has_address, r.confidence) for r in enrich.complete_address_plan(own, plan).collect()} == {"g": (True, "high"), "h": (False, "none")}
    assert enrich.name_field(["x", "supplier", "title"]) == "title" and enrich.name_field(["x"]) is None and enrich.name_field(["x"], "x") == "x"


# --- samples, stitching ---


def test_samples(spark):
    assert column(spark, ["ab" * 5, "x" * 40, None], lambda c: sampling.sample_text(c, 4, 3, 20)) == [
        "ab" * 5, "--- TEXT HEAD (first 4 of 40 chars) ---\n\nxxxx\n\n--- TEXT TAIL (last 3 of 40 chars) ---\n\nxxx", None,
    ]
    long = start("a", "table", "T") + "y" * 5000 + end("a")
    source = "head" + start("h", "kv", "H") + "in head" + end("h") + long + start("c", "table", "T") + "second" + end("c")
    frame = spark.createDataFrame([(1, source), (2, "plain"), (3, None)], "doc_id long, html string")
    out = {r.doc_id: r for r in sampling.extractor_sample(frame, head=120).collect()}
    assert out[1].regions == 2 and "chars omitted" in out[1].sample and "second" not in out[1].sample
    assert out[2].sample == "plain" and out[2].regions == 0 and out[3].sample is None


def test_remembered_lines_and_diffs():
    assert stitch.remember(["a", "b"], " a ") == ["b", "a"]
    assert stitch.remember(["a", "b"], "c", 2) == ["b", "c"] and stitch.remember(["a"], "  ") == ["a"]
    assert stitch.apply_diff("abcdef", "X", "Y", 2) == "abcdYX" and stitch.apply_diff("abc", "X", None, 2) == "abcX" and stitch.apply_diff("abc", "X", "Y", 0) == "abcX"


DIFFS = "doc_id long, page long, append string, tail_replacement string, new_header string, new_footer string"


@LOOSE
@given(st.lists(st.tuples(st.text("ab ", max_size=9), st.none() | st.text("xy", max_size=5), st.none() | st.sampled_from("HIJK")), min_size=1, max_size=12), st.integers(0, 6))
def test_stitching_equals_its_fold(spark, pages, tail):
    whole, headers = "", []
    for append, replacement, header in pages:
        whole, headers = stitch.apply_diff(whole, append, replacement, tail), stitch.remember(headers, header)
    rows = [(1, k, a, r, h, None) for k, (a, r, h) in enumerate(pages)]
    out = stitch.stitch(spark.createDataFrame(rows[::-1], DIFFS), tail=tail).first()
    assert (out.pages, out.stitched, out.headers) == (len(pages), whole, headers)


# --- files, plans, pipeline ---


def test_files(spark, tmp_path):
    (tmp_path / "h" / "d1").mkdir(parents=True)
    (tmp_path / "h/d1/page-2.json").write_text('{"structuredHints": [{"id": "a", "kind": "table", "title": "T", "recordCountApprox": 3}]}')
    (tmp_path / "h/d1/page-10.json").write_text('{"page": 7, "structuredHints": []}')
    (tmp_path / "h/d1/bad.json").write_text("{not json")
    rows = files.page_hints(spark, str(tmp_path / "h")).collect()
    assert [(r.doc_id, r.page, r.id, r.record_count) for r in rows] == [("d1", 2, "a", 3.0)]
    (tmp_path / "fields.json").write_text('["name", {"name": "city", "aliases": ["town"]}]')
    assert [(r.name, r.aliases) for r in files.preferred_fields(spark, str(tmp_path / "fields.json")).orderBy("pos").collect()] == [("name", None), ("city", ["town"])]
    (tmp_path / "bad.json").write_text('[{"aliases": []}]')
    with pytest.raises(Exception, match="lacks a name"):
        files.preferred_fields(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "r").mkdir()
    (tmp_path / "r/a.json").write_text('[{"x": 1}]')
    (tmp_path / "r/b.json").write_text('{"records": [{"x": "2"}, {"y": null}]}')
    (tmp_path / "r/c.json").write_text("{}")
    assert [(r.file, r.ord, r.rec) for r in files.record_files(spark, str(tmp_path / "r")).orderBy("file", "ord").collect()] == [("a.json", 0, {"x": "1"}), ("b.json", 0, {"x": "2"}), ("b.json", 1, {"y": None})]


def test_pipeline_by_rules(spark):
    rows = lambda *r: "".join("<tr>" + "".join(f"<td>{c}</td>" for c in x) + "</tr>" for x in r)
    one = start("a", "table", "Suppliers") + f"<table><tr><th>Company<th>Street<th>Town<th>Country</tr>{rows(('Acme', 'S1', 'London', 'UK'))}</table>" + end("a")
    two = start("b", "table", "Suppliers 2") + f"<table><tr><th>Company<th>Street<th>Town<th>Country</tr>{rows(('B', 'S2', 'Paris', 'FR'), ('C', 'S3', '', 'NO'))}</table>" + end("b")
    kv = start("c", "kv", "Facts") + "<b>Year:</b> 2020" + end("c")
    docs = spark.createDataFrame([(1, one + kv + two), (2, "nothing"), (3, None)], "doc_id long, html string")
    preferred = spark.createDataFrame([(0, "name", ["company"]), (1, "city", ["town"])], "pos int, name string, aliases array<string>")
    result = pipeline.run(docs, preferred)
    out = result.final.orderBy("ord").collect()
    assert [(r.doc_id, r.rec["name"], r.rec["city"], r.rec["address"]) for r in out] == [(1, "Acme", "London", "S1, London, UK"), (1, "B", "Paris", "S2, Paris, FR"), (1, "C", "", "S3, NO")]
    assert [(r.group_name, r.rank) for r in result.ranking.orderBy("rank").collect()] == [("suppliers-all", 1), ("facts", 2)]
    given = pipeline.run(docs, preferred, proposers.GivenPlans(spark))
    assert {r.group_name for r in given.groups.collect()} == {"suppliers", "suppliers-2", "facts"}
    assert pipeline.run(docs.limit(0)).final.count() == 0


def test_samples_broadcast_no_regions(spark):
    html = F.concat(F.lit('<!-- structured-start:id="1" kind="text" title="t" -->'), F.repeat(F.lit("long "), 100), F.lit('<!-- structured-end:id="1" -->'))
    frame = spark.range(5).select(F.col("id").alias("doc_id"), html.alias("html"))
    out = sampling.extractor_sample(frame)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.regions for r in out.collect()] == [1] * 5


def test_large_groups_are_not_joined_by_key(spark):
    rows = spark.createDataFrame([(i % 2, i) for i in range(50)], "k int, o int")
    out = numbering.numbered(rows, ["k"], ["o"], "n", hot_rows=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.k, r.o, r.n) for r in out.collect()} == {(i % 2, i, i // 2) for i in range(50)}
