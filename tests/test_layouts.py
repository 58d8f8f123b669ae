"""Mined stanzas against a plain search, and extraction by a table of rules."""

from __future__ import annotations

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium import queries
from tabularium.operators import regions, specs
from tabularium.plans import stanza_mining
from tabularium.session import dealt

LOOSE = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def plain_shape(line):
    s = re.sub(r"[^ ,:;|/]*\d[^ ,:;|/]*", "0", re.sub(r"\s+", " ", line.strip()))
    s = re.sub(r"[^ ,:;|/.!?0-9]*[^\W\d_][^ ,:;|/.!?0-9]*", "a", s)
    return re.sub("0( 0)+", "0", re.sub("a( a)+", "a", s))


def plain_mine(text, least=3, most=5):
    shapes = [plain_shape(x) for x in text.split("\n")]
    ok = [s != "" and len(s) <= 40 and s[-1] not in ".!?" for s in shapes]
    found = defaultdict(list)
    for i in range(len(shapes)):
        for k in range(1, most + 1):
            run = tuple(shapes[i : i + k])
            if len(run) < k or not all(ok[i : i + k]) or any(run[:b] == run[k - b :] for b in range(1, k)):
                continue
            fields = len(re.findall("[a0]", run[0]))
            if (re.search("[,:;|/]", run[0]) and fields >= 2) if k == 1 else any(re.search("[0,:;|/]", s) for s in run):
                found[run].append(i)
    order = sorted((r for r in found if len(found[r]) >= least), key=lambda r: (-len(found[r]) * len(r), -len(r), found[r][0]))
    owner = {}
    for place, run in enumerate(order):
        for i in found[run]:
            for line in range(i, i + len(run)):
                owner.setdefault(line, place)
    out = {}
    for place, run in enumerate(order):
        whole = [i for i in found[run] if all(owner[x] == place for x in range(i, i + len(run)))]
        if len(whole) >= least:
            out["\n".join(run)] = (len(whole), whole[0])
    return out


LINES = st.sampled_from(["Acme Ltd", "12 High Street", "London, UK", "", "A sentence.", "x | 5 | y", "Name: Bob", "7", "-", "École 9, B", "a b c d"])


@LOOSE
@given(st.lists(st.lists(LINES, max_size=30), min_size=1, max_size=6))
def test_mining_equals_a_plain_search(spark, docs):
    rows = [(k, "\n".join(lines)) for k, lines in enumerate(docs)]
    got = defaultdict(dict)
    for r in stanza_mining.mine_stanzas(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id][r.shapes] = (r.approx_count, r.first_line)
    assert [got[k] for k, _ in rows] == [plain_mine(t) for _, t in rows]


def test_texts_are_read_once_and_sentences_get_no_shape(spark):
    mined = stanza_mining.mine_stanzas(spark.createDataFrame([(1, "a: b\nA sentence.")], "doc_id long, text string"))
    assert str(mined._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 1
    lines = ["A sentence.", "It costs 5.", "5. five!", "x | 5. y?  \t", "Town, UK.", ".", "a.b", "No. 5", " ", "Ende!\r", "\u2028Fin.", "7,.", "7;3.!", "\xa0é?\xa0"]
    kept = spark.createDataFrame([("\n".join(lines),)], "t string").select(F.split(F.regexp_replace("t", stanza_mining.SENTENCE, ""), "\n")).first()[0]
    assert kept == ["" if plain_shape(x)[-1:] in tuple(".!?") else x for x in lines]


def test_stanzas_in_prose_are_found_and_extracted(spark):
    blocks = [("Acme Ltd", "12 High Street", "London, UK"), ("Brokeco SA", "5 Rue de Paix", "Paris, FR"), ("Caro Foods", "99 Marina Bay", "Singapore, SG"), ("Dora Cocoa", "1 Avenida Brasil", "Sao Paulo, BR")]
    text = "Approved Suppliers 2023\nBelow is a list of approved suppliers.\n\n" + "\n\n".join("\n".join(b) for b in blocks) + "\n\nEnd of list."
    kinds = "\n".join(f"Name: n{k}; Town: t" for k in "abc")
    frame = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "one\ntwo"), (5, kinds)], "doc_id long, text string")
    mined = stanza_mining.mine_stanzas(frame)
    told = {r.doc_id: r for r in mined.collect()}
    assert set(told) == {1, 5} and (told[1].name, told[1].size, told[1].shapes, told[1].approx_count, told[1].first_line) == ("stanza-1", 3, "a\n0 a\na, a", 4, 3)
    assert [f.name for f in told[1].fields] == ["line1", "line2a,line2b", "line3a,line3b"]
    out = stanza_mining.stanza_records(frame, mined).where("doc_id = 1").orderBy("ord").collect()
    assert [(r.rec["line1"], f"{r.rec['line2a']} {r.rec['line2b']}", f"{r.rec['line3a']}, {r.rec['line3b']}") for r in out] == blocks
    # The same as a rule for a region of text.
    html = spark.createDataFrame([(1, '<!-- structured-start:id="t" kind="text" title="stanza-1" -->' + text.replace("\n", "<br>"))], "doc_id long, html string")
    rows = specs.records_by_spec(regions.find_regions(html), stanza_mining.as_specs(mined)).orderBy("row").collect()
    assert [r.rec for r in rows] == [r.rec for r in out] and {r.group_name for r in rows} == {"stanza-1"}


def test_patterns_match_what_they_were_made_from(spark):
    lines = ["Acme Ltd", "12 High Street", "a.b 7-8, (x) #3 | é", "No. 5/6: done; ok", "St. James 1", "* item - 3", "100 % of 20", "x\\Ey, 1"]
    one = spark.createDataFrame([(x,) for x in lines], "line string").select("line", stanza_mining.pattern_of(stanza_mining.shape(F.col("line"))).alias("p"))
    assert all(r.ok for r in one.select(F.expr("rlike(line, p)").alias("ok")).collect())


def test_the_most_special_rule_holds(spark):
    part = lambda key, kind, title, body: f'<!-- structured-start:id="{key}" kind="{kind}" title="{title}" -->{body}<!-- structured-end:id="{key}" -->'
    table = "<table><tr><td>Name</td><td>Name</td><td>x y</td></tr><tr><td>Name</td><td>b</td><td>c</td></tr><tr><td>Name</td><td>d</td><td>e</td></tr><tr><td>1</td></tr></table>"
    html = part(1, "table", "T", table) + part(2, "list", "L", "<ul><li>a</li><li>b</li></ul>") + part(3, "odd", "O", "<p>nothing</p>")
    docs = spark.createDataFrame([(1, html), (2, html), (None, html)], "doc_id long, html string")
    found = regions.find_regions(docs)

    def out(*rules):
        rows = specs.records_by_spec(found, spark.createDataFrame(list(rules), specs.SPEC)).collect()
        got = defaultdict(list)
        for r in sorted(rows, key=lambda r: (r.pos, r.row)):
            got[r.doc_id, r.group_name].append(r.rec)
        return dict(got)

    tables = (None, 5, "table", None, "table", "none", "all", None)
    got = out(tables, (1, 9, None, None, "table", "first", "own", None), (2, 1, "table", "T", "table", "auto", "two", [("first", "^Name$")]))
    assert got[1, "own"] == [{"name": "b", "xY": "c"}, {"name": "d", "xY": "e"}] and (1, "all") not in got
    assert got[None, "all"][0] == {"col1": "Name", "col2": "Name", "col3": "x y"} and len(got[None, "all"]) == 4
    # Of two columns that a field names the last one's value stays; by their look these rows are data, without names.
    assert got[2, "two"][0] == {"col1": "Name", "col2": "Name", "col3": "x y"}
    assert out((2, 1, "table", "T", "table", "first", "two", [("first", "^Name$")])) == {(2, "two"): [{"first": "b"}, {"first": "d"}]}
    assert out((2, 1, "list", None, "list", None, "l", None), (2, 0, "list", None, "list", None, "l", [("c", "^(b)$")])) == {(2, "l"): [{"c": "b"}]}
    assert out((1, 1, "odd", None, "text", None, "x", None), (1, 1, "list", None, "text", None, "x", [("w", "^[ab]$")])) == {(1, "x"): [{"w": "a"}, {"w": "b"}]}
    assert specs.records_by_spec(found, spark.createDataFrame([], specs.SPEC)).count() == 0


def test_documents_of_a_small_file_are_dealt_before_they_are_rendered(spark, sf):
    for made in (queries.pair_records, queries.extractor_sample, queries.spec_records):
        assert "REPARTITION_BY_COL" in made(spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_regions_are_dealt_over_all_cores_before_they_are_parsed(spark, sf):
    docs = queries.customer_documents(spark, sf)
    assert "REPARTITION_BY_COL" in docs._jdf.queryExecution().executedPlan().toString()
    rows = regions.find_regions(docs)
    parts = dealt(rows, "doc_id", "pos")
    assert parts.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism and parts.count() == rows.count()


def test_pages_go_to_python_in_small_batches(spark, sf):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        queries.page_text(spark, sf)
        assert int(spark.conf.get(name)) <= 4 << 20
    finally:
        spark.conf.set(name, before)
