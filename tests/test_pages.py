"""Page diffs by rule, and stitching as a stream."""

from __future__ import annotations

import random
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from tabularium.plans import page_diffs
from tabularium.streaming import stitch

DIFFS = "doc_id long, page long, append string, tail_replacement string, new_header string, new_footer string"


@settings(max_examples=300, deadline=None)
@given(st.text("ab ", max_size=40), st.text("ab ", max_size=40), st.integers(1, 6))
def test_overlaps_equal_all_lengths(tail, page, least):
    want = max((k for k in range(least, min(len(tail), len(page)) + 1) if tail.endswith(page[:k])), default=0)
    assert page_diffs.overlap(tail, page, least) == want


def test_tables_and_sentences_go_on():
    end, start = '<!-- structured-end:id="a" -->', '<!-- structured-start:id="b" kind="table" title="T" -->'
    head = "<thead><tr><th>A</th><th> B</th></tr></thead>"
    one = f"<p>x.</p><table>{head}<tr><td>1</td><td>2</td></tr></table>"
    two = f"<table>{head}<tr><td>3</td><td>4</td></tr></table><p>After.</p>"
    diff = page_diffs.diff_of(one + end, start + two)
    assert (diff.tail_replacement or "") + diff.append == f"<p>x.</p><table>{head}<tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table><p>After.</p>"
    bare = page_diffs.diff_of(one, "<table><tr><td>3</td><td>4</td></tr></table>")
    assert bare.append == "<tr><td>3</td><td>4</td></tr></table>" and bare.tail_replacement == one.removesuffix("</table>")
    # Other columns, other labels, text between: nothing is joined.
    for other in ("<table><tr><td>3</td></tr></table>", two.replace("A", "C"), "<p>Text.</p>" + two, "<table></table>", "<table>"):
        assert page_diffs.diff_of(one, other) == ("\n" + other, None)
    assert page_diffs.diff_of("<p>A sentence that</p>\n", "<p>goes on.</p>") == ("goes on.</p>", "<p>A sentence that ")
    assert page_diffs.diff_of("a word cut by a hy-", "phen is whole.") == ("phen is whole.", "a word cut by a hy")
    assert page_diffs.diff_of("A sentence.", "another") == ("\nanother", None) and page_diffs.diff_of("A title", "Another") == ("\nAnother", None)
    assert page_diffs.diff_of("in a paragraph</p>", "no paragraph") == ("\nno paragraph", None)
    assert page_diffs.diff_of("", "first") == ("first", None) and page_diffs.diff_of("text", "") == ("", None)


def test_running_lines_go_and_anchors_stay(spark):
    anchor = '<!-- structured-start:id="p1" kind="table" title="T" -->'
    pages = [(1, k, f"{anchor}\n<header>Annual Report {2000 + k}</header>\nBody {'abcdefgh'[k]} of its own.\n<p>Page {k} of 6</p>" if k != 3 else "Another page.") for k in range(6)]
    pages += [(2, 1, "Only page\nPage 1"), (None, 1, "Same\nx one."), (None, 2, "Same\ny two."), (3, 1, None), (3, 2, "")]
    frame = spark.createDataFrame(pages, "doc_id long, page long, html string")
    lines = {(r.doc_id, r.side, r.key): r.pages for r in page_diffs.running_lines(frame).collect()}
    assert lines == {(1, "header", "annual report #"): 5, (1, "footer", "page # of #"): 5, (None, "header", "same"): 2, (None, "footer", "same"): 2}
    out = {(r.doc_id, r.page): r for r in page_diffs.propose_diffs(frame).collect()}
    first = out[1, 0]
    assert (first.append, first.tail_replacement, first.new_header, first.new_footer) == (f"{anchor}\nBody a of its own.\n", None, "Annual Report 2000", "Page 0 of 6")
    assert out[2, 1].append == "Only page\nPage 1" and out[3, 1].append == "" and out[None, 2].append == "\ny two." and len(out) == len(pages)
    whole = stitch.stitch(page_diffs.propose_diffs(frame.where("doc_id = 1"))).first()
    assert whole.headers[-1] == "Annual Report 2005" and "Annual" not in whole.stitched and whole.stitched.count(anchor) == 5


def run_stream(spark, folder, triggers, **options):
    """Parts of all documents after each list of rows has come with a trigger of its own run."""
    schema = DIFFS + ", ends boolean"
    for rows in triggers:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        told = stitch.stitch_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), **options)
        told.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return sorted(spark.read.parquet(f"{folder}/out").collect(), key=lambda r: (r.doc_id, r.part))


def test_late_and_repeated_pages_give_the_batch_result(spark, tmp_path):
    rng = random.Random(3)
    rows = [(d, k, f"{d}.{k};" * rng.randint(1, 9), "R" if k % 4 == 2 else None, f"h{k % 5}", f"f{k}" if k % 2 else None) for d in (1, 2, 3) for k in range(1, 16)]
    sent = [(*r, r[1] == 15) for r in rows]
    rng.shuffle(sent)
    parts = run_stream(spark, tmp_path, [sent[:20], sent[10:30], sent[25:], sent[:5]], tail=12)
    want = {r.doc_id: r for r in stitch.stitch(spark.createDataFrame(rows + rows[:7], DIFFS), tail=12).collect()}
    for d, one in want.items():
        own = [p for p in parts if p.doc_id == d]
        assert "".join(p.text for p in own) == one.stitched and [p.part for p in own] == list(range(len(own)))
        last = own[-1]
        assert (last.pages, last.headers, last.footers) == (one.pages, one.headers, one.footers) == (15, one.headers, one.footers)
        assert [p.complete for p in own] == [False] * (len(own) - 1) + [True]


def test_state_does_not_grow_with_the_document(spark, tmp_path):
    rows = [(1, k, "x" * 400, None, f"h{k}", None, False) for k in range(1, 41)]
    parts = run_stream(spark, tmp_path, [rows[:20], rows[20:]], tail=50)
    assert sum(len(p.text) for p in parts) == 40 * 400 - 50 and not any(p.complete for p in parts)
    state = spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/state").select("value.*").first()
    assert (state.next, state.pages, len(state.last), len(state.headers)) == (41, 40, 50, stitch.MEMORY)


def test_what_waits_is_stitched_when_no_page_comes(spark, tmp_path):
    schema = DIFFS + ", ends boolean"
    first = [(1, 1, "a", None, None, None, False), (1, 3, "c", None, None, None, False), (1, 5, "e", None, None, None, False)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    told = stitch.stitch_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), patience_ms=500)
    run = told.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="1 second").start()
    parts, until = [], time.monotonic() + 60
    while not parts and time.monotonic() < until:
        time.sleep(1)
        if (tmp_path / "out" / "_spark_metadata").exists():
            parts = spark.read.schema(told.schema).parquet(f"{tmp_path}/out").collect()
    run.stop()
    assert [(p.doc_id, p.text, p.pages, p.complete) for p in parts] == [(1, "ace", 3, True)]


class Kept:
    """A handle and its states of one document, with calls counted."""

    def __init__(self):
        self.value, self.map, self.calls = None, {}, Counter()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    getMapState = lambda self, name, key, value: self  # noqa: E731, N815

    def get(self):
        self.calls["get"] += 1
        return self.value

    def update(self, value):
        self.calls["update"] += 1
        self.value = value

    def getValue(self, key):  # noqa: N802
        self.calls["getValue"] += 1
        return self.map.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.calls["updateValue"] += 1
        self.map[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls["removeKey"] += 1
        del self.map[key]

    def keys(self):
        return iter(self.map)

    def clear(self):
        self.map.clear()


def sent_to(kept, rows, tail=12):
    processor = stitch.StitchProcessor("doc_id", tail, 1, None)
    processor.init(kept)
    return list(processor.handleInputRows((1,), iter([Row(doc_id=1, page=k, append=a, tail_replacement=r, new_header=h, new_footer=None, ends=e) for k, a, r, h, e in rows]), None))


def test_calls_to_the_state_grow_with_runs_of_pages():
    pages = [(k, f"{k};", None, None, k == 160) for k in range(1, 161)]
    kept = Kept()
    sent_to(kept, pages[::2])
    runs = 160 // stitch.RUN + 1
    assert sum(kept.calls.values()) <= runs + 2
    parts = sent_to(kept, pages[1::2])
    assert sum(kept.calls.values()) <= 3 * runs + 4 and not kept.map
    assert parts[-1].complete and parts[-1].pages == 160 and "".join(p.text for p in parts) == "".join(f"{k};" for k in range(1, 161))
    before = sum(kept.calls.values())
    assert sent_to(kept, pages[:5]) == [] and sum(kept.calls.values()) == before + 1
    # What comes with its turn needn't wait: the document is read and written once.
    short = Kept()
    sent_to(short, pages[:9])
    assert short.calls == {"get": 1, "update": 1}


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70), st.integers(1, 8), st.integers(0, 9), st.booleans(), st.randoms(use_true_random=False))
def test_any_order_gives_the_plain_fold(n, triggers, beyond, timer, rng):
    pages = [(k, f"{k}," * rng.randint(1, 4), f"R{k}" if rng.random() < 0.3 else None, f"h{k % 7}", k == n and not timer) for k in range(1, n + 1)]
    if timer:  # gaps, and no last page: a timer ends the document
        pages = rng.sample(pages, rng.randint(1, n))
    after = [(n + 5 * k, "no", None, None, False) for k in range(1, beyond + 1)] if not timer else []
    sent = pages + after + rng.sample(pages, min(len(pages), 5))
    rng.shuffle(sent)
    kept, parts = Kept(), []
    for k in range(triggers):
        parts += sent_to(kept, sent[k::triggers])
    if timer:
        processor = stitch.StitchProcessor("doc_id", 12, 1, None)
        processor.init(kept)
        parts += processor.handleExpiredTimer((1,), None, None)
    want = stitch.Stitched(12)
    for _, append, replacement, header, _ in sorted(pages):
        want.add(append, replacement, header, None)
    assert "".join(p.text for p in parts) == "".join([*want.done, want.last]) and not kept.map
    assert [p.part for p in parts] == list(range(len(parts))) and [p.complete for p in parts] == [False] * (len(parts) - 1) + [True]
    assert (parts[-1].pages, parts[-1].headers) == (want.pages, want.headers)


def test_long_documents_and_ids_that_are_null_or_large(spark, tmp_path):
    ids = (None, 2**53, 2**53 + 1)
    rows = [(d, k, f"{d}.{k};", "R" if k % 4 == 2 else None, f"h{k % 5}", None, k == 50) for d in ids for k in range(1, 51)]
    schema = DIFFS + ", ends boolean"
    # Even pages wait for odd ones, in runs; some lie beyond the last page.
    waiting = []
    for sent in (rows[1::2] + [(d, 90, "no", None, None, None, False) for d in ids], rows[::2] + rows[:9]):
        spark.createDataFrame(sent, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        told = stitch.stitch_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), tail=12)
        told.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        waiting.append(spark.read.format("statestore").option("stateVarName", "waiting").load(f"{tmp_path}/state").count())
    assert waiting == [12, 0]
    parts = spark.read.parquet(f"{tmp_path}/out").collect()
    for one in stitch.stitch(spark.createDataFrame([r[:6] for r in rows], DIFFS), tail=12).collect():
        own = sorted((p for p in parts if p.doc_id == one.doc_id), key=lambda p: p.part)
        assert "".join(p.text for p in own) == one.stitched and own[-1].complete and (own[-1].pages, own[-1].headers) == (50, one.headers)


@pytest.mark.parametrize("rows", [[], [(1, 1, None)]])
def test_no_pages(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, page long, html string")
    assert [r.append for r in page_diffs.propose_diffs(frame).collect()] == [""] * len(rows)


def test_edges_are_found_from_either_end_without_lambdas(spark):
    page = "Report 1\n\n<!-- a --><b> </b>\nx</lı>y</p>z\n﻿\n \x1c \nPage  2"
    assert [(side, i, line) for side, i, line, _ in page_diffs.edges_of(page)] == [("header", 0, "Report 1"), ("header", 3, "x</lı>y</p>"), ("footer", 6, " \x1c "), ("footer", 7, "Page  2")]
    assert page_diffs.edges_of(None) == [] == page_diffs.edges_of(" \n<p>")
    one = page_diffs.edges_of("only 7")
    assert [(side, i) for side, i, _, _ in one] == [("header", 0), ("footer", 0)] and one[0][3] == page_diffs.edges_of("ONLY 8")[0][3]
    # A dotless i ends no list item: the running lines go, no other.
    pages = spark.createDataFrame([(1, k, f"Report {k}\nA{k}</lı>b{k}\nc{k}.\nd{k}.\nPage {k}") for k in (1, 2)], "doc_id long, page int, html string")
    diffs = page_diffs.propose_diffs(pages, edge=1)
    assert "lambda" not in str(diffs._jdf.queryExecution().optimizedPlan())
    assert [(r.append, r.new_header, r.new_footer) for r in diffs.orderBy("page").collect()] == [("A1</lı>b1\nc1.\nd1.", "Report 1", "Page 1"), ("\nA2</lı>b2\nc2.\nd2.", "Report 2", "Page 2")]
