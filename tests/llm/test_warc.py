"""Archives: round trip, revisits, validation."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import zstandard

from tabularium.llm import warc

PAGE = "<p>" + "a long enough page " * 80
ROWS = [
    (1, "http://a/1", PAGE), (2, "http://a/2 \r\nx", PAGE), (3, None, PAGE), (3, None, PAGE), (None, "http://a/n", PAGE), (4, "u", None), (5, "u", ""), (6, "u", "short"),
    (7, "u", "short"), (None, "u", "only nulls " * 200), (None, "u", "only nulls " * 200), (8, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "e" * 999), (11, "u", "e" * 999),
    (12, "u", "x" * 3_000_000), (13, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    return rows.selectExpr("*", "'clash' AS id", "'clash' AS payload", "'clash' AS digest", "'clash' AS n")


def test_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archives"
    planned = warc.plan_records(pages, "page_id", "url", "html", 1000)
    manifest = warc.write_archives(spark, planned, folder, archive_bytes=2000).collect()
    got = warc.read_archives(spark, folder).collect()
    assert sum(r.records for r in manifest) == len(ROWS) == len(got)
    assert not [r for r in got if r.error]
    groups: dict = {}
    for i, _, html in ROWS:
        if len((html or "").encode()) >= 1000 and i is not None:
            groups[html] = max(groups.get(html, i), i)
    want = Counter()
    for i, _, html in ROWS:
        raw = (html or "").encode()
        main = groups.get(html)
        again = main is not None and main != i
        want[f"<urn:page:{i}>", len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", f"<urn:page:{main}>" if again else None, None if again else raw] += 1
    assert Counter((r.record_id, r.payload_bytes, r.payload_digest, r.warc_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want


def test_query_columns_and_empty_tables(spark, pages):
    out = warc.archive_pages(spark, pages)
    assert out.count() == len(ROWS)
    empty = warc.archive_pages(spark, pages.limit(0))
    assert empty.count() == 0 and empty.columns == out.columns


def test_dictionary_frame_is_used(tmp_path):
    out = warc._Archives(f"file://{tmp_path}", 1 << 20)
    payloads = [f"<html>page number {k} of a site with a common frame {'body ' * (k % 7)}</html>".encode() * 20 for k in range(600)]
    for k, p in enumerate(payloads):
        out.add(warc.record("response", f"<urn:page:{k}>", "u", p, len(p), hashlib.sha1(p).hexdigest(), None))
    out.close()
    data = b"".join((tmp_path / name).read_bytes() for name, _, _ in out.done)
    assert len(out.done) == 1 and data[:4] == warc.DICTIONARY_MAGIC
    assert warc.leading_dictionary(data)[0] is not None
    assert [r["payload"] for r in warc.read_records(data)] == payloads
    # One frame per record: a record can be read by its offset alone.
    rows = list(warc.read_records(data))
    codec = zstandard.ZstdDecompressor(dict_data=warc.leading_dictionary(data)[0])
    one = rows[100]
    assert warc.parse_record(codec.decompress(data[one["offset"] : one["offset"] + one["frame_bytes"]]))["payload"] == payloads[100]


def whole(change=lambda raw: raw) -> bytes:
    p = b"payload"
    raw = warc.record("response", "<urn:page:1>", "u", p, len(p), hashlib.sha1(p).hexdigest(), None)
    return zstandard.ZstdCompressor(write_checksum=True).compress(change(raw))


@pytest.mark.parametrize(
    ("change", "error"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARK/1.1"), "version"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Dat"), "mandatory"),
        (lambda r: r[:-1], "Content-Length differs"),
        (lambda r: r[:-4] + b"\n\n\n\n", "two line breaks"),
        (lambda r: r.replace(b"payload\r\n", b"payl0ad\r\n"), "differs from its digest"),
        (lambda r: r.replace(b"sha1:", b"md55:"), "no SHA-1"),
        (lambda r: r.replace(b"Content-Length: 7", b"Content-Length: 8"), "HTTP length"),
        (lambda r: r.replace(b"HTTP/1.1 200", b"SMTP/1.1 200"), "no HTTP header"),
        (lambda r: b"nothing", "no end"),
    ],
)
def test_a_damaged_record_is_reported_and_reading_goes_on(change, error):
    rows = list(warc.read_records(whole(change) + whole()))
    assert error in rows[0]["error"] and rows[1].get("error") is None and rows[1]["payload"] == b"payload"


def test_a_frame_that_states_a_huge_size_is_an_error_row():
    good = whole()
    raw = zstandard.ZstdDecompressor().decompress(good)
    # A frame header with eight bytes of size, which say 2**50, and one raw block.
    huge = b"\x28\xb5\x2f\xfd\xc0\x58" + (1 << 50).to_bytes(8, "little") + (len(raw) << 3 | 1).to_bytes(3, "little") + raw
    rows = list(warc.read_records(huge + good))
    assert "size" in rows[0]["error"] and rows[1].get("error") is None


def test_a_very_long_record_is_read_whole():
    p = b"0" * 40_000_000
    raw = warc.record("response", "<urn:page:1>", "u", p, len(p), hashlib.sha1(p).hexdigest(), None)
    rows = list(warc.read_records(zstandard.ZstdCompressor(write_checksum=True).compress(raw)))
    assert rows[0].get("error") is None and rows[0]["payload"] == p


def test_damaged_frames():
    good = whole()
    flipped = bytearray(good)
    flipped[-1] ^= 1
    assert [bool(r.get("error")) for r in warc.read_records(bytes(flipped) + good)] == [True, False]
    assert [bool(r.get("error")) for r in warc.read_records(good + good[:-6])] == [False, True]
    assert [bool(r.get("error")) for r in warc.read_records(good + b"junk" + good)] == [False, True]
    assert list(warc.read_records(warc.DICTIONARY_MAGIC + (99).to_bytes(4, "little")))[0]["error"]
    assert list(warc.read_records(b"")) == []
