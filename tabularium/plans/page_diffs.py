"""What each page adds to its document, by rule: running lines, repeated text and cut blocks.

Three rules make the plan table that ``streaming.stitch`` applies.

* Running lines: of the first and last lines of each page those that come
  again, but for numbers, on enough pages of the document are its headers and
  footers. They are counted by an aggregate over lines at page edges, which are
  few beside the pages, and go from the pages where they stand at the edge.
* Overlap: what a page repeats of the end of the text before it is left out.
* Cut blocks: a table that goes on with the same columns, a paragraph that goes
  on in lower case and a word cut by a hyphen are put together; then the plan
  replaces the tail of the document.

The last two look at the end of what has been stitched so far, so a document's
pages are read in order, as for stitching itself; a task holds the tail of one
document and a batch of pages.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabularium.functions.text import SPACE, tidy
from tabularium.session import bound_batches
from tabularium.streaming.stitch import TAIL, Stitched

#: Lines at either end of a page that may be running lines, and on how many pages of a document one must stand.
EDGE, LEAST_PAGES, LEAST_SHARE = 2, 2, 0.5
#: Characters that two pages must share to count as an overlap.
LEAST_OVERLAP = 20
#: Ends of HTML blocks, which end a line.
BLOCK_END = "</(?:p|h[1-6]|div|header|footer|li|tr|table)>"
DIFFS = "page long, append string, tail_replacement string, new_header string, new_footer string"


def lines_of(page: str) -> list[str]:
    """The lines of a page; a block of HTML ends a line as well."""
    return (_LINE_END.sub(r"\1\n", page) if "</" in page else page).split("\n")


def _shown(line: str) -> str:
    """A line without comments and tags, runs of white space as one blank."""
    if "<" in line:
        line = _TAG.sub(" ", _COMMENT.sub("", line))
    return _tidy(line)


def _tidy(line: str) -> str:
    """``functions.text.tidy``; Python's own white space is that of ``SPACE`` but for a few signs."""
    return _BLANKS.sub(" ", line).strip(" ") if _ODD.search(line) else " ".join(line.split())


def _hash(shown: str) -> bytes:
    """128 bits of a line's key: without case and numbers, so that page numbers don't tell running lines apart."""
    return hashlib.blake2b(_DIGITS.sub("#", shown.lower()).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def edges_of(page: str | None, edge: int = EDGE) -> list[tuple[str, int, str, bytes]]:
    """The first (side ``header``) and last (``footer``) lines of a page that aren't blank: ``(side, i, line, hash)``, ``i`` their place among all lines.

    Lines are looked at from either end, as far as it takes; hashes are 128 bits of the key.
    """
    if page is None:
        return []
    lines = lines_of(page)
    ends, hashes = {}, {}
    for side, places in (("header", range(len(lines))), ("footer", range(len(lines) - 1, -1, -1))):
        full = ends[side] = []
        for i in places:
            if len(full) == edge:
                break
            if i in hashes:
                full.append(i)
            elif shown := _shown(lines[i]):
                full.append(i)
                hashes[i] = _hash(shown)
    return [(side, i, lines[i], hashes[i]) for side, i in [*(("header", i) for i in ends["header"]), *(("footer", i) for i in reversed(ends["footer"]))]]


_COMMENT, _TAG, _BLANKS, _DIGITS = re.compile(r"<!--.*?-->", re.DOTALL), re.compile(r"<[^>]*>"), re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", SPACE) + "]+"), re.compile("[0-9]+")
_ODD = re.compile("[\x1c-\x1f\x85\ufeff]")


def edge_lines(pages: DataFrame, edge: int = EDGE, id_col: str = "doc_id", text_col: str = "html", with_line: bool = True) -> DataFrame:
    """``(id_col, page, side, hash, line)``: the lines at the edges of each page, and one row without side for the page itself."""
    schema = T.StructType([pages.schema[id_col], pages.schema["page"], *T.StructType.fromDDL("side string, hash binary, line string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            at, sides, hashes, lines = [], [], [], []
            for k, page in enumerate(batch.column(2).to_pylist()):
                for side, _, line, digest in [(None, 0, None, None), *edges_of(page, edge)]:
                    at.append(k)
                    sides.append(side)
                    hashes.append(digest)
                    lines.append(line if with_line else None)
            rows = batch.select([0, 1]).take(pa.array(at, pa.int32()))
            columns = [*(rows.column(k).cast(arrow.field(k).type) for k in range(2)), pa.array(sides, pa.string()), pa.array(hashes, pa.binary()), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    bound_batches(pages.sparkSession)
    return pages.select(id_col, "page", text_col).mapInArrow(run, schema)


def _running(pages: DataFrame, edge: int, least_pages: int, least_share: float, id_col: str, text_col: str, with_line: bool = False) -> DataFrame:
    """``(id_col, side, hash, pages, first)``: running lines by hashes of their keys; ``first`` holds the first line met if ``with_line``, else no text is shuffled to count them.

    Lines are dealt by document once, which serves the counts and the number of pages beside them.
    """
    rows = edge_lines(pages, edge, id_col, text_col, with_line).repartition(id_col)
    first = F.min(F.struct("page", "line"))["line"] if with_line else F.lit(None).cast("string")
    found = rows.groupBy(id_col, "side", "hash").agg(F.count_distinct("page").alias("pages"), first.alias("first")).where(F.col("side").isNull() | (F.col("pages") >= least_pages))
    every = F.max(F.when(F.col("side").isNull(), F.col("pages"))).over(Window.partitionBy(id_col))
    return found.withColumn("__pages", every).where(F.col("side").isNotNull() & (F.col("pages") >= F.col("__pages") * least_share)).drop("__pages")


def running_lines(
    pages: DataFrame, edge: int = EDGE, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, id_col: str = "doc_id", text_col: str = "html"
) -> DataFrame:
    """``(id_col, side, key, pages, line)``: lines that stand at that edge of ``least_pages`` pages and of that share of a document's; ``line`` is the first one met."""
    found = _running(pages, edge, least_pages, least_share, id_col, text_col, with_line=True)
    shown = tidy(F.regexp_replace(F.regexp_replace("first", r"(?s)<!--.*?-->", ""), r"<[^>]*>", " "))
    return found.select(id_col, "side", F.regexp_replace(F.lower(shown), r"\d+", "#").alias("key"), "pages", F.col("first").alias("line"))


def overlap(tail: str, page: str, least: int = LEAST_OVERLAP) -> int:
    """How many characters ``page`` begins with that ``tail`` ends with, at most; 0 below ``least``.

    The first place of the tail from where all of it is the beginning of the
    page is the longest overlap; places are found by the page's first characters.
    """
    if len(page) < least:
        return 0
    begin, at = page[:least], tail.find(page[:least], max(0, len(tail) - len(page)))
    while at >= 0:
        if page.startswith(tail[at:]):
            return len(tail) - at
        at = tail.find(begin, at + 1)
    return 0


class Diff(NamedTuple):
    append: str
    tail_replacement: str | None


def without_lines(page: str, gone: set[int]) -> str:
    """A page without the lines at these places."""
    if not gone:
        return page
    return "\n".join(x for i, x in enumerate(lines_of(page)) if i not in gone)


_LINE_END = re.compile(rf"({BLOCK_END})\n?", re.IGNORECASE | re.ASCII)
_TABLE_END = re.compile(r"</table>\s*(<!--\s*structured-end:[^>]*-->)?\s*$", re.IGNORECASE)
_TABLE_START = re.compile(r"^\s*(<!--\s*structured-start:[^>]*-->)?\s*<table[^>]*>", re.IGNORECASE)
_ROW = re.compile(r"<tr[^>]*>.*?</tr>", re.IGNORECASE | re.DOTALL)
_CELL = re.compile(r"<t([hd])[^>]*>(.*?)</t[hd]>", re.IGNORECASE | re.DOTALL)
_PARAGRAPH_END = re.compile(r"\s*</p>\s*$", re.IGNORECASE)
_PARAGRAPH_START = re.compile(r"^\s*<p[^>]*>\s*", re.IGNORECASE)
#: What a finished sentence ends with.
_STOPS = tuple(".!?:;\"'”’)]}>|")


def _cells(row: str) -> list[tuple[str, str]]:
    return [(kind.lower(), re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", text)).strip().lower()) for kind, text in _CELL.findall(row)]


def _joined_table(tail: str, page: str) -> Diff | None:
    """A table at the end of the tail that goes on at the top of the page: rows under it, a repeated header left out."""
    end, start = _TABLE_END.search(tail), _TABLE_START.search(page)
    if not end or not start:
        return None
    opened = tail.lower().rfind("<table", 0, end.start())
    closed = page.lower().find("</table>", start.end())
    if opened < 0 or closed < 0:
        return None
    before, rows = _ROW.findall(tail[opened : end.start()]), _ROW.findall(page[start.end() : closed])
    if not before or not rows:
        return None
    head, first = _cells(before[0]), _cells(rows[0])
    labelled = any(kind == "h" for kind, _ in first)
    if len(head) != len(first) or (labelled and [t for _, t in head] != [t for _, t in first]):
        return None
    kept = page[start.end() : closed]
    if labelled:
        at = kept.find(rows[0])
        kept = re.sub(r"^\s*<thead[^>]*>", "", kept[:at], flags=re.IGNORECASE) + re.sub(r"^\s*</thead>", "", kept[at + len(rows[0]) :], flags=re.IGNORECASE)
    # The start comment of the earlier page and the end comment of the later one stay.
    return Diff(kept + page[closed:], tail[: end.start()])


def _joined_text(tail: str, page: str) -> Diff | None:
    """A sentence at the end of the tail that goes on in lower case; a hyphen at the end goes, as it has cut a word."""
    end, start = _PARAGRAPH_END.search(tail), _PARAGRAPH_START.search(page)
    if bool(end) != bool(start):
        return None
    before = tail[: end.start()] if end else tail.rstrip()
    after = page[start.end() :] if start else page.lstrip()
    if not before or before.endswith(_STOPS) or not after[:1].islower():
        return None
    if before.endswith("-") and before[-2:-1].isalpha():
        return Diff(after, before[:-1])
    return Diff(after, before + " ")


def diff_of(tail: str, page: str, least: int = LEAST_OVERLAP) -> Diff:
    """What ``page`` adds to a document that ends with ``tail``: text to append, and the tail anew where it has to change."""
    if not tail or not page:
        return Diff(page, None)
    shared = overlap(tail, page, least)
    if shared:
        return Diff(page[shared:], None)
    joined = _joined_table(tail, page) or _joined_text(tail, page)
    if joined:
        return joined
    return Diff(page if tail.endswith("\n") or page.startswith("\n") else "\n" + page, None)


def propose_diffs(
    pages: DataFrame, tail: int = TAIL, least_overlap: int = LEAST_OVERLAP, edge: int = EDGE, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE,
    id_col: str = "doc_id", text_col: str = "html",
) -> DataFrame:
    """``(id_col, page, append, tail_replacement, new_header, new_footer)`` from ``(id_col, page, text_col)``: the plan that ``stitch`` applies.

    A null page adds nothing; of pages with one number the first by text counts.
    Pages with a null document id are one document.
    """
    running = _running(pages, edge, least_pages, least_share, id_col, text_col)
    # A document's running lines go with its pages to their task, before the first page. They are few, as each stands on a good share of the pages.
    known = running.groupBy(id_col).agg(F.collect_set(F.struct("side", "hash")).alias("known"))
    rows = pages.select(id_col, F.lit(1).alias("place"), "page", F.col(text_col).alias("body"))
    rows = rows.unionByName(known.withColumn("place", F.lit(0)), allowMissingColumns=True).select(id_col, "place", "page", "body", "known")
    schema = T.StructType([pages.schema[id_col], *T.StructType.fromDDL(DIFFS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, key, last, now, lines = to_arrow_schema(schema), None, None, None, set()
        for batch in batches:
            out = []
            for ident, place, page, body, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or ident != key:
                    key, last, now, lines = ident, None, Stitched(tail), set()
                if place == 0:
                    lines = {(x["side"], x["hash"]) for x in found}
                    continue
                if page == last and last is not None:
                    continue
                gone = [e for e in edges_of(body, edge) if (e[0], e[3]) in lines] if lines else []
                header = next((line for side, _, line, _ in gone if side == "header"), None)
                footer = next((line for side, _, line, _ in reversed(gone) if side == "footer"), None)
                header, footer = (x and _tidy(_TAG.sub(" ", x)) for x in (header, footer))
                diff = diff_of(now.end(), without_lines(body or "", {i for _, i, _, _ in gone}), least_overlap)
                now.add(*diff, None, None)
                now.done.clear()  # only the end of what is stitched is looked at
                last = page
                out.append((ident, page, *diff, header, footer))
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], schema=arrow)

    bound_batches(pages.sparkSession)
    return rows.repartition(id_col).sortWithinPartitions(id_col, "place", "page", "body").mapInArrow(run, schema)
