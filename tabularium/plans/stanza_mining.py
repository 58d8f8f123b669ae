"""Repeated layouts of plain text, found by rule: runs of lines that look alike again and again.

A line's *shape* is what is left when words, numbers and their repetitions
become one sign each: ``12 High Street`` is ``0 a``, ``London, UK`` is ``a, a``. A
run of shapes that comes back often enough in a document is a candidate; where
candidates overlap, the one that accounts for most lines stays. Each shape gives
a regular expression back, so a pattern is a rule of ``operators.specs``.

Lines that end a sentence are left out first, which leaves little of most texts.
Runs are counted as rows by windows, and nothing holds more than one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.text import SPACE, tidy
from tabularium.operators.specs import stanza_rows

#: Lines of a stanza at most, and how often it must occur. A line of a longer shape is prose.
MOST_LINES, LEAST_COUNT, MOST_SIGNS = 5, 3, 40
#: What parts a line's fields, as characters of a class; a word ends at these and at the marks that end a sentence.
PARTS, STOPS = ",:;|/", ".!?"
_NUMBER = rf"[^ {PARTS}]*\d[^ {PARTS}]*"
_WORD_SIGNS = rf"[^ {PARTS}{STOPS}0-9]*"
_WORD = rf"{_WORD_SIGNS}\p{{L}}{_WORD_SIGNS}"
#: A line that ends a sentence, whose shape ends so too: no digit in its last token, which would make that a number.
SENTENCE = rf"(?dm)^(?:.*[{SPACE}{PARTS}&&[^\n]])?[^{SPACE}{PARTS}\d]*[{STOPS}][{SPACE}&&[^\n]]*$"


def shape(line: Column) -> Column:
    """``0`` for numbers, ``a`` for words, other signs as they are; empty for a blank line."""
    marked = F.regexp_replace(F.regexp_replace(tidy(line), _NUMBER, "0"), _WORD, "a")
    return F.regexp_replace(F.regexp_replace(marked, "a( a)+", "a"), "0( 0)+", "0")


def pattern_of(shapes: Column) -> Column:
    """A regular expression for the lines of a shape, with a group for each number and word."""
    group = lambda one: rf"({one}(?: {one})*)"
    sign = lambda c: F.when(c == "a", F.lit(group(_WORD))).when(c == "0", F.lit(group(_NUMBER))).otherwise(F.concat(F.lit("\\Q"), c, F.lit("\\E")))
    return F.concat(F.lit("^"), F.array_join(F.transform(F.filter(F.split(shapes, ""), lambda c: c != ""), sign), ""), F.lit("$"))


def _groups(shapes: Column) -> Column:
    return F.size(F.split(shapes, "[a0]")) - 1


def runs(texts: DataFrame, most_lines: int = MOST_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, size, shapes, pos)``: every run of up to ``most_lines`` lines that could be a stanza.

    Each line has a shape, is no sentence and not too long; some line has a
    number or a part mark (a single line both a mark and two fields); and no run
    begins as it ends, so that occurrences of one run never overlap.
    """
    usable = lambda s: (s != "") & (F.length(s) <= MOST_SIGNS) & ~F.rlike(s, F.lit(f"[{STOPS}]$"))
    # Prose is most of a text: its lines go in one pass, before any shape is made, and leave their places.
    rows = texts.select(id_col, F.regexp_replace(text_col, SENTENCE, "").alias("text"))
    rows = rows.select(id_col, F.transform(F.split("text", "\n"), lambda x: F.when(x != "", shape(x)).otherwise("")).alias("all"))
    rows = rows.select(id_col, F.transform("all", lambda s: F.when(usable(s), s).otherwise("")).alias("all"))
    # A line goes on with the few after it; the document's others are left behind.
    begun = F.transform("all", lambda s, i: F.when(s != "", F.slice("all", i + 1, F.lit(most_lines))))
    starts = rows.select(id_col, F.posexplode(begun).alias("pos", "near")).where("near is not null")
    lines = [F.get("near", F.lit(k)) for k in range(most_lines)]
    told = [F.rlike(line, F.lit(f"[0{PARTS}]")) for line in lines]
    sizes = []
    for size in range(1, most_lines + 1):
        good = F.rlike(lines[0], F.lit(f"[{PARTS}]")) & (_groups(lines[0]) >= 2) if size == 1 else reduce(Column.__or__, told[:size])
        # A run that begins as it ends has a border that doesn't overlap itself, so the short ones are enough.
        for border in range(1, size // 2 + 1):
            good = good & ~reduce(Column.__and__, (lines[k] == lines[size - border + k] for k in range(border)))
        # A null, beyond the last line, or an unusable line leaves no run.
        there = reduce(Column.__and__, (F.coalesce(line != "", F.lit(False)) for line in lines[:size]))
        sizes.append(F.when(there, F.when(good, F.struct(F.lit(size).alias("size"), F.concat_ws("\n", *lines[:size]).alias("shapes")))))
    return starts.select(id_col, "pos", F.explode(F.array(*sizes)).alias("run")).where("run is not null").select(id_col, "run.size", "run.shapes", "pos")


def mine_stanzas(texts: DataFrame, least_count: int = LEAST_COUNT, most_lines: int = MOST_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, name, size, shapes, approx_count, first_line, fields)``: the layouts that each document repeats.

    A candidate is a run that occurs ``least_count`` times; those that cover more
    lines come first, then longer and earlier ones. A line belongs to the first
    candidate that has it, and a candidate counts the occurrences all of whose
    lines it has. ``fields`` are ``(name, pattern)`` of each line, as ``operators.specs`` takes
    them. Rows with one id are one document; null texts have no lines.
    """
    key = [id_col, "size", "shapes"]
    # Texts are read once: windows, not joins, tell runs how often they occur, and each key is shuffled once.
    same = Window.partitionBy(*key)
    found = runs(texts, most_lines, id_col, text_col).select("*", F.count("*").over(same).alias("n"), F.min("pos").over(same).alias("first")).where(F.col("n") >= least_count)
    order = Window.partitionBy(id_col).orderBy((F.col("n") * F.col("size")).desc(), F.col("size").desc(), "first", "shapes")
    known = found.select(*key, "pos", F.dense_rank().over(order).alias("place"))
    # Only lines of candidates go on; each looks for its best one.
    lines = known.select("*", F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("line"))
    owned = lines.withColumn("owner", F.min("place").over(Window.partitionBy(id_col, "line")))
    whole = owned.groupBy(*key, "place", "pos").agg(F.bool_and(F.col("place") == F.col("owner")).alias("whole")).where("whole")
    counted = whole.groupBy(*key, "place").agg(F.count("*").alias("approx_count"), F.min("pos").alias("first_line")).where(F.col("approx_count") >= least_count)
    named = Window.partitionBy(id_col).orderBy("first_line")
    letters = F.array(*(F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz"))

    def names(s: Column, i: Column) -> Column:
        base = F.concat(F.lit("line"), (i + 1).cast("string"))
        return F.when(_groups(s) <= 1, base).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), _groups(s) - 1), lambda g: F.concat(base, F.coalesce(F.get(letters, g), g.cast("string")))), ","))

    fields = F.transform(F.split("shapes", "\n"), lambda s, i: F.struct(names(s, i).alias("name"), pattern_of(s).alias("pattern")))
    name = F.concat(F.lit("stanza-"), F.row_number().over(named).cast("string"))
    return counted.select(id_col, name.alias("name"), "size", "shapes", "approx_count", "first_line", fields.alias("fields"))


def as_specs(patterns: DataFrame) -> DataFrame:
    """Mined patterns as rows of ``specs.SPEC``; a text is a region of kind ``text`` titled by the pattern's name."""
    none = F.lit(None).cast("string")
    return patterns.select("doc_id", F.lit(0).alias("spec_ord"), F.lit("text").alias("kind"), F.col("name").alias("title"), F.lit("text").alias("helper"), none.alias("headers"), F.col("name").alias("group_name"), "fields")


def stanza_records(texts: DataFrame, patterns: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, group_name, ord, rec)``: every occurrence of each document's patterns in its whole text."""
    rows = texts.join(patterns.select(id_col, F.col("name").alias("group_name"), "fields"), id_col)
    rows = rows.select(id_col, "group_name", "fields", F.transform(F.split(text_col, "\n"), lambda x: tidy(x)).alias("lines"))
    listed = F.flatten(F.transform("fields", lambda f: F.split(f["name"], ",")))
    found = rows.select(id_col, "group_name", listed.alias("names"), F.posexplode(stanza_rows("lines", "fields")).alias("ord", "cells"))
    return found.select(id_col, "group_name", F.col("ord").cast("long").alias("ord"), F.map_from_arrays("names", "cells").alias("rec"))
