"""Text rules as column expressions, evaluated in the JVM.

White space is the set that web scripts use (with no-break spaces and the byte
order mark), which neither ``\\s`` nor ``trim`` of SQL covers. A null input
gives null unless a docstring says otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of web scripts, as a character class without brackets.
SPACE = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def strip(s: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(s, f"^[{SPACE}]+|[{SPACE}]+$", "")


def tidy(s: Column) -> Column:
    """Stripped, and runs of white space as one blank."""
    return F.regexp_replace(strip(s), f"[{SPACE}]+", " ")


def not_blank(s: Column) -> Column:
    """The stripped text, null if nothing is left."""
    return F.nullif(strip(s), F.lit(""))


def normalise_title(s: Column) -> Column:
    """A title's key: lower case, letters and digits only, single blanks."""
    return tidy(F.regexp_replace(F.lower(s), rf"[^\p{{L}}\p{{N}}{SPACE}]+", " "))


def camel_case(label: Column, smart: bool = False) -> Column:
    """A label in camel case.

    What follows ``_``, ``-`` or white space becomes upper case, the very first
    letter lower case, and everything but a-z, A-Z and 0-9 goes; capitals inside
    stay (``FULL_NAME`` is ``fULLNAME``). ``smart`` lowers words in capitals first.
    """
    parts = F.split(label, rf"[_\-{SPACE}]+")
    if smart:
        parts = F.transform(parts, lambda p: F.when(F.rlike(p, F.lit("^[^a-z]*$")), F.lower(p)).otherwise(p))
    raised = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, 2, 1 << 30))))
    joined = F.array_join(raised, "")
    lowered = F.when(F.rlike(joined, F.lit("^[A-Z]")), F.concat(F.lower(F.left(joined, F.lit(1))), F.substring(joined, 2, 1 << 30))).otherwise(joined)
    return F.regexp_replace(lowered, "[^a-zA-Z0-9]", "")


def field_name(label: Column) -> Column:
    """Camel case, or the label itself where nothing is left of it."""
    return F.coalesce(F.nullif(camel_case(label), F.lit("")), label)


def schema_key(schema: Column) -> Column:
    """``name:type`` of a map's entries by name, joined by ``|``; empty for null."""
    entries = F.array_sort(F.map_entries(F.coalesce(schema, F.create_map().cast("map<string,string>"))))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(e["value"], F.lit("")))), "|")


def one_of(s: Column, allowed: tuple[str, ...], default: str) -> Column:
    """The lower-cased value if it is allowed, else the default, for null too."""
    return F.when(F.lower(s).isin(*allowed), F.lower(s)).otherwise(F.lit(default))


def confidence(s: Column, default: str = "none") -> Column:
    return one_of(s, ("high", "medium", "low", default), default)


def url_component(s: Column) -> Column:
    """Percent-encoded, with ``%20`` for a blank and ``!'()*`` as they are."""
    out = F.replace(F.url_encode(s), F.lit("+"), F.lit("%20"))
    for code, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def fill_template(record: Column, template: str) -> Column:
    """``{column}`` parts of a template filled from a map of texts, with left-over commas cleaned up.

    The template is compiled once, so the rows see one concatenation. Null and
    missing values are empty; two empty parts in a row leave ``, ,``.
    """
    pieces = re.split(r"\{([^}]+)\}", template)
    parts = [F.coalesce(strip(record[p]), F.lit("")) if k % 2 else F.lit(p) for k, p in enumerate(pieces)]
    return clean_commas(F.concat(*parts))


def clean_commas(s: Column) -> Column:
    """Tidied, without commas at either end, and neighbouring commas as one comma and a blank."""
    single = F.regexp_replace(tidy(s), " ?, ?,+ ?", ", ")
    return F.regexp_replace(single, "^[ ,]+|[ ,]+$", "")


def fill_templates(record: Column, template: Column) -> Column:
    """``fill_template`` for templates in a column: one for each row."""
    names = F.regexp_extract_all(template, F.lit(r"\{([^}]+)\}"), F.lit(1))
    fixed = F.split(template, r"\{[^}]+\}")
    filled = F.transform(fixed, lambda text, i: F.concat(text, F.coalesce(strip(F.get(F.transform(names, lambda n: record[n]), i)), F.lit(""))))
    return clean_commas(F.array_join(filled, ""))


#: Languages that a fence may name.
FENCE_LANGUAGES = ("html", "json", "javascript", "js", "typescript", "ts", "jsx", "tsx")
FENCE = "```"


def strip_fences(s: Column) -> Column:
    """The inside of a text that is one fenced block as a whole, else the text; stripped in both cases.

    A language after the opening fence goes too, in any case of letters and
    whether or not a line ends there; another word is part of the content.
    """
    whole = strip(s)
    inside = F.substring(whole, F.lit(len(FENCE) + 1), F.length(whole) - 2 * len(FENCE))
    word = F.regexp_extract(inside, "^[A-Za-z]*", 0)
    content = F.when(F.lower(word).isin(*FENCE_LANGUAGES), F.substring(inside, F.length(word) + 1, F.length(inside))).otherwise(inside)
    fenced = F.startswith(whole, F.lit(FENCE)) & F.endswith(whole, F.lit(FENCE)) & (F.length(whole) >= 2 * len(FENCE))
    return F.when(fenced, strip(content)).otherwise(whole)


def defines_extract(code: Column) -> Column:
    """Whether a program declares ``extract``: as a function, or as a variable that gets a value at once.

    The program is taken as a row of words and signs, in which three neighbours tell it.
    """
    row = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(code, F.lit(r"[\w$]+|[^\w$\s]"), F.lit(0)), " "), F.lit(" "))
    declared = [F.contains(row, F.lit(f" {word} extract {sign} ")) for word, sign in (("function", "("), ("const", "="), ("let", "="), ("var", "="))]
    return declared[0] | declared[1] | declared[2] | declared[3]


#: What a program may not contain, as a pattern and the name that is reported, in the order of the search.
FORBIDDEN = [
    (r"\beval\s*\(", "eval()"),
    (r"\bnew\s+Function\b", "new Function"),
    (r"\bFunction\s*\(", "Function()"),
    (r"\bimport\s*\(", "dynamic import()"),
    (r"\brequire\s*\(", "require()"),
    (r"\bprocess\b", "process"),
    (r"\bglobalThis\b", "globalThis"),
    (r"\bfetch\s*\(", "fetch()"),
    (r"\bXMLHttpRequest\b", "XMLHttpRequest"),
    (r"\bchild_process\b", "child_process"),
    (r"\b__proto__\b", "__proto__"),
    (r"\.constructor\b", ".constructor"),
]


def forbidden_reason(code: Column) -> Column:
    """Why a program is refused: the first of ``FORBIDDEN`` that it contains, where, and 20 characters around it; null where there is none."""

    def told(pattern: str, name: str) -> Column:
        at = F.regexp_instr(code, F.lit(pattern)) - 1
        begin = F.greatest(at - 20, F.lit(0))
        around = F.substring(code, begin + 1, at - begin + F.length(F.regexp_extract(code, pattern, 0)) + 20)
        around = F.regexp_replace(around, f"[{SPACE}]+", " ")
        return F.when(at >= 0, F.concat(F.lit(f"forbidden token {name} at offset "), at.cast("string"), F.lit(": ..."), around, F.lit("...")))

    return F.coalesce(*(told(pattern, name) for pattern, name in FORBIDDEN))
