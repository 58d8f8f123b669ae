"""HTML as column functions.

A text is parsed once per expression, by the standard library's tokenizer and
a small tree builder with the implicit ends that real pages need (``p li tr td
th dt dd`` and table parts). Functions take Arrow batches; null gives null.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.text import strip

#: Elements without content, and elements that stand in lines of their own.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "p div tr li h1 h2 h3 h4 h5 h6 pre blockquote table thead tbody tfoot header footer section article main nav aside address details summary hgroup dt dd "
    "caption figure figcaption form fieldset legend hr".split()
)
#: Elements that end a value after a bold label.
LABEL_ENDS = frozenset("p div br tr li dt dl h1 h2 h3 h4 h5 h6 table ul ol section article header footer".split())
#: For an element, those that its start ends, and those beyond which it looks no further.
_CELL, _LIST = ("td", "th"), ("ul", "ol", "menu")
CLOSES = {
    "li": (("li",), _LIST),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (_CELL, ("tr", "table")),
    "th": (_CELL, ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
#: A paragraph ends where one of these starts.
ENDS_P = frozenset("p div ul ol dl table pre blockquote h1 h2 h3 h4 h5 h6 header footer section article main nav aside address form fieldset figure hr".split())
_SPACE = re.compile(r"[\s\ufeff]+")


def tidy(s: str) -> str:
    return _SPACE.sub(" ", s).strip()


class Node:
    __slots__ = ("children", "name", "parent")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.children: list[Node | str] = []

    def each(self, *names: str):
        """Elements below with one of the names, in document order."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    if child.name in names:
                        yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def text(self) -> str:
        out: list[str] = []
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, str):
                    out.append(child)
                elif child.name not in ("script", "style"):
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()
        return "".join(out)

    def after(self) -> list[Node | str]:
        """What follows this element under its parent."""
        own = self.parent.children if self.parent else []
        at = next(k for k, c in enumerate(own) if c is self)
        return own[at + 1 :]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", None)

    def _close(self, names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        node = self.at
        while node.parent is not None and node.name not in stop:
            if node.name in names:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in ENDS_P:
            self._close(("p",), ("table", "td", "th", "li", "button"))
        node = Node(tag, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.name == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def table_rows(html: str) -> dict:
    """The first table: its first row with a ``th`` as header, and its rows of ``td`` cells; later rows with a ``th`` are left out."""
    table = next(tree(html).each("table"), None)
    headers: list[str] | None = None
    rows: list[list[str]] = []
    for tr in table.each("tr") if table else ():
        heads = [tidy(c.text()) for c in tr.each("th")]
        if heads:
            headers = heads if headers is None else headers
            continue
        cells = [tidy(c.text()) for c in tr.each("td")]
        if cells:
            rows.append(cells)
    return {"headers": headers, "rows": rows}


def pairs_of(html: str) -> dict[str, str]:
    """Keys and values of definition lists, then of bold labels that end in a colon; the first of equal keys stays."""
    root, out = tree(html), {}
    for dl in root.each("dl"):
        for dt in dl.each("dt"):
            key = tidy(dt.text()).removesuffix(":").strip()
            dd = next((c for c in dt.after() if isinstance(c, Node) and c.name == "dd"), None)
            value = tidy(dd.text()) if key and dd else ""
            if value:
                out.setdefault(key, value)
    for label in root.each("strong", "b", "dt"):
        raw = tidy(label.text())
        key = raw[:-1].strip()
        if not raw.endswith(":") or not key or key in out:
            continue
        value: list[str] = []
        for c in label.after():
            if isinstance(c, str):
                value.append(c)
                continue
            if c.name in LABEL_ENDS or c.name in ("strong", "b") and c.text().strip().endswith(":"):
                break
            value.append(c.text())
        if found := tidy("".join(value)):
            out[key] = found
    return out


def lines_of(root: Node) -> str:
    """The text with block elements in lines of their own, before clean-up."""
    out: list[str] = []
    stack: list[tuple] = [(iter(root.children), "")]
    while stack:
        for child in stack[-1][0]:
            if isinstance(child, str):
                out.append(child)
            elif child.name == "br":
                out.append("\n")
            elif child.name not in ("script", "style"):
                mark = "\n" if child.name in BLOCKS else ""
                out.append(mark)
                stack.append((iter(child.children), mark))
                break
        else:
            out.append(stack.pop()[1])
    return "".join(out)


def _mapped(f, schema: T.DataType):
    @F.pandas_udf(schema)
    def run(html: pd.Series) -> pd.Series:
        return html.map(f, na_action="ignore")

    return run


_pairs = _mapped(pairs_of, T.MapType(T.StringType(), T.StringType()))
_items = _mapped(lambda h: [tidy(li.text()) for li in tree(h).each("li")], T.ArrayType(T.StringType()))
_text = _mapped(lambda h: tidy(tree(h).text()), T.StringType())
_lines = _mapped(lambda h: lines_of(tree(h)), T.StringType())


@F.pandas_udf(T.StructType([T.StructField("lines", T.StringType()), T.StructField("line", T.StringType())]))
def _both(html: pd.Series) -> pd.DataFrame:
    # One tree at a time: those of a batch take many times its size.
    def texts(h: str) -> tuple[str, str]:
        parsed = tree(h)
        return lines_of(parsed), tidy(parsed.text())

    both = html.map(texts, na_action="ignore")
    get = lambda k: both.map(lambda b: b[k], na_action="ignore").astype(object)
    return pd.DataFrame({"lines": get(0), "line": get(1)})


TABLE = T.StructType([T.StructField("headers", T.ArrayType(T.StringType())), T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType())))])


@F.pandas_udf(TABLE)
def _table(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([table_rows(h) if h is not None else {"headers": None, "rows": None} for h in html], columns=["headers", "rows"])


def raw_table(html):
    """``(headers, rows)`` of the first table; ``headers`` is null where no row has a ``th``."""
    return _table(html)


def parse_pairs(html):
    """Keys and values as a map."""
    return _pairs(html)


def parse_list(html):
    """The tidied text of each list item, nested items also within their parents'."""
    return _items(html)


def strip_tags(html):
    """The whole text, white space collapsed."""
    return _text(html)


def plain_text(html):
    """The text in lines: blanks collapsed, no blanks around line ends, one empty line at most."""
    return tidy_lines(_lines(html))


def both_texts(html):
    """A struct of the text in lines, before ``tidy_lines``, and of ``strip_tags``, from one parse."""
    return _both(html)


def tidy_lines(lines):
    """Blanks collapsed, no blanks around line ends, one empty line at most."""
    out = F.regexp_replace(lines, "[ \t]+", " ")
    out = F.regexp_replace(F.regexp_replace(out, " ?\n ?", "\n"), "\n{3,}", "\n\n")
    return strip(out)


def headers_and_rows(parsed):
    """Header policy of a ``raw_table`` struct.

    Without any ``th`` the first row is the header, unless it looks like data: one
    of its values occurs in the same column of two or more later rows. Then the
    table has no header and all rows are data.
    """
    rows = parsed["rows"]
    first, rest = F.get(rows, F.lit(0)), F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1)))
    places = F.transform(F.coalesce(first, F.array().cast("array<string>")), lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    repeats = lambda c: F.size(F.filter(rest, lambda r: F.get(r, c["i"]) == c["v"])) >= 2
    data = F.exists(places, lambda c: (c["v"] != "") & repeats(c))
    none = F.array().cast("array<string>")
    has = parsed["headers"].isNotNull()
    headers = F.when(has, parsed["headers"]).when(data | (F.size(rows) == 0), none).otherwise(first)
    return F.struct(headers.alias("headers"), F.when(has | data, rows).otherwise(rest).alias("rows"))
