"""The registered queries of the document operators, each over its whole tables, and their DuckDB SQL.

Inputs are rendered from the driver's tables where an operator reads documents,
so that the right result is a relational query over the originals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.functions import html, text
from tabularium.operators import costs, enrich, groups, hints, records, regions, sampling, schemas, specs
from tabularium.plans import calls
from tabularium.plans import page_diffs as diffs_by_rule
from tabularium.plans import pipeline, stanza_mining, verification
from tabularium.plans.stages import Kept, Stages
from tabularium.session import bound_batches, shared_folder, spread
from tabularium.sources import files, render
from tabularium.streaming import stitch as stitching

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(c: str) -> Column:
    return F.format_string("%.2f", F.col(c))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


#: ``text.tidy`` in SQL.
_tidy_sql = lambda c: f"regexp_replace(regexp_replace({c}, '^[{text.SPACE}]+|[{text.SPACE}]+$', '', 'g'), '[{text.SPACE}]+', ' ', 'g')"


# --- regions, tables, key/value blocks, lists ---


def nation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per region, with one anchored table of its nations."""
    rows = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return render.tables(rows, F.col("r_regionkey").cast("long"), "n_nationkey", [_text("n_nationkey"), F.col("n_name"), F.col("r_name")], ["Nation Key", "NAME", "region-name"], F.col("r_name"))


@query("""
SELECT r_regionkey::BIGINT AS doc_id, 0 AS pos, 'd' || r_regionkey AS id, 'table' AS kind, r_name AS title, count(n_nationkey)::BIGINT AS n_rows
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL""")
def regions_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = regions.find_regions(nation_documents(spark, sf_dir))
    return found.select("doc_id", "pos", "id", "kind", "title", (F.size(F.split("body", "</tr>")) - 2).cast("long").alias("n_rows"))


@query("""
SELECT r_name AS region_name, count(*)::BIGINT AS nations, max(n_name) AS last_name, sum(n_nationkey)::BIGINT AS key_sum
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def nations_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: documents, regions, tables, records, typed columns, counts."""
    found = records.to_groups(records.table_records(regions.find_regions(nation_documents(spark, sf_dir))))
    rows = records.typed(found, {"nationKey": "number", "nAME": "string", "regionName": "string"})
    return rows.groupBy(F.col("regionName").alias("region_name")).agg(F.count("*").alias("nations"), F.max("nAME").alias("last_name"), F.sum("nationKey").cast("long").alias("key_sum"))


def part_documents(spark: SparkSession, sf_dir: str, headers: list[str] | None) -> DataFrame:
    cells = [_text("p_partkey"), F.col("p_name"), F.col("p_brand"), F.lit("stock"), _money("p_retailprice")]
    return render.tables(_table(spark, sf_dir, "part"), F.floor(F.col("p_partkey") / 20), "p_partkey", cells, headers, F.lit("Parts"), "<p>Prices, as of <b>today</b>.</p>")


@query("""
SELECT floor(p_partkey / 20)::BIGINT AS doc_id, (row_number() OVER (PARTITION BY floor(p_partkey / 20) ORDER BY p_partkey) - 1)::BIGINT AS ord,
  p_partkey::VARCHAR AS part_key, p_name AS name, p_brand AS brand, printf('%.2f', p_retailprice) AS price FROM part""")
def table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = part_documents(spark, sf_dir, ["Part key", "name", "Brand_name", "State", "Retail-price"])
    rows = records.to_groups(records.table_records(regions.find_regions(docs)))
    rec = F.col("rec")
    return rows.select("doc_id", "ord", rec["partKey"].alias("part_key"), rec["name"].alias("name"), rec["brandName"].alias("brand"), rec["retailPrice"].alias("price"))


@query("""
WITH d AS (SELECT floor(p_partkey / 20)::BIGINT AS doc_id, p_partkey, p_name, p_brand, printf('%.2f', p_retailprice) AS price,
  row_number() OVER (PARTITION BY floor(p_partkey / 20) ORDER BY p_partkey) - 1 AS r, count(*) OVER (PARTITION BY floor(p_partkey / 20)) AS n FROM part)
SELECT doc_id, r::BIGINT AS ord, p_partkey::VARCHAR AS col1, p_name AS col2, p_brand AS col3, 'stock' AS col4, price AS col5 FROM d WHERE n >= 3""")
def table_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables without a header: a value that repeats in its column shows that the first row is data."""
    rows = records.table_records(regions.find_regions(part_documents(spark, sf_dir, None)))
    return rows.where(F.map_contains_key("rec", F.lit("col1"))).select("doc_id", F.col("row").cast("long").alias("ord"), *(F.col("rec")[f"col{k}"].alias(f"col{k}") for k in range(1, 6)))


@query("""
SELECT c_custkey::BIGINT AS doc_id, c_name AS name, c_mktsegment AS segment, c_nationkey::VARCHAR AS nation, printf('%.2f', c_acctbal) AS balance FROM customer""")
def pair_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition lists and bold labels of one document per customer."""
    c = spread(_table(spark, sf_dir, "customer"), "c_custkey")
    dl = F.concat(F.lit("<dl><dt>Name:</dt><dd>"), "c_name", F.lit("</dd><dt>Market segment<dd> "), "c_mktsegment", F.lit(" </dl>"))
    bold = F.concat(F.lit("<p><b>Nation key:</b> "), _text("c_nationkey"), F.lit(" <strong>Acct-balance:</strong>&nbsp;"), _money("c_acctbal"), F.lit("<br>end</p>"))
    docs = c.select(F.col("c_custkey").alias("doc_id"), render.region(_text("c_custkey"), "kv", F.lit("Customer"), F.concat(dl, bold)).alias("html"))
    rec = F.col("rec")
    rows = records.pair_records(regions.find_regions(docs))
    return rows.select("doc_id", rec["name"].alias("name"), rec["marketSegment"].alias("segment"), rec["nationKey"].alias("nation"), rec["acctBalance"].alias("balance"))


@query("""
SELECT page_id, len(regexp_extract_all(html, '(?i)<li[ >]'))::BIGINT AS items FROM pages""")
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", F.when(F.col("html").isNotNull(), F.size(html.parse_list(F.col("html")))).cast("long").alias("items"))


@query()
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text of every page, in lines, and as one line."""
    bound_batches(spark)
    pages = _table(spark, sf_dir, "pages").select("page_id", html.both_texts(F.col("html")).alias("texts"))
    return pages.select("page_id", html.tidy_lines(F.col("texts.lines")).alias("lines"), "texts.line")


@query("""
WITH s AS (SELECT s_suppkey, floor(s_suppkey / 25) AS doc, s_name, row_number() OVER (PARTITION BY floor(s_suppkey / 25) ORDER BY s_suppkey) - 1 AS pos,
  lead(s_name) OVER (PARTITION BY floor(s_suppkey / 25) ORDER BY s_suppkey) AS second_title FROM supplier),
g AS (SELECT *, 'continued after ' || s_name AS gap FROM s WHERE second_title IS NOT NULL AND s_suppkey % 3 <> 0)
SELECT doc::BIGINT AS doc_id, pos::INTEGER AS pos, s_name AS first_title, second_title, length(gap)::BIGINT AS gap_chars, gap AS gap_text FROM g""")
def table_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of several tables, some with prose between, some without."""
    s = _table(spark, sf_dir, "supplier")
    table = F.concat(F.lit("<table><tr><th>Key</th></tr><tr><td>"), _text("s_suppkey"), F.lit("</td></tr></table>"))
    prose = F.when(F.col("s_suppkey") % 3 == 0, F.lit("<hr>  ")).otherwise(F.concat(F.lit("<p>continued <i>after</i>\n "), "s_name", F.lit("</p>")))
    part = F.concat(render.region(_text("s_suppkey"), "table", F.col("s_name"), table), prose)
    listed = F.sort_array(F.collect_list(F.struct("s_suppkey", part.alias("part"))))
    docs = s.groupBy(F.floor(F.col("s_suppkey") / 25).alias("doc_id")).agg(F.array_join(F.transform(listed, lambda x: x["part"]), "").alias("html"))
    return regions.adjacent_tables(docs)


@query("""
SELECT s_suppkey::BIGINT AS doc_id, 0::BIGINT AS ord, s_name AS name, (s_suppkey * 7)::VARCHAR || ' Main Street' AS street, 'Town' || s_nationkey AS city, 'UK' AS country
FROM supplier""")
def stanza_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier")
    block = F.concat(F.lit("<p>Some prose before.</p>\n"), "s_name", F.lit("<br>"), (F.col("s_suppkey") * 7).cast("string"), F.lit(" Main Street<br>Town"), _text("s_nationkey"), F.lit(", UK<br><div>More prose</div>"))
    docs = s.select(F.col("s_suppkey").alias("doc_id"), html.plain_text(block).alias("text"))
    rows = records.stanzas(docs, [("name", r"\S"), ("street", r"\d"), ("city,country", r"^(.+),\s*([A-Z]{2})$")])
    rec = F.col("rec")
    return rows.select("doc_id", "ord", rec["name"].alias("name"), rec["street"].alias("street"), rec["city"].alias("city"), rec["country"].alias("country"))


def layout_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``: twelve customers a document, between prose; as stanzas with or without blank lines between, or as lines with bars."""
    c = _table(spark, sf_dir, "customer")
    doc, words = F.floor(F.col("c_custkey") / 12), F.initcap(F.lower("c_mktsegment"))
    stanza = F.concat(words, F.lit(" Ltd\n"), _text("c_custkey"), F.lit(" High Street\nTown, "), words)
    blank = F.concat(stanza, F.lit("\n"))
    line = F.concat(words, F.lit(" | "), _text("c_custkey"), F.lit(" | "), F.translate(F.lower("c_mktsegment"), "aeiou", "uoiea"))
    one = F.when(doc % 3 == 0, stanza).when(doc % 3 == 1, line).otherwise(blank)
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", one.alias("t")))), lambda x: x["t"]), "\n")
    rows = c.groupBy(doc.alias("doc_id")).agg(listed.alias("listed"))
    return rows.select("doc_id", F.concat(F.lit("Approved Customers 2023\nBelow is a list of approved customers.\n\n"), "listed", F.lit("\nEnd of list.")).alias("text"))


def _whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``layout_texts`` and all documents, these with negative ids."""
    docs = _table(spark, sf_dir, "documents").select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    return layout_texts(spark, sf_dir).unionByName(docs)


_LAYOUT_SQL = """
u AS (SELECT floor(c_custkey / 12)::BIGINT AS doc_id, c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS w, translate(lower(c_mktsegment), 'aeiou', 'uoiea') AS v FROM customer),
x AS (SELECT doc_id, 'Approved Customers 2023' || chr(10) || 'Below is a list of approved customers.' || chr(10) || chr(10) || string_agg(CASE doc_id % 3 WHEN 1 THEN w || ' | ' || c_custkey || ' | ' || v
    ELSE w || ' Ltd' || chr(10) || c_custkey || ' High Street' || chr(10) || 'Town, ' || w || CASE doc_id % 3 WHEN 2 THEN chr(10) ELSE '' END END, chr(10) ORDER BY c_custkey) || chr(10) || 'End of list.' AS text FROM u GROUP BY 1),
t AS (SELECT * FROM x UNION ALL SELECT -1 - doc_id, text FROM documents)"""
_SHAPES_SQL = rf"""{_LAYOUT_SQL},
l AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM t)),
s AS (SELECT doc_id, pos, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_tidy_sql('line')}, '[^ ,:;|/]*\d[^ ,:;|/]*', '0', 'g'),
  '[^ ,:;|/.!?0-9]*\pL[^ ,:;|/.!?0-9]*', 'a', 'g'), 'a( a)+', 'a', 'g'), '0( 0)+', '0', 'g') AS shape FROM l),
o AS (SELECT *, shape <> '' AND length(shape) <= 40 AND NOT regexp_matches(shape, '[.!?]$') AS ok FROM s),
k AS (SELECT a.doc_id, a.pos, z.size::INT AS size, array_agg(b.shape ORDER BY b.pos) AS run FROM o a, range(1, 6) z(size), o b
  WHERE b.doc_id = a.doc_id AND b.pos >= a.pos AND b.pos < a.pos + z.size AND b.ok GROUP BY ALL HAVING count(*) = any_value(z.size)),
r AS (SELECT doc_id, size, array_to_string(run, chr(10)) AS shapes, pos FROM k WHERE len(list_filter(range(1, size), lambda b: run[1:b] = run[size - b + 1:size])) = 0
  AND CASE WHEN size = 1 THEN regexp_matches(run[1], '[,:;|/]') AND len(regexp_extract_all(run[1], '[a0]')) >= 2 ELSE len(list_filter(run, lambda v: regexp_matches(v, '[0,:;|/]'))) > 0 END),
c AS (SELECT doc_id, size, shapes, count(*) AS n, min(pos) AS first FROM r GROUP BY doc_id, size, shapes HAVING count(*) >= 3),
n AS (SELECT doc_id, size, shapes, row_number() OVER (PARTITION BY doc_id ORDER BY n * size DESC, size DESC, first) AS place FROM c),
i AS (SELECT doc_id, place, size, shapes, pos, unnest(range(pos, pos + size)) AS line FROM r JOIN n USING (doc_id, size, shapes)),
w AS (SELECT doc_id, place, size, shapes, pos FROM (SELECT *, min(place) OVER (PARTITION BY doc_id, line) AS owner FROM i) GROUP BY ALL HAVING bool_and(place = owner)),
m AS (SELECT doc_id, size, shapes, count(*)::BIGINT AS approx_count, min(pos)::INT AS first_line FROM w GROUP BY doc_id, size, shapes HAVING count(*) >= 3)"""


@query(f"WITH {_SHAPES_SQL} SELECT doc_id, 'stanza-' || row_number() OVER (PARTITION BY doc_id ORDER BY first_line) AS name, size, shapes, approx_count, first_line FROM m")
def mined_stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layouts that texts repeat, of customers' lists and of all documents."""
    return stanza_mining.mine_stanzas(_whole_texts(spark, sf_dir)).drop("fields")


@query("""
SELECT floor(c_custkey / 12)::BIGINT AS doc_id, (row_number() OVER (PARTITION BY floor(c_custkey / 12) ORDER BY c_custkey) - 1)::BIGINT AS ord, c_custkey::VARCHAR AS key,
  upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || CASE floor(c_custkey / 12) % 3 WHEN 1 THEN '' ELSE ' Ltd' END AS name,
  CASE floor(c_custkey / 12) % 3 WHEN 1 THEN translate(lower(c_mktsegment), 'aeiou', 'uoiea') ELSE upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) END AS place
FROM customer WHERE floor(c_custkey / 12) IN (SELECT floor(c_custkey / 12) FROM customer GROUP BY 1 HAVING count(*) >= 3)""")
def mined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the proposed patterns extract: each customer once, whichever layout their document has."""
    texts = layout_texts(spark, sf_dir)
    rec = F.col("rec")
    rows = stanza_mining.stanza_records(texts, stanza_mining.mine_stanzas(texts))
    barred = F.col("doc_id") % 3 == 1
    return rows.select(
        "doc_id", "ord", F.when(barred, rec["line1b"]).otherwise(rec["line2a"]).alias("key"), F.when(barred, rec["line1a"]).otherwise(rec["line1"]).alias("name"),
        F.when(barred, rec["line1c"]).otherwise(rec["line3b"]).alias("place"),
    )


# --- extraction by a table of rules ---


def ruled_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One document per customer in one of five layouts, and the rules: of tables for all documents, of the other layouts for each its own."""
    c = spread(_table(spark, sf_dir, "customer"), "c_custkey").withColumn("way", F.col("c_custkey") % 5)
    key, seg, way = _text("c_custkey"), F.col("c_mktsegment"), F.col("way")
    row = lambda *cells: render.row(list(cells))
    table = F.concat(F.lit("<table>"), row(F.lit("Key No"), F.lit("Segment")), *[row(key, seg)] * 3, F.lit("</table>"))
    pairs = F.concat(F.lit("<dl><dt>Customer key</dt><dd>"), key, F.lit("</dd><dt>Market</dt><dd>"), seg, F.lit("</dd><dt>Other</dt><dd>x</dd></dl>"))
    items = F.concat(F.lit("<ul><li>"), key, F.lit(" = "), seg, F.lit("</li><li>no pair</li></ul>"))
    lines = F.concat(F.lit("<p>Intro text.<br>No. "), key, F.lit("<br>in "), seg, F.lit("<br>No. 7<br>elsewhere</p>"))
    turned = F.concat(F.lit("<p>in "), seg, F.lit("<br>No. "), key, F.lit("<br>The end.</p>"))
    made = [("table", table), ("kv", pairs), ("list", items), ("text", lines), ("text", turned)]
    body = F.coalesce(*(F.when(way == k, render.region(key, kind, F.lit(f"Layout {k}"), b)) for k, (kind, b) in enumerate(made)))
    docs = c.select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("<h1>Customer</h1>"), body).alias("html"))
    field = lambda name, pattern: F.struct(F.lit(name).alias("name"), F.lit(pattern).alias("pattern"))
    number, market = field("key", r"^No\. (\d+)$"), field("segment", "^in (.+)$")
    own = [F.array(field("key", "(?i)key"), field("segment", "^Market$")), F.array(field("key,segment", "^([0-9]+) = (.+)$")), F.array(number, market), F.array(market, number)]
    none = F.lit(None).cast("string")
    ruled = c.where(way > 0).select(
        F.col("c_custkey").alias("doc_id"), F.lit(1).alias("spec_ord"), none.alias("kind"), none.alias("title"),
        F.coalesce(*(F.when(way == k, h) for k, h in ((1, "pairs"), (2, "list"), (3, "text"), (4, "text")))).alias("helper"), none.alias("headers"), F.lit("customers").alias("group_name"),
        F.coalesce(*(F.when(way == k + 1, f) for k, f in enumerate(own))).alias("fields"),
    )
    # For all documents: tables with their first row as header, before a rule of lower order; and a rule for any region, which the documents' own go before.
    fields = F.lit(None).cast("array<struct<name:string,pattern:string>>")
    general = [(1, "table", "table", "first"), (2, "table", "table", "none"), (0, None, "text", None)]
    whole = [spark.range(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(o).alias("spec_ord"), F.lit(k).cast("string").alias("kind"), none.alias("title"), F.lit(h).alias("helper"), F.lit(p).cast("string").alias("headers"), F.lit("customers").alias("group_name"), fields.alias("fields")) for o, k, h, p in general]
    return docs, groups.combine(ruled, *whole)


@query("""
SELECT c_custkey AS doc_id, 'customers' AS group_name, r::INT AS row, c_custkey::VARCHAR AS key, c_mktsegment AS segment, CASE WHEN c_custkey % 5 = 0 THEN 'keyNo' ELSE 'key' END AS first_name
FROM customer, range(3) t(r) WHERE r = 0 OR c_custkey % 5 = 0""")
def spec_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables, key/value blocks, lists and stanzas in either order, each document by its own rule, in one plan."""
    docs, spec = ruled_documents(spark, sf_dir)
    rows = specs.records_by_spec(regions.find_regions(docs), spec)
    rec = F.col("rec")
    first = F.get(F.filter(F.map_keys("rec"), lambda k: k != "segment"), F.lit(0))
    return rows.select("doc_id", "group_name", "row", F.coalesce(rec["key"], rec["keyNo"]).alias("key"), rec["segment"].alias("segment"), first.alias("first_name"))


# --- hints ---


@query("""
WITH h AS (
  SELECT user_id AS doc_id, event_id, ts, event_type, event_id % 5 = 0 AS cont, (event_id % 3)::INTEGER AS c, value,
    CASE WHEN event_id % 5 = 0 AND event_id % 2 = 0 THEN event_type END AS prev FROM events),
p AS (
  SELECT *, last_value(CASE WHEN NOT cont THEN event_type || '|' || c END IGNORE NULLS) OVER w_title AS by_title,
    last_value(CASE WHEN NOT cont THEN event_type || '|' || c END IGNORE NULLS) OVER w_cols AS by_cols FROM h
  WINDOW w_title AS (PARTITION BY doc_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    w_cols AS (PARTITION BY doc_id, c ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, coalesce(CASE WHEN cont AND prev IS NOT NULL THEN by_title WHEN cont AND c > 0 THEN by_cols END, event_type || '|' || c) AS of FROM p)
SELECT doc_id, split_part(of, '|', 1) AS title, split_part(of, '|', 2)::INTEGER AS n_cols, count(DISTINCT event_id)::BIGINT AS pages,
  count(*)::DOUBLE AS total_records, min(event_id)::BIGINT AS first_page FROM k GROUP BY ALL""")
def hints_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as hints of a document: some continue earlier ones, by title or by number of columns."""
    e = _table(spark, sf_dir, "events")
    n = (F.col("event_id") % 3).cast("int")
    schema = F.map_from_entries(F.transform(F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), n), lambda k: F.struct(k.alias("k"), F.lit("string").alias("v"))))
    cont = F.col("event_id") % 5 == 0
    made = e.select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("page"), F.lit(0).alias("place"), _text("event_id").alias("id"), F.lit("table").alias("kind"),
        F.col("event_type").alias("title"), F.lit("").alias("description"), schema.alias("schema_guess"), F.lit(1.0).alias("record_count"), cont.alias("is_continuation"),
        F.when(cont & (F.col("event_id") % 2 == 0), F.upper("event_type")).alias("continues_previous"),
    )
    out = hints.aggregate_hints(made)
    return out.select("doc_id", "title", F.size("schema_guess").alias("n_cols"), F.size("pages").cast("long").alias("pages"), "total_records", F.col("first.page").cast("long").alias("first_page"))


# --- groups ---


def _fields(*names: str) -> Column:
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit("string").alias("type")) for n in names))


def _group(spark: SparkSession, doc: int, name: str, fields: list[str]) -> DataFrame:
    return spark.range(1).select(F.lit(doc).cast("long").alias("doc_id"), F.lit(name).alias("group_name"), F.lit(name).alias("title"), _fields(*fields).alias("fields"))


def _records(rows: DataFrame, doc: Column, name: Column, ord_: Column, /, **cells: Column) -> DataFrame:
    rec = F.create_map(*(x for k, v in cells.items() for x in (F.lit(k), v.cast("string"))))
    return rows.select(doc.cast("long").alias("doc_id"), name.alias("group_name"), ord_.cast("long").alias("ord"), rec.alias("rec"))


@query("""
SELECT o_orderkey::BIGINT AS ord, o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS id2, o_orderstatus AS status, o_orderpriority AS order_priority FROM orders""")
def field_map_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields map to one name, of which the second gets a suffix; one isn't mapped at all."""
    o = _table(spark, sf_dir, "orders")
    rec = _records(o, F.lit(1), F.lit("orders"), F.col("o_orderkey"), **{"Order Key": F.col("o_orderkey"), "Customer Key": F.col("o_custkey"), "Status": F.col("o_orderstatus"), "order-priority": F.col("o_orderpriority")})
    own = _group(spark, 1, "orders", ["Order Key", "Customer Key", "Status", "order-priority"])
    names = F.create_map(*(F.lit(x) for x in ("Order Key", "id", "Customer Key", "id", "Status", "status", "Absent", "x")))
    mapping = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.lit("orders").alias("group_name"), names.alias("field_map"))
    _, out = groups.rename_fields(own, rec, mapping)
    return out.select("ord", *(F.col("rec")[k].alias(v) for k, v in (("id", "id"), ("id2", "id2"), ("status", "status"), ("orderPriority", "order_priority"))))


def _status_groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = _table(spark, sf_dir, "orders").withColumn("doc", F.floor(F.col("o_custkey") / 30))
    low = lambda s: F.col("o_orderstatus") == s
    f = _records(o.where(low("F")), F.col("doc"), F.lit("finished"), F.col("o_orderkey"), **{"Order Key": F.col("o_orderkey"), "Total": _money("o_totalprice")})
    p = _records(o.where(low("O")), F.col("doc"), F.lit("open"), F.col("o_orderkey"), **{"KEY": F.col("o_orderkey"), "Total": _money("o_totalprice"), "Prio": F.col("o_orderpriority")})
    q = _records(o.where(low("P")), F.col("doc"), F.lit("other"), F.col("o_orderkey"), **{"key": F.col("o_orderkey")})
    rec = groups.combine(f, p, q)
    return rec.groupBy("doc_id", "group_name").agg(F.first("group_name").alias("title"), F.transform(F.map_keys(F.first("rec")), lambda k: F.struct(k.alias("name"), F.lit("string").alias("type"))).alias("fields")), rec


def _status_plan(own: DataFrame, kind: str) -> DataFrame:
    maps = F.create_map(
        F.lit("finished"), F.create_map(F.lit("Order Key"), F.lit("orderKey")), F.lit("open"), F.create_map(F.lit("KEY"), F.lit("orderKey"), F.lit("Prio"), F.lit("priority"))
    )
    return own.select("doc_id").distinct().select("doc_id", F.lit(kind).alias("plan_id"), F.array(*map(F.lit, ("finished", "open", "absent"))).alias("groups"), F.lit("all").alias("target"), maps.alias("field_maps"))


_MERGE_SQL = """
WITH o AS (SELECT *, floor(o_custkey / 30) AS doc_id FROM orders),
pair AS (SELECT doc_id FROM o GROUP BY doc_id HAVING count(*) FILTER (o_orderstatus = 'F') > 0 AND count(*) FILTER (o_orderstatus = 'O') > 0),
m AS (SELECT doc_id::BIGINT AS doc_id, CASE WHEN o_orderstatus = 'P' THEN 'other' WHEN doc_id IN (FROM pair) THEN 'all' WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS group_name,
  o_orderstatus AS s, o_orderkey, o_totalprice, o_orderpriority FROM o WHERE o_orderstatus IN ('F', 'O', 'P'))
SELECT doc_id, group_name,
  (CASE WHEN group_name = 'all' THEN row_number() OVER (PARTITION BY doc_id, group_name ORDER BY s, o_orderkey) - 1 ELSE o_orderkey END)::BIGINT AS ord,
  o_orderkey::VARCHAR AS order_key, CASE WHEN s <> 'P' THEN printf('%.2f', o_totalprice) END AS total, CASE WHEN s = 'O' THEN o_orderpriority END AS priority FROM m"""


def _merged(spark: SparkSession, sf_dir: str, camel: bool) -> DataFrame:
    own, rec = _status_groups(spark, sf_dir)
    _, out = groups.merge_groups(own, rec, _status_plan(own, "p"), camel=camel)
    r = F.col("rec")
    total = F.coalesce(r["total"], r["Total"]) if camel else r["Total"]
    return out.select("doc_id", "group_name", "ord", F.coalesce(r["orderKey"], r["Order Key"], r["KEY"], r["key"]).alias("order_key"), total.alias("total"), F.coalesce(r["priority"], r["Prio"]).alias("priority"))


@query(_MERGE_SQL)
def row_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, camel=True)


@query(_MERGE_SQL)
def group_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, camel=False)


@query("""
SELECT doc AS doc_id, (row_number() OVER (PARTITION BY doc ORDER BY p_partkey, k) - 1)::BIGINT AS ord, v AS label, p_partkey::VARCHAR AS part FROM (
  SELECT floor(p_partkey / 500)::BIGINT AS doc, p_partkey, k, v FROM (
  SELECT p_partkey, 0 AS k, p_brand AS v FROM part UNION ALL SELECT p_partkey, 1, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END FROM part
  UNION ALL SELECT p_partkey, 2, CASE WHEN p_size % 2 = 0 THEN p_name END FROM part)) WHERE v IS NOT NULL AND v <> ''""")
def column_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    doc = F.floor(F.col("p_partkey") / 500)
    kind = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type"))
    rec = _records(p, doc, F.lit("parts"), F.col("p_partkey"), part=F.col("p_partkey"), l1=F.col("p_brand"), l2=kind, l3=F.when(F.col("p_size") % 2 == 0, F.col("p_name")))
    listed = lambda *n: F.array(*map(F.lit, n))
    plan = p.select(doc.alias("doc_id")).distinct().select(
        "doc_id", F.lit("parts").alias("group_name"), listed("l1", "l2", "l3").alias("pivot_fields"), F.lit("label").alias("target_field"),
        listed("part").alias("keep_fields"), F.lit("labels").alias("target"),
    )
    return groups.unpivot_group(rec, plan).select("doc_id", "ord", F.col("rec")["label"].alias("label"), F.col("rec")["part"].alias("part"))


@query("""
SELECT 'customers' AS group_name, c_custkey AS ord, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'suppliers', s_suppkey, s_name, NULL FROM supplier""")
def combine_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "supplier")
    a = _records(c, F.lit(1), F.lit("customers"), F.col("c_custkey"), name=F.col("c_name"), segment=F.col("c_mktsegment"))
    b = _records(s, F.lit(1), F.lit("suppliers"), F.col("s_suppkey"), name=F.col("s_name"))
    return groups.combine(a, b).select("group_name", "ord", F.col("rec")["name"].alias("name"), F.col("rec")["segment"].alias("segment"))


@query("""
WITH g AS (SELECT (l_suppkey % 20)::BIGINT AS doc_id, l_returnflag || l_linestatus AS group_name, count(*)::BIGINT AS n_records FROM lineitem GROUP BY ALL)
SELECT *, CASE WHEN group_name LIKE 'R%' THEN 2 ELSE 0 END::INTEGER AS n_fields, n_records * CASE WHEN group_name LIKE 'R%' THEN 2 ELSE 1 END AS cells,
  row_number() OVER (PARTITION BY doc_id ORDER BY n_records * CASE WHEN group_name LIKE 'R%' THEN 2 ELSE 1 END DESC, n_records DESC,
    CASE WHEN group_name LIKE 'R%' THEN 2 ELSE 0 END DESC, group_name)::INTEGER AS rank FROM g""")
def rank_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("doc_id"), F.concat("l_returnflag", "l_linestatus").alias("group_name"))
    none = F.array().cast("array<struct<name:string,type:string>>")
    own = rows.distinct().withColumn("fields", F.when(F.startswith(F.col("group_name"), F.lit("R")), _fields("a", "b")).otherwise(none))
    return groups.rank_groups(own, rows)


@query("""
SELECT 1::BIGINT AS doc_id, o_orderkey::BIGINT AS left_ord, c_custkey::BIGINT AS right_ord, c_name AS name, o_orderstatus AS status FROM orders FULL JOIN customer ON o_custkey + 700 = c_custkey""")
def join_spec_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full outer join: customers without an order have their document too, as do orders without a customer."""
    o, c = _join_sides(spark, sf_dir, shift=700)
    out = groups.join_groups(o, c, [("cust", "key")], how="full_outer")
    return out.select("doc_id", "left_ord", "right_ord", F.col("rec")["name"].alias("name"), F.col("rec")["status"].alias("status"))


def _join_sides(spark: SparkSession, sf_dir: str, shift: int = 0) -> tuple[DataFrame, DataFrame]:
    o = _table(spark, sf_dir, "orders")
    c = _table(spark, sf_dir, "customer")
    left = _records(o, F.lit(1), F.lit("orders"), F.col("o_orderkey"), cust=F.col("o_custkey") + shift, status=F.col("o_orderstatus"))
    return left, _records(c, F.lit(1), F.lit("customers"), F.col("c_custkey"), key=F.col("c_custkey"), name=F.col("c_name"))


@query("""
WITH l AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT c_custkey AS k, count(*) AS m FROM customer GROUP BY 1),
b AS (SELECT n, m FROM l FULL JOIN r USING (k))
SELECT count(*)::BIGINT AS n_keys, coalesce(max(n), 0)::BIGINT AS left_max, coalesce(max(m), 0)::BIGINT AS right_max, count(*) FILTER (n IS NOT NULL AND m IS NOT NULL)::BIGINT AS matched_keys,
  CASE WHEN max(n) > 1 THEN 'many' ELSE 'one' END || '-to-' || CASE WHEN max(m) > 1 THEN 'many' ELSE 'one' END AS cardinality FROM b""")
def join_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.profile_join(*_join_sides(spark, sf_dir), [("cust", "key")])


@query("""
WITH l AS (SELECT o_custkey AS doc_id, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders)
SELECT doc_id, any_value(total)::BIGINT AS n_records, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS samples FROM l WHERE n <= 3 GROUP BY doc_id""")
def group_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three records of each group, as a proposer would see them."""
    o = _table(spark, sf_dir, "orders")
    rec = _records(o, F.col("o_custkey"), F.lit("orders"), F.col("o_orderkey"), key=F.col("o_orderkey"))
    out = groups.summaries(rec.select("doc_id", "group_name").distinct(), rec)
    return out.select("doc_id", "n_records", F.array_join(F.transform("samples", lambda r: r["key"]), ",").alias("samples"))


# --- addresses, lookups, verification ---

_ADDRESS_SQL = """
a AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS street, CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE n_name END AS city, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
f AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(trim(street), '') || ', ' || coalesce(trim(city), '') || ', ' || country, '\\s*,\\s*,+', ', ', 'g'),
  '^\\s*[,\\s]+|[,\\s]+$', '', 'g'), '\\s+', ' ', 'g')) AS address FROM a)"""


def _addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = _table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    street, city = F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")), F.when(F.col("c_custkey") % 5 == 0, " ").otherwise(F.col("n_name"))
    rec = _records(c, F.lit(1), F.lit("customers"), F.col("c_custkey"), street=street, city=city, country=F.col("r_name"))
    columns = F.array(*map(F.lit, ("street", "city", "country")))
    plan = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.lit("customers").alias("group_name"), F.lit(True).alias("has_address"), F.lit("{street}, {city}, {country}").alias("join_template"), columns.alias("columns"))
    return enrich.with_addresses(rec, plan)


@query(f"WITH {_ADDRESS_SQL} SELECT ord, address FROM f")
def final_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _addressed(spark, sf_dir).select("ord", F.col("rec")["address"].alias("address"))


_GEO_SQL = """s AS (SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Office of ' || n_name END AS query FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT *, query IS NOT NULL AND s_nationkey % 6 <> 0 AS found FROM s)"""


def _geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' addresses, many of which are the same, looked up in a table of places."""
    n = _table(spark, sf_dir, "nation")
    places = n.where("n_nationkey % 6 <> 0").select(
        F.concat(F.lit("Office of "), "n_name").alias("query"), F.upper("n_name").alias("formatted_address"), F.col("n_nationkey").cast("double").alias("lat"), (-F.col("n_nationkey")).cast("double").alias("lng"),
        F.concat(F.lit("place"), _text("n_nationkey")).alias("place_id"), F.when(F.col("n_nationkey") % 2 == 0, "ROOFTOP").alias("location_type"), (F.col("n_nationkey") % 3 == 0).alias("partial_match"),
    )
    s = _table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    address = F.when(F.col("s_suppkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" Office of "), "n_name"))
    rec = _records(s, F.lit(1), F.lit("suppliers"), F.col("s_suppkey"), name=F.col("s_name"), address=address)
    return enrich.geocode(rec, enrich.gazetteer_lookup(places))


@query(f"""WITH {_GEO_SQL} SELECT s_suppkey::BIGINT AS ord, query, CASE WHEN found THEN 'OK' WHEN query IS NOT NULL THEN 'ZERO_RESULTS' END AS status,
  CASE WHEN found THEN upper(query[11:]) END AS formatted_address, CASE WHEN found THEN s_nationkey::DOUBLE END AS lat FROM g""")
def geocode_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geocoded(spark, sf_dir).select("ord", "geocode.query", "geocode.status", "geocode.formatted_address", "geocode.lat")


@query(f"""WITH {_GEO_SQL} SELECT count(*)::BIGINT AS total, count(*) FILTER (found)::BIGINT AS located, count(DISTINCT query)::BIGINT AS unique_queries,
  count(DISTINCT query)::BIGINT AS api_calls, 0::BIGINT AS retries, (count(query) - count(DISTINCT query))::BIGINT AS cache_hits, (count(*) - count(query))::BIGINT AS skipped, (count(DISTINCT query) / 1000 * 5.0)::DECIMAL(18,6) AS cost_usd FROM g""")
def geocode_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.geocode_meta(_geocoded(spark, sf_dir))


@query(f"""WITH {_GEO_SQL} SELECT s_suppkey::BIGINT AS ord, 'Point' AS point, -s_nationkey::DOUBLE AS lng, s_nationkey::DOUBLE AS lat, upper(query[11:]) AS formatted_address, 'place' || s_nationkey AS place_id,
  CASE WHEN s_nationkey % 2 = 0 THEN 'ROOFTOP' END AS location_type, s_nationkey % 3 = 0 AS partial_match, 'OK' AS status, s_name AS supplier FROM g WHERE found""")
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.features(_geocoded(spark, sf_dir))
    about = "name:string,formattedAddress:string,placeId:string,locationType:string,partialMatch:boolean,geocodeStatus:string"
    f = F.from_json("feature", f"type string, geometry struct<type:string,coordinates:array<double>>, properties struct<{about}>")
    place, p = f["geometry"]["coordinates"], f["properties"]
    return rows.select(
        "ord", f["geometry"]["type"].alias("point"), place[0].alias("lng"), place[1].alias("lat"), p["formattedAddress"].alias("formatted_address"), p["placeId"].alias("place_id"),
        p["locationType"].alias("location_type"), p["partialMatch"].alias("partial_match"), p["geocodeStatus"].alias("status"), p["name"].alias("supplier"),
    )


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rec = _records(docs, F.lit(1), F.lit("documents"), F.col("doc_id"), lang=F.col("lang"), source=F.col("source")).withColumn("doc_id", F.col("ord") % 10)
    labels = _table(spark, sf_dir, "labels")
    sure = F.when(F.col("quality") == 1, "HIGH").when(F.col("toxic") == 1, "maybe").otherwise("low")
    found = labels.select(
        (F.col("doc_id") % 10).alias("doc_id"), F.lit("documents").alias("group_name"), F.col("doc_id").alias("ord"), sure.alias("confidence"),
        *(F.lit(None).cast("string").alias(c) for c in ("matched_name", "matched_address", "evidence")),
    )
    return enrich.attach_verifications(rec, found)


_VERIFY = "CASE WHEN quality = 1 THEN 'high' WHEN toxic = 1 THEN 'unknown' WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 'low' ELSE 'unknown' END"


@query(f"SELECT doc_id AS ord, lang, {_VERIFY} AS confidence FROM documents LEFT JOIN labels USING (doc_id)")
def verify_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verified(spark, sf_dir).select("ord", F.col("rec")["lang"].alias("lang"), "verification.confidence")


@query(f"""WITH v AS (SELECT doc_id % 10 AS doc_id, {_VERIFY} AS c FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, {', '.join(f"count(*) FILTER (c = '{c}')::BIGINT AS {c}" for c in ('high', 'medium', 'low', 'unknown'))} FROM v GROUP BY doc_id""")
def verify_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.confidence_histogram(_verified(spark, sf_dir))


@query("""
SELECT o_custkey AS doc_id, o_orderkey AS ord, (row_number() OVER w - 1)::BIGINT AS index, floor((row_number() OVER w - 1) / 5)::BIGINT AS batch FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def verify_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _records(_table(spark, sf_dir, "orders"), F.col("o_custkey"), F.lit("orders"), F.col("o_orderkey"), key=F.col("o_orderkey"))
    return enrich.batches(rec).select("doc_id", "ord", "index", "batch")


@query("""
WITH a AS (SELECT floor(c_custkey / 100)::BIGINT AS doc_id, 'customers' AS group_name, c_custkey AS ord, c_name AS name, c_mktsegment AS town, c_nationkey::VARCHAR AS land FROM customer
  UNION ALL SELECT floor(s_suppkey / 100)::BIGINT, 'suppliers', s_suppkey, NULL, s_name, s_nationkey::VARCHAR FROM supplier),
i AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, group_name ORDER BY ord) - 1)::BIGINT AS index FROM a)
SELECT doc_id, group_name, index, index // 5 AS batch, index::VARCHAR AS told_index, name, town || ', ' || land AS address, town, NULL::VARCHAR AS other FROM i""")
def verification_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of groups, one with a name field and one without; what isn't part of the address isn't told.

    Suppliers have an old ``fullAddress``, every second of them an old ``address`` too: the verifier is told the composed one.
    """
    c, s = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "supplier")
    a = _records(c, F.floor(F.col("c_custkey") / 100), F.lit("customers"), F.col("c_custkey"), company=F.col("c_name"), town=F.col("c_mktsegment"), land=F.col("c_nationkey"), other=F.lit("x"))
    b = _records(s, F.floor(F.col("s_suppkey") / 100), F.lit("suppliers"), F.col("s_suppkey"), town=F.col("s_name"), land=F.col("s_nationkey"), other=F.lit("y"), fullAddress=F.lit("an old one"))
    old = F.map_concat("rec", F.create_map(F.lit("address"), F.lit("an older one")))
    rec = groups.combine(a, b.withColumn("rec", F.when(F.col("ord") % 2 == 0, old).otherwise(F.col("rec"))))
    own = rec.select("doc_id", "group_name").distinct()
    own = own.withColumn("fields", F.when(F.col("group_name") == "customers", _fields("company", "town", "land", "other")).otherwise(_fields("town", "land", "other")))
    plan = own.select("doc_id", "group_name", F.lit(True).alias("has_address"), F.lit("{town}, {land}").alias("join_template"), F.array(F.lit("town"), F.lit("land")).alias("columns"))
    told = enrich.verification_inputs(enrich.with_addresses(rec, plan), own, plan)
    v = F.col("input")
    return told.select("doc_id", "group_name", "index", "batch", v["index"].alias("told_index"), v["name"].alias("name"), v["address"].alias("address"), v["town"].alias("town"), v["other"].alias("other"))


# --- costs ---


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    model = F.concat(F.lit("gemini-"), F.element_at(F.array(*map(F.lit, ("2.5-pro", "2.5-flash", "2.5-flash-lite-001", "1.5-pro-x", "9-new"))), (F.col("event_id") % 5 + 1).cast("int")))
    stage = F.concat(F.col("event_type"), F.lit(":p"), (F.col("event_id") % 3).cast("string"))
    rows = e.select(stage.alias("stage"), model.alias("model"), F.col("user_id").alias("input_tokens"), (F.col("event_id") % 1000).alias("output_tokens"))
    return costs.priced(rows, spark.createDataFrame(costs.PRICES, "name string, in_price double, out_price double"))


_LEDGER_SQL = f"""
p(name, i, o) AS (VALUES {', '.join(f"('{n}', {i}::DECIMAL(12,6), {o}::DECIMAL(12,6))" for n, i, o in costs.PRICES)}),
l AS (SELECT event_type || ':p' || event_id % 3 AS stage, 'gemini-' || ['2.5-pro', '2.5-flash', '2.5-flash-lite-001', '1.5-pro-x', '9-new'][event_id % 5 + 1] AS model,
  user_id AS input_tokens, event_id % 1000 AS output_tokens FROM events),
m AS (SELECT model, arg_max(i, length(name)) AS i, arg_max(o, length(name)) AS o FROM (SELECT DISTINCT model FROM l) JOIN p ON starts_with(model, name) GROUP BY model),
c AS (SELECT l.*, (coalesce(input_tokens * i / 1000000, 0) + coalesce(output_tokens * o / 1000000, 0)) AS cost_usd, i IS NOT NULL AS known FROM l LEFT JOIN m USING (model))"""


@query(f"""WITH {_LEDGER_SQL}
SELECT stage, model, count(*)::BIGINT AS calls, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, round(sum(cost_usd)::DOUBLE * 1000000, 3) AS cost_micro_usd
FROM c GROUP BY GROUPING SETS ((stage), (model), ())""")
def usage_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return costs.roll_up(_ledger(spark, sf_dir)).select("stage", "model", "calls", "input_tokens", "output_tokens", F.round(F.col("cost_usd").cast("double") * 1_000_000, 3).alias("cost_micro_usd"))


@query(f"WITH {_LEDGER_SQL} SELECT DISTINCT model FROM c WHERE NOT known")
def unknown_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return costs.unknown_models(_ledger(spark, sf_dir))


@query(f"""WITH {_LEDGER_SQL}
SELECT count(*)::BIGINT AS calls, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens,
  round(coalesce(sum(cost_usd), 0)::DOUBLE * 1000000, 3) AS token_cost, round(count(*)::DOUBLE * 35000, 3) AS call_cost FROM c WHERE starts_with(stage, 'click')""")
def search_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = costs.stage_cost(_ledger(spark, sf_dir), "click", 0.035)
    return out.withColumns({c: F.round(F.col(c).cast("double") * 1_000_000, 3) for c in ("token_cost", "call_cost")})


# --- text rules, samples, stitching ---


@query("""
SELECT page_id, trim(regexp_replace(regexp_replace(lower(url), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS title_key FROM pages""")
def normalise_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", text.normalise_title(F.col("url")).alias("title_key"))


@query("""
SELECT doc_id, length(text)::BIGINT AS chars, CASE WHEN length(text) <= 2000 THEN text ELSE
  concat_ws(chr(10) || chr(10), '--- TEXT HEAD (first 1000 of ' || length(text) || ' chars) ---', left(text, 1000), '--- TEXT TAIL (last 500 of ' || length(text) || ' chars) ---', right(text, 500)) END AS sample
FROM documents""")
def text_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.length("text").cast("long").alias("chars"), sampling.sample_text(F.col("text"), 1000, 500, 2000).alias("sample"))


@query("""
WITH r AS (SELECT p_partkey, p_brand, p_type, '<p>' || p_name || '</p>' AS intro,
  '<!-- structured-start:id="1" kind="text" title="' || p_brand || '" -->' || repeat(p_name || ' ', p_size % 7) || '.<!-- structured-end:id="1" -->' AS one,
  'between<!-- structured-start:id="2" kind="text" title="' || p_brand || '" -->again<!-- structured-end:id="2" -->' AS two,
  '<!-- structured-start:id="3" kind="list" title="' || p_type || '" -->' || repeat(p_name || ' ', 60) || '<!-- structured-end:id="3" -->' AS three FROM part),
d AS (SELECT *, intro || one || two || three AS html FROM r),
h AS (SELECT *, left(html, 160) AS top, length(intro || one) <= 160 AS shown FROM d),
c AS (SELECT *, 840 - CASE WHEN shown THEN 0 ELSE length(one) END AS rest FROM h),
k AS (SELECT *, least(600, rest) // 2 - 200 AS keep FROM c)
SELECT p_partkey AS doc_id, 2::BIGINT AS regions, concat_ws(chr(10) || chr(10), '<!-- SAMPLE: DOCUMENT HEAD (first 160 chars of ' || length(html) || ') -->', top,
  CASE WHEN NOT shown THEN '<!-- SAMPLE: STRUCTURED REGION title="' || p_brand || '" kind="text" (first occurrence) -->' || chr(10) || chr(10) || one END,
  '<!-- SAMPLE: STRUCTURED REGION title="' || p_type || '" kind="list" (first occurrence) -->',
  CASE WHEN length(three) <= least(600, rest) THEN three ELSE left(three, keep) || chr(10) || '<!-- ... region truncated: ' || (length(three) - 2 * keep) || ' chars omitted ... -->' || chr(10) || right(three, keep) END,
  '<!-- SAMPLE: DOCUMENT TAIL (last 20 chars of ' || length(html) || ') -->', right(html, 20)) AS sample FROM k""")
def extractor_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of three regions: the first may end within the head, the second repeats its title and kind, the third is cut."""
    p = spread(_table(spark, sf_dir, "part"), "p_partkey")
    named = lambda n: F.repeat(F.concat("p_name", F.lit(" ")), n)
    one = render.region(F.lit("1"), "text", F.col("p_brand"), F.concat(named(F.col("p_size") % 7), F.lit(".")))
    two = render.region(F.lit("2"), "text", F.col("p_brand"), F.lit("again"))
    three = render.region(F.lit("3"), "list", F.col("p_type"), named(F.lit(60)))
    docs = p.select(F.col("p_partkey").alias("doc_id"), F.concat(F.lit("<p>"), "p_name", F.lit("</p>"), one, F.lit("between"), two, three).alias("html"))
    return sampling.extractor_sample(docs, head=160, tail=20, per_region=600, total=1500)


@query("""
WITH RECURSIVE p AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, text NULLS FIRST, role NULLS FIRST) AS page, coalesce(text, '') || chr(10) AS append, trim(role) AS role FROM conversations),
s AS (SELECT DISTINCT conv_id, 0::BIGINT AS page, '' AS t FROM p UNION ALL
  SELECT p.conv_id, p.page, CASE WHEN p.page % 3 = 0 THEN left(t, greatest(length(t) - 3000, 0)) || '[page ' || p.page || ' mended]' ELSE t END || append FROM s JOIN p ON p.conv_id = s.conv_id AND p.page = s.page + 1),
r AS (SELECT conv_id, role, max(page) AS last FROM p WHERE role <> '' GROUP BY ALL),
h AS (SELECT conv_id, string_agg(role, ',' ORDER BY last) AS headers FROM r GROUP BY conv_id),
f AS (SELECT conv_id, string_agg('foot ' || page, ',' ORDER BY page) AS footers FROM (SELECT *, max(page) OVER (PARTITION BY conv_id) AS n FROM p) WHERE page > n - 12 GROUP BY conv_id)
SELECT conv_id AS doc_id, page AS pages, t AS stitched, coalesce(headers, '') AS headers, footers
FROM s JOIN (SELECT conv_id, max(page) AS page FROM p GROUP BY conv_id) USING (conv_id, page) LEFT JOIN h USING (conv_id) JOIN f USING (conv_id)""")
def stitch_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = [F.array_join(c, ",").alias(c) for c in ("headers", "footers")]
    return stitching.stitch(_turns(spark, sf_dir)).select("doc_id", "pages", "stitched", *joined)


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as pages: every third page replaces the tail before it; roles are running headers, and each page has a footer of its own."""
    c = _table(spark, sf_dir, "conversations")
    page = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text", "role")).cast("long")
    mended = F.when(F.col("page") % 3 == 0, F.concat(F.lit("[page "), _text("page"), F.lit(" mended]")))
    return c.withColumn("page", page).select(
        F.col("conv_id").alias("doc_id"), "page", F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("append"), mended.alias("tail_replacement"),
        F.col("role").alias("new_header"), F.concat(F.lit("foot "), _text("page")).alias("new_footer"),
    )


_ROLES_SQL = ORACLES["stitch_fold"]


@query(_ROLES_SQL)
def stitch_stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as a stream whose triggers bring later pages first, and each page twice: the parts together are the batch result."""
    folder = shared_folder(spark, "stream")
    diffs = _turns(spark, sf_dir)
    size = F.count("*").over(Window.partitionBy("doc_id"))
    diffs = diffs.withColumn("ends", F.col("page") == size).withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    # Odd pages come with the first trigger and then again, even ones with the second and third.
    trigger = F.when(F.col("page") % 2 == 1, F.col("n") * 2).otherwise(F.col("n") + 1)
    dealt = diffs.withColumn("trigger", trigger).drop("n")
    schema = dealt.drop("trigger").schema
    for k in range(3):
        dealt.where(F.col("trigger") == k).drop("trigger").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        told = stitching.stitch_stream(stream)
        run = told.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    parts = spark.read.schema(told.schema).parquet(f"{folder}/out")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "")
    last = lambda c: F.max_by(c, "part")
    whole = parts.groupBy("doc_id").agg(last("pages").alias("pages"), text.alias("stitched"), *(F.array_join(last(c), ",").alias(c) for c in ("headers", "footers")))
    return whole


#: Documents cut in pages of 600 characters with a running header and footer. Of each three, one repeats 60 characters, one cuts with hyphens, one just cuts.
_PAGES_SQL = """
c AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 3 = 0 THEN 540 ELSE 600 END AS step FROM documents),
k AS (SELECT doc_id, t, step, unnest(range(1, greatest(1, (length(t) - 60 + step - 1) // step) + 1)) AS page, greatest(1, (length(t) - 60 + step - 1) // step) AS n FROM c),
p AS (SELECT doc_id, page, n, 'Report ' || doc_id || chr(10) || CASE WHEN page < n THEN substr(t, (page - 1) * step + 1, 600) ELSE substr(t, (page - 1) * step + 1) END
  || CASE WHEN doc_id % 3 = 1 AND page < n THEN '-' ELSE '' END || chr(10) || 'Page ' || page || ' of ' || n AS html FROM k)"""


def cut_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, page, html)``, see ``_PAGES_SQL``."""
    t, step = F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 3 == 0, 540).otherwise(600)
    docs = _table(spark, sf_dir, "documents").select("doc_id", t.alias("t"), step.alias("step"))
    docs = docs.withColumn("n", F.greatest(F.lit(1), F.expr("(length(t) - 60 + step - 1) div step")))
    rows = docs.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("page"))
    begin = ((F.col("page") - 1) * F.col("step") + 1).cast("int")
    piece = F.when(F.col("page") < F.col("n"), F.substring("t", begin, F.lit(600))).otherwise(F.substring("t", begin, F.length("t")))
    hyphen = F.when((F.col("doc_id") % 3 == 1) & (F.col("page") < F.col("n")), "-").otherwise("")
    page = F.concat(F.lit("Report "), _text("doc_id"), F.lit("\n"), piece, hyphen, F.lit("\nPage "), _text("page"), F.lit(" of "), _text("n"))
    return rows.select("doc_id", "page", page.alias("html"))


_UNTAGGED_SQL = "regexp_replace(regexp_replace(line, '<!--.*?-->', '', 'gs'), '<[^>]*>', ' ', 'g')"
_LINES_SQL = f"""{_PAGES_SQL},
r AS (SELECT doc_id, page, n, string_split(regexp_replace(html, '(?i)({diffs_by_rule.BLOCK_END})' || chr(10) || '?', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM p),
l AS (SELECT doc_id, page, n, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM r),
q AS (SELECT *, regexp_replace(lower({_tidy_sql(_UNTAGGED_SQL)}), '[0-9]+', '#', 'g') AS key FROM l),
e AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY i) AS top, row_number() OVER (PARTITION BY doc_id, page ORDER BY i DESC) AS bottom FROM q WHERE key <> ''),
s AS (SELECT doc_id, page, n, i, line, key, 'header' AS side FROM e WHERE top <= 2 UNION ALL SELECT doc_id, page, n, i, line, key, 'footer' FROM e WHERE bottom <= 2),
g AS (SELECT doc_id, side, key, count(DISTINCT page) AS pages, arg_min(line, (page, line)) AS line FROM s GROUP BY ALL HAVING count(DISTINCT page) >= 2 AND count(DISTINCT page) >= 0.5 * max(n))"""


@query(f"WITH {_LINES_SQL} SELECT doc_id, side, key, pages, line FROM g")
def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diffs_by_rule.running_lines(cut_documents(spark, sf_dir))


@query(rf"""WITH RECURSIVE {_LINES_SQL},
f AS (SELECT DISTINCT s.doc_id, s.page, s.i, s.line, s.side FROM s JOIN g USING (doc_id, side, key)),
b AS (SELECT q.doc_id, q.page, string_agg(q.line, chr(10) ORDER BY q.i) FILTER (NOT gone) AS kept, bool_or(gone) AS any_gone FROM (SELECT q.*, (q.doc_id, q.page, q.i) IN (SELECT (doc_id, page, i) FROM f) AS gone FROM q) q GROUP BY ALL),
h AS (SELECT doc_id, page, {_tidy_sql("regexp_replace(arg_min(line, i) FILTER (side = 'header'), '<[^>]*>', ' ', 'g')")} AS new_header,
  {_tidy_sql("regexp_replace(arg_max(line, i) FILTER (side = 'footer'), '<[^>]*>', ' ', 'g')")} AS new_footer FROM f GROUP BY ALL),
d AS (SELECT p.doc_id, p.page, coalesce(CASE WHEN any_gone THEN kept ELSE html END, '') AS body, new_header, new_footer FROM p LEFT JOIN b USING (doc_id, page) LEFT JOIN h USING (doc_id, page)),
w AS (SELECT DISTINCT doc_id, 0::BIGINT AS page, '' AS t, NULL::VARCHAR AS append, NULL::VARCHAR AS tail_replacement FROM p
  UNION ALL SELECT doc_id, page, left(t, length(t) - CASE WHEN tail_replacement IS NULL THEN 0 ELSE length(tail) END) || coalesce(tail_replacement, '') || append, append, tail_replacement FROM (
    SELECT doc_id, page, t, tail, CASE WHEN tail = '' OR body = '' OR shared > 0 THEN substr(body, shared + 1) WHEN joins THEN after_ WHEN right(tail, 1) = chr(10) OR left(body, 1) = chr(10) THEN body ELSE chr(10) || body END AS append,
      CASE WHEN tail <> '' AND body <> '' AND shared = 0 AND joins THEN CASE WHEN regexp_matches(before_, '\pL-$') THEN left(before_, length(before_) - 1) ELSE before_ || ' ' END END AS tail_replacement FROM (
      SELECT *, before_ <> '' AND NOT regexp_matches(right(before_, 1), '[.!?:;"''”’)\]}}>|]') AND regexp_matches(left(after_, 1), '\p{{Ll}}') AND ends = starts AS joins FROM (
        SELECT d.doc_id, d.page, t, body, tail, coalesce(list_max(list_filter(range(20, least(length(tail), length(body)) + 1), lambda k: right(tail, k) = left(body, k))), 0) AS shared,
          regexp_matches(tail, '(?i)</p>\s*$') AS ends, regexp_matches(body, '(?i)^\s*<p[^>]*>') AS starts,
          regexp_replace(regexp_replace(tail, '(?i)\s*</p>\s*$', ''), '[\x1c-\x1f\x{{85}}{text.SPACE}]+$', '') AS before_, regexp_replace(regexp_replace(body, '(?i)^\s*<p[^>]*>\s*', ''), '^[\x1c-\x1f\x{{85}}{text.SPACE}]+', '') AS after_
        FROM (SELECT *, right(t, 400) AS tail FROM w) w JOIN d ON d.doc_id = w.doc_id AND d.page = w.page + 1))))
SELECT w.doc_id, w.page, append, tail_replacement, new_header, new_footer FROM w JOIN d USING (doc_id, page)""")
def page_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running lines stripped, repeated text left out, cut words and sentences put together."""
    return diffs_by_rule.propose_diffs(cut_documents(spark, sf_dir), tail=400)


@query("""
SELECT o_orderkey AS ord, trim(f) AS field FROM (SELECT o_orderkey, unnest(string_split(o_orderpriority || ', ,' || o_orderstatus || ' ', ',')) AS f FROM orders) WHERE trim(f) <> ''""")
def preferred_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    listed = files.field_list(F.concat("o_orderpriority", F.lit(", ,"), "o_orderstatus", F.lit(" ")))
    return o.select(F.col("o_orderkey").alias("ord"), F.explode(listed).alias("field"))


#: One program for each thing that may not occur, with the text that is found; the last one may pass.
_PROGRAMS = [
    ("eval (x)", "eval (", "eval()"), ("new Function", "new Function", "new Function"), ("Function ('x')", "Function (", "Function()"), ("import('x')", "import(", "dynamic import()"),
    ("require('x')", "require(", "require()"), ("process.env", "process", "process"), ("globalThis", "globalThis", "globalThis"), ("fetch(x)", "fetch(", "fetch()"),
    ("XMLHttpRequest", "XMLHttpRequest", "XMLHttpRequest"), ("child_process", "child_process", "child_process"), ("__proto__", "__proto__", "__proto__"),
    (".constructor", ".constructor", ".constructor"), ("evaluate", "", None),
]
_quote = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"


@query(f"""
WITH t(k, code, hit, name) AS (VALUES {', '.join(f'({k}, {_quote(c)}, {_quote(h)}, {_quote(n)})' for k, (c, h, n) in enumerate(_PROGRAMS))}),
e AS (SELECT event_id, props, hit, name, 'let item' || event_id || '  =  ' AS opening, code, event_id % 2 = 0 AS defines FROM events JOIN t ON k = event_id % {len(_PROGRAMS)}),
c AS (SELECT *, opening || code || CASE WHEN defines THEN '; export function extract (x) {{}}' ELSE '; let extracted = 1' END AS whole, length(opening) AS place FROM e)
SELECT event_id, CASE event_id % 3 WHEN 0 THEN props ELSE 'see: ' || props END AS inner_text, defines,
  'forbidden token ' || name || ' at offset ' || place || ': ...' || regexp_replace(substr(whole, greatest(place - 20, 0) + 1, place - greatest(place - 20, 0) + length(hit) + 20), ' +', ' ', 'g') || '...' AS refused
FROM c""")
def response_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fences are stripped only from responses that are one fence as a whole; programs are checked for what they define and contain."""
    e = _table(spark, sf_dir, "events")
    fenced = F.concat(F.lit("  ```json\n"), "props", F.lit("\n```\n"))
    response = F.when(F.col("event_id") % 3 == 0, fenced).otherwise(F.concat(F.lit("see: "), "props", F.lit(" ")))
    program = F.get(F.array(*(F.lit(code) for code, _, _ in _PROGRAMS)), (F.col("event_id") % len(_PROGRAMS)).cast("int"))
    ending = F.when(F.col("event_id") % 2 == 0, "; export function extract (x) {}").otherwise("; let extracted = 1")
    code = F.concat(F.lit("let item"), _text("event_id"), F.lit("  =  "), program, ending)
    return e.select("event_id", text.strip_fences(response).alias("inner_text"), text.defines_extract(code).alias("defines"), text.forbidden_reason(code).alias("refused"))


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 20 customers: their table in two parts with different columns, their phones in numbered columns, and two small tables alike."""
    c = spread(_table(spark, sf_dir, "customer").withColumn("doc", F.floor(F.col("c_custkey") / 20)), "doc")
    doc, key, name, street = F.col("doc"), _text("c_custkey"), F.col("c_name"), F.concat(_text("c_nationkey"), F.lit(" High Road"))
    city = F.concat(F.lit("Town "), F.lower("c_mktsegment"))
    phones = [F.concat(F.lit(f"{k}-"), key) for k in (1, 2)]
    even = F.col("c_custkey") % 2 == 0
    made = [
        render.tables(c.where(even), doc, "c_custkey", [key, name, street, city], ["Customer Id", "Cust name", "Street", "City"], F.lit("Customers")),
        render.tables(c.where(~even), doc, "c_custkey", [key, name, city, street, F.col("c_mktsegment")], ["Customer-Id", "Label", "City", "Street", "Segment"], F.lit("Customers (continued)")),
        render.tables(c, doc, "c_custkey", [key, *phones], ["customer id", "Phone1", "Phone2"], F.lit("Contacts")),
        *(render.tables(c.where(F.col("c_custkey") % 20 == k), doc, "c_custkey", [F.lit(z), key], ["Zone", "Size"], F.lit(f"Zone {z}")) for k, z in ((1, "A"), (2, "B"))),
    ]
    every = groups.combine(*(m.withColumn("pos", F.lit(k)) for k, m in enumerate(made)))
    listed = F.sort_array(F.collect_list(F.struct("pos", "html")))
    return every.groupBy("doc_id").agg(F.array_join(F.transform(listed, lambda x: x["html"]), "\n").alias("html"))


def _customers(spark: SparkSession, sf_dir: str) -> pipeline.Result:
    preferred = spark.createDataFrame([(0, "label", ["cust name"])], "pos int, name string, aliases array<string>")
    return pipeline.run(customer_documents(spark, sf_dir), preferred)


@query("""
SELECT floor(c_custkey / 20)::BIGINT AS doc_id, (row_number() OVER (PARTITION BY floor(c_custkey / 20) ORDER BY c_custkey % 2, c_custkey) - 1)::BIGINT AS ord,
  c_custkey::VARCHAR AS customer, c_name AS label, c_nationkey || ' High Road, Town ' || lower(c_mktsegment) AS address, CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment
FROM customer""")
def document_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps, each with a plan that does something: fields are renamed, phones unpivoted, zones and customers merged, addresses composed, and customers chosen."""
    rec = F.col("rec")
    return _customers(spark, sf_dir).final.select(
        "doc_id", "ord", rec["customerId"].alias("customer"), rec["label"].alias("label"), rec["address"].alias("address"), rec["segment"].alias("segment")
    )


@query("""
SELECT floor(c_custkey / 20)::BIGINT AS doc_id, 3::BIGINT AS groups, (3 * count(*) + count(*) FILTER (c_custkey % 20 IN (1, 2)))::BIGINT AS records, 1::BIGINT AS merges,
  1::BIGINT AS joins, 1::BIGINT AS with_address, 'customers-merged' AS prominent FROM customer GROUP BY ALL""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.summary(_customers(spark, sf_dir))


@query("""
SELECT DISTINCT floor(c_custkey / 20)::BIGINT AS doc_id, 'contacts' AS left_group, 'customers-merged' AS right_group, 'customerId' AS left_field, 'customerId' AS right_field FROM customer""")
def proposed_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related groups, by the key that they share."""
    rows = _customers(spark, sf_dir).joins.select("doc_id", F.col("left").alias("left_group"), F.col("right").alias("right_group"), F.inline("on"))
    return rows.select("doc_id", "left_group", "right_group", F.col("left").alias("left_field"), F.col("right").alias("right_field"))


@query("""
WITH p AS (SELECT o_orderkey, unnest([0, 1, 2]) AS k, unnest([o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey::VARCHAR END, o_orderpriority]) AS v FROM orders),
d AS (SELECT *, CASE WHEN o_orderkey % 4 > 0 THEN 0 ELSE o_orderkey % 40 END AS doc_id FROM p WHERE v IS NOT NULL)
SELECT doc_id::BIGINT AS doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY o_orderkey, k) - 1)::BIGINT AS ord, v AS value FROM d""")
def hot_group_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarters of all rows in one group, unpivoted and numbered by ranges."""
    o, key = _table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rec = _records(o, F.when(key % 4 > 0, 0).otherwise(key % 40), F.lit("orders"), key, a=F.col("o_orderstatus"), b=F.when(key % 3 > 0, key), c=F.col("o_orderpriority"))
    listed = lambda *n: F.array(*map(F.lit, n))
    plan = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("orders").alias("group_name"), listed("a", "b", "c").alias("pivot_fields"), F.lit("value").alias("target_field"), listed("x").alias("keep_fields"), F.lit("values").alias("target"))
    return groups.unpivot_group(rec, plan).select("doc_id", "ord", F.col("rec")["value"].alias("value"))


# --- types of fields ---


@query("""
WITH r AS (SELECT o_custkey % 50 AS doc_id, o_orderkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority, o_custkey FROM orders),
v AS (SELECT doc_id, unnest(['key', 'total', 'day', 'status', 'code', 'mixed', 'flag', 'empty']) AS name,
  unnest([o_orderkey::VARCHAR, printf('%.2f', o_totalprice), CASE WHEN o_custkey % 50 = 7 AND o_orderkey % 97 = 0 THEN '2023-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END, o_orderstatus, '0' || o_orderkey,
    CASE WHEN o_custkey % 50 < 25 OR o_orderkey % 3 > 0 THEN o_orderkey::VARCHAR ELSE o_orderkey || '.5' END, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'FALSE' END, CASE WHEN o_orderkey % 2 = 0 THEN ' ' END]) AS v FROM r),
t AS (SELECT doc_id, name, count(nullif(trim(v), ''))::BIGINT AS total, count(*) FILTER (lower(v) IN ('true', 'false'))::BIGINT AS booleans,
  count(*) FILTER (try_cast(v AS BIGINT) IS NOT NULL AND regexp_matches(v, '^-?(0|[1-9][0-9]*)$'))::BIGINT AS integers,
  count(*) FILTER (try_cast(v AS DOUBLE) IS NOT NULL AND regexp_matches(v, '^-?(0|[1-9][0-9]*)([.][0-9]+)?$'))::BIGINT AS numbers,
  count(*) FILTER (try_cast(v AS DATE) IS NOT NULL AND length(v) = 10)::BIGINT AS dates FROM v GROUP BY ALL)
SELECT *, CASE total WHEN 0 THEN 'null' WHEN booleans THEN 'boolean' WHEN integers THEN 'integer' WHEN numbers THEN 'number' WHEN dates THEN 'date' ELSE 'string' END AS type FROM t""")
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from all values: one number among integers, one day that isn't in the calendar, codes with zeros before them."""
    o = _table(spark, sf_dir, "orders")
    key, doc = F.col("o_orderkey"), F.col("o_custkey") % 50
    day = F.when((doc == 7) & (key % 97 == 0), "2023-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    mixed = F.when((doc < 25) | (key % 3 > 0), _text("o_orderkey")).otherwise(F.concat(_text("o_orderkey"), F.lit(".5")))
    flag, empty = F.when(key % 2 == 0, "true").otherwise("FALSE"), F.when(key % 2 == 0, " ")
    cells = {"key": key, "total": _money("o_totalprice"), "day": day, "status": F.col("o_orderstatus"), "code": F.concat(F.lit("0"), _text("o_orderkey")), "mixed": mixed, "flag": flag, "empty": empty}
    rec = _records(o, doc, F.lit("orders"), key, **cells)
    return schemas.field_types(rec).select("doc_id", "name", "total", "booleans", "integers", "numbers", "dates", "type")


@query("""
WITH c AS (SELECT floor(c_custkey / 20)::BIGINT AS doc_id, c_custkey FROM customer),
d AS (SELECT doc_id, count(*) FILTER (c_custkey % 2 = 0) > 0 AS even, count(*) FILTER (c_custkey % 2 = 1) > 0 AS odd, count(*) FILTER (c_custkey % 20 = 1) > 0 AS a, count(*) FILTER (c_custkey % 20 = 2) > 0 AS b FROM c GROUP BY 1),
s(step, grp, name, type) AS (VALUES ('extracted', 'contacts', 'customerId', 'integer'), ('extracted', 'contacts', 'phone1', 'string'), ('extracted', 'contacts', 'phone2', 'string'),
  ('renamed', 'contacts', 'customerId', 'integer'), ('renamed', 'contacts', 'phone1', 'string'), ('renamed', 'contacts', 'phone2', 'string'), ('unpivoted', 'contacts', 'phone', 'string'), ('unpivoted', 'contacts', 'customerId', 'integer'),
  ('row-merged', 'contacts', 'phone', 'string'), ('row-merged', 'contacts', 'customerId', 'integer'), ('merged', 'contacts', 'phone', 'string'), ('merged', 'contacts', 'customerId', 'integer'),
  ('row-merged', 'zone-a-all', 'zone', 'string'), ('row-merged', 'zone-a-all', 'size', 'integer'), ('merged', 'zone-a-all', 'zone', 'string'), ('merged', 'zone-a-all', 'size', 'integer'),
  ('merged', 'customers-merged', 'customerId', 'integer'), ('merged', 'customers-merged', 'label', 'string'), ('merged', 'customers-merged', 'street', 'string'), ('merged', 'customers-merged', 'city', 'string'), ('merged', 'customers-merged', 'segment', 'string'))
SELECT doc_id, step, grp AS group_name, name, type FROM d, s WHERE even AND odd AND a AND b""")
def schema_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a document's groups after each step that concerns them, for documents that have all their tables."""
    all_steps = _customers(spark, sf_dir).schemas
    whole = customer_documents(spark, sf_dir).where(" and ".join(f"contains(html, 'title=\"{t}\"')" for t in ("Customers", "Customers (continued)", "Zone A", "Zone B"))).select("doc_id")
    merged = F.col("step").isin("row-merged", "merged")
    told = (F.col("group_name") == "contacts") | ((F.col("group_name") == "zone-a-all") & merged) | (F.col("group_name") == "customers-merged")
    return all_steps.join(whole, "doc_id", "left_semi").where(told).select("doc_id", "step", "group_name", "name", "type")


# --- calls: checked answers, what is asked again, ledgers ---

_SHAPES = [("ask", 0, "$", ["object"], True), ("ask", 1, "$.k", ["number"], True), ("ask", 2, "$.note", ["string", "null"], False)]


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_SHAPES, calls.RULES)


@query("""
WITH e AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN replace(props, '}', ', "note": null}') WHEN 2 THEN replace(props, '}', ', "note": ["a"]}') WHEN 3 THEN replace(props, '"k"', '"other"')
  WHEN 4 THEN replace(props, '}', '') WHEN 5 THEN '[' || props || ']' ELSE regexp_replace(props, '([0-9]+)', '"\\1"') END AS answer FROM events)
SELECT event_id, CASE WHEN answer IS NULL THEN 'no answer' WHEN NOT json_valid(answer) THEN 'not JSON' WHEN json_type(answer) <> 'OBJECT' THEN '$ is array, not object' WHEN json_type(answer, '$.k') IS NULL THEN 'no $.k'
    WHEN json_type(answer, '$.k') = 'VARCHAR' THEN '$.k is string, not number' WHEN json_type(answer, '$.note') = 'ARRAY' THEN '$.note is array, not string or null' END AS reason,
  CASE WHEN json_valid(answer) AND json_type(answer) = 'OBJECT' AND json_type(answer, '$.k') <> 'VARCHAR' AND coalesce(json_type(answer, '$.note'), '') <> 'ARRAY' THEN (answer->'$.k')::BIGINT END AS k FROM e""")
def checked_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' properties as answers, with faults: of three of seven the shape is right, the others have the reason why it isn't."""
    e, way = _table(spark, sf_dir, "events"), F.col("event_id") % 7
    put = lambda old, new: F.replace("props", F.lit(old), F.lit(new))
    forms = [F.col("props"), put("}", ', "note": null}'), put("}", ', "note": ["a"]}'), put('"k"', '"other"'), put("}", ""), F.concat(F.lit("["), "props", F.lit("]")), F.regexp_replace("props", "([0-9]+)", '"$1"')]
    rows = e.select("event_id", F.lit("ask").alias("stage"), F.coalesce(*(F.when(way == k, f) for k, f in enumerate(forms))).alias("answer"))
    out = calls.judged(rows, _rules(spark))
    return out.select("event_id", "reason", F.when(F.col("reason").isNull(), F.try_variant_get("value", "$.k", "bigint")).alias("k"))


def _answer(row: dict) -> dict:
    """A client that fails as often as the event's number says: not at all, once, twice, or as long as it is asked."""
    way, good = int(row["key"]) % 8, '{"k": 1}'
    bad = {4: ["not JSON"], 5: ["{}", "[1]"], 6: ["", "", ""], 7: ['{"k": "x"}'] * 3}.get(way, [])
    used = {"input_tokens": 100 + row["attempt"], "output_tokens": 10} if way != 3 else {}
    return {"text": bad[row["attempt"] - 1] if row["attempt"] <= len(bad) else good} | used


def _second(row: dict) -> dict:
    return {"text": '{"k": 2}' if int(row["key"]) % 8 == 6 else "[]", "input_tokens": 50, "output_tokens": 5}


def _asked(spark: SparkSession, sf_dir: str) -> calls.Outcome:
    work = _table(spark, sf_dir, "events").select(_text("event_id").alias("key"), F.lit("ask").alias("stage"), F.lit("gemini-2.5-flash-lite").alias("model"), F.concat(F.lit("What of "), "props").alias("prompt"))
    return calls.ask_until_valid(work, _rules(spark), [calls.Client(_answer), calls.Client(_second, "gemini-2.5-flash", "-fallback")], partitions=8)


@query("""
SELECT event_id::VARCHAR AS key, CASE event_id % 8 WHEN 7 THEN 'quarantined' WHEN 6 THEN 'accepted-fallback' ELSE 'accepted' END AS status,
  [1, 1, 1, 1, 2, 3, 4, 6][event_id % 8 + 1]::BIGINT AS calls, CASE WHEN event_id % 8 = 6 THEN 2 WHEN event_id % 8 < 7 THEN 1 END::BIGINT AS k, CASE WHEN event_id % 8 = 7 THEN '$ is array, not object' END AS reason FROM events""")
def asked_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event asked until its answer is good: how often, who answered, and what no one answered."""
    out = _asked(spark, sf_dir)
    good = out.accepted.select("key", F.concat(F.lit("accepted"), "client").alias("status"), F.try_variant_get("value", "$.k", "bigint").alias("k"), F.lit(None).cast("string").alias("reason"))
    bad = out.quarantine.select("key", F.lit("quarantined").alias("status"), F.lit(None).cast("long").alias("k"), "reason")
    return good.unionByName(bad).join(out.ledger.groupBy("key").agg(F.count("*").alias("calls")), "key").select("key", "status", "calls", "k", "reason")


@query("""
WITH n AS (SELECT event_id % 8 AS w, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT unnest(['ask', 'ask-jsonfix', 'ask-jsonfix', 'ask-fallback', 'ask-fallback-jsonfix', 'ask-fallback-jsonfix']) AS stage, unnest([1, 2, 3, 4, 5, 6]) AS nth, w, n FROM n),
d AS (SELECT * FROM c WHERE nth <= [1, 1, 1, 1, 2, 3, 4, 6][w + 1])
SELECT stage, CASE WHEN nth <= 3 THEN 'gemini-2.5-flash-lite' ELSE 'gemini-2.5-flash' END AS model, sum(n)::BIGINT AS calls, sum(n) FILTER (w <> 3)::BIGINT AS with_usage,
  sum(n * CASE WHEN nth > 3 THEN 50 WHEN w <> 3 THEN 100 + nth END)::BIGINT AS input_tokens,
  round(sum(n * CASE WHEN nth > 3 THEN 50 * 0.3 + 5 * 2.5 WHEN w <> 3 THEN (100 + nth) * 0.1 + 10 * 0.4 END), 3)::DOUBLE AS millionths FROM d GROUP BY ALL""")
def call_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of the calls from the ledger that they left; a call that tells no usage counts, and costs nothing."""
    ledger = costs.priced(_asked(spark, sf_dir).ledger, spark.createDataFrame(costs.PRICES, "name string, in_price double, out_price double"))
    return ledger.groupBy("stage", "model").agg(
        F.count("*").alias("calls"), F.count("input_tokens").alias("with_usage"), F.sum("input_tokens").alias("input_tokens"), F.round(F.sum("cost_usd").cast("double") * 1_000_000, 3).alias("millionths")
    )


# --- verification by calls ---


def _verifier(row: dict) -> dict:
    """A client that knows addresses by the numbers in them: some it confirms, some it can't find, one result is doubled, one is of an index nobody asked about; a batch from 40 on fails the first time."""
    import json

    # The second line only: a prompt that is asked again goes on with what was wrong.
    inputs = json.loads(row["prompt"].split("\n")[1])
    if row["attempt"] == 1 and int(inputs[0]["index"]) // 5 % 3 == 2:
        return {"text": '{"found": []}', "input_tokens": 10, "output_tokens": 1}
    found = []
    for given in inputs:
        number = int(given["address"].split()[0])
        if number % 4:
            found.append({"index": int(given["index"]), "confidence": ["", "HIGH", "low", "surely"][number % 4], "matchedName": given["name"].upper(), "matchedAddress": given["address"] if number % 4 == 1 else None})
    again = [r | {"confidence": "medium"} for r in found[:1]]
    return {"text": json.dumps({"results": [*found, *again, {"index": -1, "confidence": "high"}]}), "input_tokens": 10 * len(inputs), "output_tokens": len(found)}


@query("""
WITH s AS (SELECT s_nationkey::BIGINT AS doc_id, s_suppkey, s_name, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey || ' Main Street' END AS address FROM supplier),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s_suppkey) - 1 AS ord, CASE WHEN address IS NOT NULL THEN row_number() OVER (PARTITION BY doc_id, address IS NULL ORDER BY s_suppkey) - 1 END AS i FROM s)
SELECT doc_id, s_suppkey::BIGINT AS suppkey, CASE WHEN address IS NULL THEN 'unknown' ELSE ['unknown', 'high', 'low', 'unknown'][s_suppkey % 4 + 1] END AS confidence,
  CASE WHEN address IS NOT NULL AND s_suppkey % 4 > 0 THEN upper(s_name) END AS matched_name, CASE WHEN address IS NOT NULL AND s_suppkey % 4 = 1 THEN address END AS matched_address,
  coalesce(CASE WHEN floor(i / 5) % 3 = 2 THEN 2 WHEN i IS NOT NULL THEN 1 END, 0)::BIGINT AS calls FROM n""")
def verified_by_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with what a client says of their addresses, five a call, and how often the call of each was made; every fifth has no address."""
    s = _table(spark, sf_dir, "supplier")
    address = F.when(F.col("s_suppkey") % 5 > 0, F.concat(_text("s_suppkey"), F.lit(" Main Street")))
    rows = _records(s, F.col("s_nationkey"), F.lit("suppliers"), F.col("s_suppkey"), suppkey=F.col("s_suppkey"), name=F.col("s_name"), address=address)
    inputs = verification.record_inputs(rows)
    out = verification.verify(rows, inputs, [calls.Client(_verifier)])
    made = out.ledger.groupBy("key").agg(F.count("*").alias("calls"))
    asked = inputs.select("doc_id", "group_name", "ord", verification.batch_key().alias("key")).join(made, "key").drop("key")
    told = out.records.join(asked, ["doc_id", "group_name", "ord"], "left")
    v = F.col("verification")
    return told.select("doc_id", F.col("rec")["suppkey"].cast("long").alias("suppkey"), v["confidence"].alias("confidence"), v["matched_name"].alias("matched_name"), v["matched_address"].alias("matched_address"), F.coalesce("calls", F.lit(0)).alias("calls"))


# --- stages that are kept ---


@query("""
WITH t AS (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice) AS v FROM orders GROUP BY 1),
r(run, computed, least, extra) AS (VALUES ('first', 'totals,segments', 1, 0), ('again', '', 1, 0), ('other-option', 'segments', 3, 0), ('other-rows', 'totals,segments', 1, 1), ('as-first', '', 1, 0)),
c AS (SELECT run, computed, least, c_mktsegment AS segment, n + (CASE WHEN extra = 1 AND k % 2 = 0 THEN n ELSE 0 END) AS n, v * (CASE WHEN extra = 1 AND k % 2 = 0 THEN 2 ELSE 1 END) AS v FROM r, t JOIN customer ON c_custkey = k)
SELECT run, computed, segment, count(*)::BIGINT AS customers, sum(n)::BIGINT AS orders, round(sum(v)::DOUBLE, 2) AS total FROM c WHERE n >= least GROUP BY ALL""")
def reused_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages over all orders and customers, run five times: what each run computes, and what comes out whichever way."""
    orders, customers, root = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"), shared_folder(spark, "stages")
    # Rows that are there twice are other rows: even customers order everything once more.
    more = orders.unionByName(orders.where("o_custkey % 2 = 0"))

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("v"))

    def segments(sums: DataFrame, people: DataFrame, least: int) -> DataFrame:
        rows = sums.where(F.col("n") >= least).join(people, F.col("k") == F.col("c_custkey"))
        return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("customers"), F.sum("n").alias("orders"), F.round(F.sum("v").cast("double"), 2).alias("total"))

    first = Stages(spark, root)
    plain, doubled, people = first.source(orders), first.source(more), first.source(customers)

    def run(name: str, rows: Kept, least: int) -> DataFrame:
        stages = Stages(spark, root)
        out = stages.stage("segments", segments, stages.stage("totals", totals, rows), people, options={"least": least})
        computed = ",".join(name for name, _, again in stages.told if not again)
        return out.frame.select(F.lit(name).alias("run"), F.lit(computed).alias("computed"), "segment", "customers", "orders", "total")

    runs = [run("first", plain, 1), run("again", plain, 1), run("other-option", plain, 3), run("other-rows", doubled, 1), run("as-first", plain, 1)]
    out = runs[0]
    for other in runs[1:]:
        out = out.unionByName(other)
    return out
