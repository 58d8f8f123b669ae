"""Every registered document query against its SQL over the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tabularium import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, sf, db, name):
    out = queries.QUERIES[name](spark, sf)
    rows = out.collect()
    assert rows
    if name not in queries.ORACLES:
        return
    cursor = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(out.columns)
    want = Counter(tuple(map(plain, r)) for r in cursor.fetchall())
    got = Counter(tuple(plain(r[c]) for c in columns) for r in rows)
    assert got == want, (list((got - want))[:3], list((want - got))[:3])


def test_a_small_part_of_queries_lacks_sql():
    assert len(queries.QUERIES) - len(queries.ORACLES) <= 2
