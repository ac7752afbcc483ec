"""Queries against their SQL, and streams against it, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(entry.library.SQL)


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, D)
    columns = sorted(df.columns)
    mine = [tuple(map(cell, r)) for r in df.select(*columns).toLocalIterator()]
    found = duck.execute(entry.oracle_sql()[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == columns
    theirs = [tuple(cell(r[order.index(c)]) for c in columns) for r in found.fetchall()]
    assert sorted(map(str, mine)) == sorted(map(str, theirs))


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows[0].peak_velocity >= rows[-1].peak_velocity
