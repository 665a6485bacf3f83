"""Every query with SQL against an independent engine on the smallest data."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
#: The library without its optional subpackage; that has its own test.
SQL = {n: q for n, q in entry.oracle_sql().items() if n != "p1_found"}


def _value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(map(_value, v))
    return round(float(v), 6) if isinstance(v, float) or hasattr(v, "quantize") else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    got = Counter(tuple(_value(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = Counter(tuple(_value(dict(zip(cols, r))[c]) for c in sorted(cols)) for r in cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
