"""Every query with an SQL counterpart gives the same rows on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("LORESPARK_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

import __spark_entry__ as entry  # noqa: E402


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, datetime.date)):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    assert entry.entry(spark).columns


def test_every_query_is_known():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted([norm(r[c]) for c in cols] for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    want = sorted([norm(r[names.index(c)]) for c in cols] for r in cur.fetchall())
    assert got == want
