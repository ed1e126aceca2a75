"""Every query of the core against its SQL twin on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("WARRAQ_TEST_DATA", "/root/testdata/sf0.001")
CORE = entry.core_queries.QUERIES


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, db, name):
    df = CORE[name](spark, DATA)
    rows = df.collect()
    sql = entry.core_queries.ORACLE.get(name)
    if sql:
        want = db.sql(sql)
        columns = sorted(df.columns)
        assert sorted(want.columns) == columns
        got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in rows)
        at = [want.columns.index(c) for c in columns]
        assert sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall()) == got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
