"""Driver contract: entry() runs; every query with an oracle matches it on the sf0.001 tables."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from feedlake.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("\x1f".join(canon(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["section", "pos", "title", "summary", "date", "read_time", "url", "source"]


def test_every_query_has_oracle_or_is_documented():
    missing = set(E.QUERIES) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E.QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)
