"""The registered queries: names, and those with SQL against it on whole tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from feedlake.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels pages conversations".split()


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("\x1f".join(str(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)
