"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import queries as Q
from tidemark.sources.testdata import TABLES

SF = os.environ.get("TIDEMARK_ORACLE_SF", "/root/testdata/sf0.001")


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(Q.QUERIES) == set(Q.ORACLE)
    assert set(Q.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"user_id", "_cdc_seq", "_deleted"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _canon(cols, cur.fetchall())
    assert len(got) > 0
