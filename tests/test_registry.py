"""Driver contract: every registered query runs and equals its oracle SQL
on the smallest driver data set (DuckDB over the same parquet files)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from linepulse.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ["events", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr))


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["line_id", "txndate", "month", "quarter", "year", "availability",
                          "performance", "quality", "oee"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
