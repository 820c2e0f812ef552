"""The driver contract and the DuckDB oracle, on the smallest driver tables."""

import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from dwspark.session import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["nk_order_id", "sk_customer_id", "sk_product_id"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols, recs = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert _rows(cols, recs) == _rows(ocols, cur.fetchall())
