"""The correctness gate: every registered query against its DuckDB oracle at
sf0.01 (row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from medley.plans.given import TABLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["returnflag", "linestatus", "sum_qty", "sum_price", "count_order",
                          "median_price"]


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_every_query_has_rows(spark):
    for key in set(entry.queries()) - set(entry.oracle_sql()):
        assert entry.queries()[key](spark, SF).count() > 0
