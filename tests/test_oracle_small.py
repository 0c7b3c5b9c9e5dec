"""Spark vs the DuckDB oracle on the smallest data set, inside the suite."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "customer", "nation"]
NAMES = [
    "daily_city_sales",
    "daily_city_sales_all_lines",
    "per_order_refunds",
    "explode_lines_outer",
    "first_order_document",
    "unique_customers_dim",
    "safe_numeric",
    "parse_dates",
    "report_dates",
    "quality_counters",
    "scan_csv_customers",
    "scan_json_month",
    "orders_clean",
    "rejects_file",
    "month_job",
    "landed_orders",
]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    want = sorted(tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == want
