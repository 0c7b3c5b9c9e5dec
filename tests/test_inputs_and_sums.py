"""CSV headers per part file, date shapes, large sums, column guard."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import api
from ledgerloom.functions import scalar
from ledgerloom.operators import sales as S
from ledgerloom.plans.month_job import run_month
from ledgerloom.schemas import CUSTOMERS_RAW
from ledgerloom.sources.files import read_csv


def test_headers_of_part_files(spark, tmp_path):
    folder = tmp_path / "customers of march.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text('customer_id,city,is_active\nc1,"Old\nTown",1\nc2,"say ""hi""",0\n')
    (folder / "part-1.csv").write_text("﻿IS_ACTIVE,more,Customer_Id , City\nyes,x,c3,Oslo\n")
    (folder / "part-2.csv").write_text("City\nBergen\n")
    (folder / "part-3.csv").write_text("")
    rows = {(r["customer_id"], r["city"], r["is_active"]) for r in read_csv(spark, str(folder), CUSTOMERS_RAW).collect()}
    assert rows == {("c1", "Old\nTown", "1"), ("c2", 'say "hi"', "0"), ("c3", "Oslo", "yes"), (None, "Bergen", None)}
    (tmp_path / "one.csv").write_text("Customer_Id,City,Is_Active\nc1,Oslo,1\n")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "one.csv"), CUSTOMERS_RAW).collect()] == [("c1", "Oslo", "1")]
    assert read_csv(spark, str(tmp_path / "none.csv"), CUSTOMERS_RAW).count() == 0


@pytest.mark.parametrize(
    "text, day",
    [
        ("1 March 2025", 1), ("Mar 1, 2025 10:00 PM", 1), ("Sat, 01 Mar 2025 10:00:00 GMT", 1), ("20250301103000", 1), ("\t2025-03-01\n", 1),
        ("03.01.2025", 1), ("13.03.2025", 13), ("13/03/2025", 13), ("03/13/2025 7:05", 13), ("March 1 2025", 1), ("1-Mar-2025", 1), ("20250301", 1),
        ("2025-03-01T10:00:00Z", 1), ("Saturday, 1 March 2025", 1), ("3/1/2025 10:00 AM", 1), ("32.13.2025", None), ("1 Marvember 2025", None),
        ("week of 20250301", None), ("", None), (None, None),
    ],
)
def test_date_shapes(spark, text, day):
    got = spark.createDataFrame([(text,)], "t string").select(scalar.parse_date("t")).first()[0]
    assert got == (day and dt.date(2025, 3, day))


def test_large_sums_do_not_end_the_job(spark, tmp_path):
    docs = ",".join(
        '{"order_id":"%s","customer_id":"c1","channel":"web","created_at":"2025-03-01 10:00:00","payment_status":"paid",'
        '"items":[{"qty":1,"unit_price":"%s"}]}' % (k, "9e27") for k in ("a", "b")
    )
    (tmp_path / "orders_2025-03-01.json").write_text(f"[{docs}]")
    (tmp_path / "customers.csv").write_text("customer_id,city,is_active\nc1,Oslo,1\n")
    (tmp_path / "refunds.csv").write_text("order_id,amount,created_at\na,0.1,2025-03-02\n")
    run_month(spark, str(tmp_path), str(tmp_path / "out"), 2025, 3)
    row = spark.read.parquet(str(tmp_path / "out" / "tables" / "daily_city_sales")).first()
    assert row["gross_revenue_eur"] == pytest.approx(1.8e28) and row["net_revenue_eur"] == pytest.approx(1.8e28)
    assert row["refunds_eur"] == 0.1 and row["orders_count"] == 2


def test_sums_are_exact_where_they_fit(spark):
    rows = spark.createDataFrame([("o", "0.1")] * 3 + [("o", "9" * 28), ("o", "9" * 28), ("q", "9" * 28), ("q", "0.3"), ("p", None)], "k string, v string")
    got = {r["k"]: r for r in rows.groupBy("k").agg(scalar.exact_sum(scalar.safe_number("v")).alias("s"), scalar.wide_sum(scalar.safe_number("v")).alias("w")).collect()}
    assert got["p"]["s"] is None and got["p"]["w"] is None
    assert got["o"]["w"] == pytest.approx(2e28) and got["o"]["s"] is None
    assert str(got["q"]["s"]) == "9" * 28 + ".3000000000"
    refunds = spark.createDataFrame([("a", "0.1"), ("a", "0.2"), ("b", "x")], "order_id string, amount string")
    assert {r["order_id"]: float(r["refunds_eur"]) for r in S.refunds_per_order(refunds).collect()} == {"a": 0.3, "b": 0.0}


def test_rejects_of_a_frame_without_prices(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1)], "order_id string, n int").withColumn("m", F.lit(2))
    assert api.detect_and_save_rejects(frame, str(tmp_path)).collect() == frame.collect()
