"""End-to-end golden test on the hand-made mini-month (FIXTURES.md §5)."""

import datetime as dt
import glob
import os

import pytest

from ledgerloom.plans.month_job import run_month
from tests.fixtures import write_mini_month

D1 = dt.date(2025, 3, 1)


def _report(spark, out):
    rows = spark.read.parquet(f"{out}/tables/daily_city_sales").orderBy("date", "city", "channel").collect()
    return [tuple(r) for r in rows]


def test_line_grain_golden(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    counters = run_month(spark, root, out, 2025, 3)
    assert _report(spark, out) == [
        (D1, "Dijon", "phone", 1, 1, 5.0, 36.0, 0.0, 36.0),
        (D1, "Nantes", "store", 1, 1, 4.0, 26.0, 4.75, 21.25),
    ]
    assert counters["orders_paid"] == 4
    assert counters["lines_rejected"] == 1
    assert counters["orders_corrupt"] == 1
    rejects = spark.read.option("header", True).csv(f"{out}/rejects_items.csv").collect()
    assert [(r.order_id, float(r.item_unit_price)) for r in rejects] == [("P-302", -2.4)]
    clean = spark.read.parquet(f"{out}/tables/orders_clean")
    assert sorted(r.order_id for r in clean.collect()) == ["P-301", "P-302"]
    # one CSV per day, ';' separated, two decimals
    day_files = glob.glob(f"{out}/daily_summary/day=20250301/*.csv")
    assert len(day_files) == 1
    text = open(day_files[0]).read().splitlines()
    assert text[0] == "date;city;channel;orders_count;unique_customers;items_sold;gross_revenue_eur;refunds_eur;net_revenue_eur"
    assert text[1:] == ["2025-03-01;Dijon;phone;1;1;5.00;36.00;0.00;36.00", "2025-03-01;Nantes;store;1;1;4.00;26.00;4.75;21.25"]
    assert os.path.isdir(f"{out}/daily_summary_all.csv")


def test_order_grain_golden(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    run_month(spark, root, out, 2025, 3, grain="order")
    assert _report(spark, out) == [
        (D1, "Dijon", "phone", 1, 1, 5.0, 36.0, 0.0, 36.0),
        (D1, "Nantes", "store", 1, 1, 6.0, 29.5, 4.75, 24.75),
    ]


def test_empty_month_keeps_previous_outputs(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    run_month(spark, root, out, 2025, 3)
    before = _report(spark, out)
    run_month(spark, root, out, 2025, 5)  # no files for May
    assert _report(spark, out) == before  # D24: empty result leaves tables as they were
    assert glob.glob(f"{out}/daily_summary/day=20250301/*.csv")


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_same_result_any_partitioning(spark, tmp_dir, partitions):
    root = write_mini_month(f"{tmp_dir}/in")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = f"{tmp_dir}/out"
        run_month(spark, root, out, 2025, 3)
        assert _report(spark, out)[1] == (D1, "Nantes", "store", 1, 1, 4.0, 26.0, 4.75, 21.25)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_d25_rerun_other_month_keeps_day_files(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    run_month(spark, root, out, 2025, 3)
    run_month(spark, root, out, 2025, 4)  # April holds one paid order (P-401)
    assert glob.glob(f"{out}/daily_summary/day=20250301/*.csv")  # March day kept
    assert glob.glob(f"{out}/daily_summary/day=20250401/*.csv")  # April day added
    # tables and the all-days file hold the last run only
    assert [r.date for r in spark.read.parquet(f"{out}/tables/daily_city_sales").collect()] == [dt.date(2025, 4, 1)]


def test_command_line(spark, tmp_dir):
    from ledgerloom.__main__ import main

    root = write_mini_month(f"{tmp_dir}/in")
    settings = f"{tmp_dir}/settings.yaml"
    with open(settings, "w") as f:
        f.write(f"input_dir: {root}\noutput_dir: {tmp_dir}/out\ndb_path: {tmp_dir}/db\n")
    counters = main(["--settings", settings, "--year", "2025", "--month", "3", "--csv-sep", ","])
    assert counters["orders_paid"] == 4
    assert [tuple(r)[1:3] for r in spark.read.parquet(f"{tmp_dir}/db/daily_city_sales").orderBy("city").collect()] == [
        ("Dijon", "phone"),
        ("Nantes", "store"),
    ]
    day = glob.glob(f"{tmp_dir}/out/daily_summary/day=20250301/*.csv")
    assert open(day[0]).read().splitlines()[1].startswith("2025-03-01,Dijon,phone,1,1,5.00,")


def test_export_null_date_only_in_all_file(spark, tmp_dir):
    from ledgerloom.sinks.files import export_daily_csvs

    schema = (
        "date date, city string, channel string, orders_count bigint, unique_customers bigint, "
        "items_sold double, gross_revenue_eur double, refunds_eur double, net_revenue_eur double"
    )
    rows = [(D1, "Paris", "web", 1, 1, 2.0, 10.125, 0.0, 10.125), (None, "Paris", "web", 1, 1, 1.0, 3.0, None, 3.0)]
    export_daily_csvs(spark.createDataFrame(rows, schema), f"{tmp_dir}/o", sep=";", float_format="%.2f")
    days = glob.glob(f"{tmp_dir}/o/daily_summary/day=*")
    assert [os.path.basename(d) for d in days] == ["day=20250301"]
    lines = sorted(l for f in glob.glob(f"{tmp_dir}/o/daily_summary_all.csv/*.csv") for l in open(f).read().splitlines())
    assert ";Paris;web;1;1;1.00;3.00;;3.00" in lines  # null date, null refunds stay empty
    assert "2025-03-01;Paris;web;1;1;2.00;10.13;0.00;10.13" in lines  # half-up to 2 decimals
