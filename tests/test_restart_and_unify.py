"""Restart of the monthly job, unions of clashing types, the order of the
all-days output, the bound of the hot-key set."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import skew
from ledgerloom.plans import month_job as J
from ledgerloom.session import work_path
from ledgerloom.sinks import files as K
from ledgerloom.sources.files import union_by_name


def month(folder):
    docs = [
        {"order_id": f"o{k}", "customer_id": "c", "channel": "web", "created_at": "2025-03-01 10:00:00", "payment_status": "paid",
         "items": [{"qty": 1, "unit_price": 2.0}, {"qty": 1, "unit_price": 3.0}, {"qty": 1, "unit_price": -1.0}]}
        for k in range(3)
    ]
    (folder / "orders_2025-03-01.json").write_text(json.dumps(docs))
    (folder / "customers.csv").write_text("customer_id,city,is_active\nc,Ulm,true\n")
    (folder / "refunds.csv").write_text("order_id,amount,created_at\no1,1.5,2025-03-02\n")


def test_killed_job_goes_on_at_the_unfinished_step(spark, tmp_path, monkeypatch):
    month(tmp_path)
    calls = []
    read, rejects = J.SRC.read_orders_month, K.write_rejects

    def counted(*args, **kw):
        calls.append(1)
        return read(*args, **kw)

    def killed(*args, **kw):
        raise RuntimeError("killed")

    monkeypatch.setattr(J.SRC, "read_orders_month", counted)
    monkeypatch.setattr(J.K, "write_rejects", killed)
    before = set(os.listdir(work_path(spark, "runs"))) if os.path.isdir(work_path(spark, "runs")) else set()
    with pytest.raises(RuntimeError):
        J.run_month(spark, str(tmp_path), str(tmp_path / "out"), 2025, 3)
    left = set(os.listdir(work_path(spark, "runs"))) - before
    assert len(left) == 1 and len(calls) == 1
    monkeypatch.setattr(J.K, "write_rejects", rejects)
    counters = J.run_month(spark, str(tmp_path), str(tmp_path / "out"), 2025, 3)
    assert len(calls) == 1  # the documents were not parsed again
    assert not set(os.listdir(work_path(spark, "runs"))) & left
    assert counters == {
        "orders_corrupt": 0, "orders_loaded": 3, "orders_paid": 3, "lines_paid": 9, "lines_rejected": 3,
        "lines_null_price": 0, "lines_good": 6, "lines_kept": 3, "orders_enriched": 3,
    }
    # changed input is another run
    (tmp_path / "refunds.csv").write_text("order_id,amount,created_at\n")
    J.run_month(spark, str(tmp_path), str(tmp_path / "out"), 2025, 3)
    assert len(calls) == 2
    report = spark.read.parquet(str(tmp_path / "out/tables/daily_city_sales")).first()
    assert report["orders_count"] == 3 and report["refunds_eur"] == 0


def test_union_of_clashing_types(spark):
    old = spark.sql("select 1L as id, array(named_struct('Qty', '1', 'n', 1)) as items, date'2025-03-01' as d, 1 as x, null as v, map('a', 1) as m")
    new = spark.sql(
        "select 'z' as ID, array(named_struct('qty', 2.50, 'n', 3000000000L, 'note', 'q'), null) as items, "
        "timestamp'2025-03-02 10:00:00' as d, named_struct('k', 7) as x, 4.5D as v, map('b', 2.5D) as m"
    )
    got = union_by_name(old, new)
    assert got.schema["items"].dataType.elementType.simpleString() == "struct<Qty:string,n:bigint,note:string>"
    rows = {r["id"]: r for r in got.collect()}
    assert [tuple(i) for i in rows["1"]["items"]] == [("1", 1, None)]
    assert [i and tuple(i) for i in rows["z"]["items"]] == [("2.50", 3000000000, "q"), None]
    assert rows["1"]["x"] == "1" and rows["z"]["x"] == '{"k":7}' and rows["z"]["v"] == 4.5 and rows["1"]["m"] == {"a": 1.0}
    assert got.schema["d"].dataType.simpleString() == "timestamp"
    # decimals keep every digit, or become doubles
    wide = union_by_name(spark.sql("select 1L as a, 1bd as b"), spark.sql("select 0.25 as a, cast(1e30 as decimal(38,0)) as b"))
    assert wide.schema["a"].dataType.simpleString() == "decimal(21,2)"
    assert union_by_name(spark.sql("select cast(1 as decimal(38,0)) as b"), spark.sql("select 0.5 as b")).schema["b"].dataType.simpleString() == "double"
    # equal types: the plan is the plain union
    assert union_by_name(spark.range(1), spark.range(2)).columns == ["id"]


def test_all_days_parts_in_order(spark, tmp_path):
    rows = [(None if k % 11 == 0 else f"2025-03-{1 + k % 28:02d}", f"city{k * 7 % 13}", "web", float(k)) for k in range(300)]
    report = spark.createDataFrame(rows, "date string, city string, channel string, net double").withColumn("date", F.to_date("date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert K.export_daily_csvs(report.repartition(5), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = tmp_path / "daily_summary_all.csv"
    lines = []
    parts = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    assert len(parts) > 1
    for name in parts:
        own = (folder / name).read_text().splitlines()
        assert own[0] == "date;city;channel;net"
        lines += own[1:]
    keys = [tuple(line.split(";")[:3]) for line in lines]
    assert len(keys) == 300 and keys == sorted(keys, key=lambda k: ("" if k[0] in ("", '""') else k[0], *k[1:]))
    assert not [n for n in os.listdir(tmp_path) if n.startswith(".report")]
    assert not K.export_daily_csvs(report.limit(0), str(tmp_path)) and len(os.listdir(folder)) > 1


def test_hot_set_is_bounded(spark, monkeypatch):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k")).union(spark.range(50).select(F.lit(3).cast("long").alias("k")))
    monkeypatch.setattr(skew, "MOST_HOT", 2)
    assert sorted(map(tuple, skew.hot_keys(facts, "k", 100, 50).collect())) == [(0, 2), (3, 3)]
