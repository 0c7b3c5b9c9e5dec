from pyspark.sql import functions as F

from ledgerloom.schemas import CUSTOMERS_RAW
from ledgerloom.sources import files as SRC
from tests.fixtures import write_mini_month


def test_missing_csv_is_typed_empty(spark, tmp_dir):
    df = SRC.read_customers_raw(spark, f"{tmp_dir}/nope/customers.csv")
    assert df.schema == CUSTOMERS_RAW and df.count() == 0


def test_missing_order_dir_is_typed_empty(spark, tmp_dir):
    df = SRC.read_orders_month(spark, f"{tmp_dir}/nothing", 2025, 3)
    assert df.count() == 0 and "items" in df.columns


def test_csv_declared_schema(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    df = SRC.read_customers_raw(spark, f"{root}/customers.csv")
    assert df.schema == CUSTOMERS_RAW
    assert sorted(r.customer_id for r in df.collect()) == ["k11", "k12", "k13"]


def test_month_files_one_scan(spark, tmp_dir):
    root = write_mini_month(f"{tmp_dir}/in")
    raw = SRC.read_orders_month(spark, root, 2025, 3)
    clean, quarantine = SRC.split_corrupt(raw)
    ids = sorted(r.order_id for r in clean.collect())
    assert ids == ["P-301", "P-301", "P-302", "P-303", "P-304"]  # April and day 32 ignored, zero-byte gives nothing
    bad = quarantine.collect()
    assert len(bad) == 1 and bad[0].source_file == "orders_2025-03-03.json"
    # evolving item field names both arrive, under one declared schema
    items = clean.select(F.explode("items").alias("i")).select("i.*")
    assert {"qty", "quantity", "unit_price", "price"} <= set(items.columns)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([("o1", 1.0)], "order_id string, qty double")
    b = spark.createDataFrame([("o2", 2.0)], "order_id string, quantity double")
    out = SRC.union_by_name(a, b).orderBy("order_id").collect()
    assert [(r.qty, r.quantity) for r in out] == [(1.0, None), (None, 2.0)]


def test_streaming_landing_exactly_once(spark, tmp_dir):
    import json
    import os

    from ledgerloom.streaming.landing import land_orders, landed_clean, landed_quarantine
    from tests.fixtures import DAY1, DAY2

    src = f"{tmp_dir}/src"
    os.makedirs(f"{src}/order_month=2025-03")
    for day, docs in (("01", DAY1), ("02", DAY2)):
        with open(f"{src}/order_month=2025-03/orders_2025-03-{day}.json", "w") as f:
            f.write("\n".join(json.dumps(d) for d in docs) + "\n")
    with open(f"{src}/order_month=2025-03/orders_2025-03-03.json", "w") as f:
        f.write("{not json\n")
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    assert land_orders(spark, src, out, ckpt) == 6  # every row parsed once
    landed = spark.read.parquet(out)
    assert landed_clean(landed).count() == 5 and landed_quarantine(landed).count() == 1
    assert {r.order_month for r in landed.select("order_month").distinct().collect()} == {"2025-03"}
    assert land_orders(spark, src, out, ckpt) == 0  # nothing new: nothing re-landed
    assert spark.read.parquet(out).count() == 6
