"""Table replacement that survives failures, salts of rows without a key,
counters from one aggregate a frame."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import sales as S
from ledgerloom.operators.skew import hot_keys, salted_join
from ledgerloom.plans import metrics as M
from ledgerloom.sinks import files as K


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_failed_write_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/tables/t"
    assert K.write_table(spark.range(5).toDF("a"), path)
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("a"))
    with pytest.raises(PySparkException):
        K.write_table(broken, path)
    assert rows(spark.read.parquet(path)) == [(k,) for k in range(5)]
    assert os.listdir(f"{tmp_dir}/tables") == ["t"]


def test_empty_frame_and_own_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert K.write_table(spark.range(3).toDF("a"), path)
    assert not K.write_table(spark.range(0).toDF("a"), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,)]
    # a table may be replaced from itself
    assert K.write_table(spark.read.parquet(path).where("a > 0"), path + "/")
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert K.write_table(spark.range(0).toDF("a"), path, replace_empty=True)
    assert rows(spark.read.parquet(path)) == []


def test_rows_without_key_are_spread(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.lit("k")).alias("k"), F.col("id"))
    dim = spark.createDataFrame([("k", 1), (None, 2)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(facts, dim, "k", hot_keys(facts, "k", 10_000), salt_by=["id"], how="left")
        sizes = [r[1] for r in joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3600 and len(sizes) == 4 and max(sizes) < 1400
        assert joined.where("k is null and v is not null").count() == 0
        assert joined.where("v = 1").count() == 400
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refunds_of_orders_without_id(spark):
    orders = spark.createDataFrame([(None, "c1", "web", "x"), (None, "c2", "web", "x"), ("o", "c1", "web", "x")], "order_id string, customer_id string, channel string, created_at string")
    sums = S.refunds_per_order(spark.createDataFrame([("o", "2.5"), (None, "9")], "order_id string, amount string"))
    for hot in (None, hot_keys(orders, "order_id", 1)):
        got = S.attach_refunds(orders, sums, hot).select("order_id", "customer_id", F.col("refunds_eur").cast("double"))
        assert sorted(map(str, rows(got.fillna("-")))) == [str(("-", "c1", 0.0)), str(("-", "c2", 0.0)), str(("o", "c1", 2.5))]


def test_counters_take_one_aggregate_a_frame(spark):
    lines = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "item_unit_price double")
    frame = M.counters_frame(spark.range(4), spark.range(3), lines, lines.limit(1))
    assert dict(rows(frame)) == {
        "orders_loaded": 4, "orders_paid": 3, "lines_paid": 3, "lines_rejected": 1, "lines_null_price": 1, "lines_kept": 1,
    }
