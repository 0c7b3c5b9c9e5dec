"""Staged inputs and nested documents on tables larger than the session's
partitions: built once, in partitions that follow the size of the files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import staging
from ledgerloom.sources import tables as T
from ledgerloom.sources.files import read_orders_month, split_corrupt


@pytest.fixture()
def small_tables(spark, tmp_dir):
    """Orders of two months: 7 twice, two without a key, 9 without lines;
    lines out of order, some without a key or an order."""
    day = lambda k: dt.datetime(1997, 3 + k % 2, 1 + k % 28)
    keys = [*range(40), 7, None, None]
    orders = [(k, (k or 0) % 5, "F", day(k or 0), "1-URGENT") for k in keys]
    lines = [(k, 1, 1, n, float(n), 10.0 * n, 0.0, 0.0, "N", "O", day(k)) for n in (3, 1, 2) for k in range(42) if k != 9]
    lines += [(None, 1, 1, n, 1.0, 1.0, 0.0, 0.0, "N", "O", day(0)) for n in (1, 2)]
    spark.createDataFrame(orders, T.TABLE_SCHEMAS["orders"]).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(lines, T.TABLE_SCHEMAS["lineitem"]).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(k, 0, "BUILDING") for k in range(5)], T.TABLE_SCHEMAS["customer"]).write.parquet(f"{tmp_dir}/customer.parquet")
    spark.createDataFrame([(0, "FRANCE")], T.TABLE_SCHEMAS["nation"]).write.parquet(f"{tmp_dir}/nation.parquet")
    return tmp_dir


def rows(df):
    return sorted(df.select(F.to_json(F.struct("*")).alias("row")).collect())


def test_documents_in_partitions_by_size(spark, small_tables, monkeypatch):
    plain = T.order_documents(spark, small_tables)
    assert T._line_partitions(spark, small_tables) is None
    monkeypatch.setattr(T, "LINE_BYTES", T.path_bytes(spark, f"{small_tables}/lineitem.parquet") // 20)
    sized = T.order_documents(spark, small_tables)
    assert sized.rdd.getNumPartitions() >= 20 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(sized) == rows(plain)
    found = [(r.order_id, r["items"] and [i.line_no for i in r["items"]]) for r in sized.collect()]
    assert len(found) == 43
    assert found.count(("7", [1, 2, 3])) == 2 and found.count((None, None)) == 2 and found.count(("9", None)) == 1
    monkeypatch.setattr(T, "MOST_PARTITIONS", 11)
    assert T._line_partitions(spark, small_tables) == 11


def test_staging_builds_each_document_once(spark, small_tables, monkeypatch):
    built = spark.sparkContext.accumulator(0)

    def seen(channel):
        built.add(1)
        return channel

    count = F.udf(seen, "string").asNondeterministic()
    documents = T.order_documents
    monkeypatch.setattr(T, "order_documents", lambda *a: documents(*a).withColumn("channel", count("channel")))
    base = staging.stage_inputs(spark, small_tables)
    assert built.value == 43
    for month, n in ((3, 22), (4, 21)):
        clean, bad = split_corrupt(read_orders_month(spark, f"{base}/orders", 1997, month, layout="month_partitions"))
        assert (clean.count(), bad.count()) == (n, int(month == 3))


def test_documents_where_the_session_has_many_partitions(spark, small_tables, monkeypatch):
    """AQE joins the session's partitions to its advisory size, so their
    number does not bound what a task sorts."""
    plain = rows(T.order_documents(spark, small_tables))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert T._line_partitions(spark, small_tables) is None
        monkeypatch.setattr(T, "PART_ROWS", 6)
        wanted = -(-(43 + 125) // 6)
        assert T._line_partitions(spark, small_tables) == wanted
        sized = T.order_documents(spark, small_tables)
        assert sized.rdd.getNumPartitions() == wanted
        assert rows(sized) == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_months_are_dealt_in_pieces(spark, small_tables, monkeypatch):
    late = [(k, 1, "O", day, "2-HIGH") for k, day in ((100, None), (101, None), (102, dt.datetime(1998, 1, 1)))]
    spark.createDataFrame(late, T.TABLE_SCHEMAS["orders"]).write.mode("append").parquet(f"{small_tables}/orders.parquet")
    monkeypatch.setattr(staging, "PIECE_DOCS", 5)
    docs = T.order_documents(spark, small_tables).withColumn(staging.MONTH_PARTITION, staging._month())
    dealt = staging._dealt_by_month(spark, docs, small_tables)
    assert rows(dealt) == rows(docs)
    pieces = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.collect_set(staging.MONTH_PARTITION).alias("months"))
    found = pieces.collect()
    assert dealt.rdd.getNumPartitions() == 10 and max(r.n for r in found) < 20
    assert max(len(r.months) for r in found) <= 2
    base = staging.stage_inputs(spark, small_tables)
    written = spark.read.json(f"{base}/orders").where("order_id <> 'broken' or order_id is null").where("_corrupt_record is null")
    assert written.count() == 46 and written.where("created_at is null").count() == 2
    names = [p.rsplit("/", 2)[1:] for p in spark.read.text(f"{base}/orders/order_month=1997-04").inputFiles()]
    assert len(names) > 1
