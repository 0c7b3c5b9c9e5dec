"""Adapters: the driver's TPC-H-like Parquet tables seen as the order model.

The order model has nested order documents (order fields + ``items``),
a customer file and a refund file. The stand-ins are:

* order fields      <- ``orders``
* item lines        <- ``lineitem`` (one line per row)
* customers         <- ``customer`` x ``nation``
* refunds           <- returned ``lineitem`` rows

Everything is a lazy projection over a Parquet scan, so filters and column
pruning reach the scan. Order ids are turned into strings once, in the
adapter, and every later join/window/aggregate keys on that same string
column, so one hash partitioning serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import NUM
from ledgerloom.session import path_bytes
from ledgerloom.sinks.files import file_writers

# Declared schemas of the stand-in tables (only the columns used): the
# read needs no footer-inference job, and a type change in the files is
# an error at read time instead of a silent re-typing.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}

# Fixed values of the mapping (driver table value -> order-model value).
STATUS_MAP = {"F": "paid", "O": "pending", "P": "cancelled"}
# c_mktsegment -> raw is_active text, chosen to exercise the normaliser:
# padded upper-case true, a word, zero, an unknown word, one.
SEGMENT_ACTIVE_TEXT = {
    "AUTOMOBILE": " TRUE",
    "BUILDING": "yes",
    "FURNITURE": "0",
    "HOUSEHOLD": "maybe",
    "MACHINERY": "1",
}
CREATED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Nested documents are built in shuffle partitions of about so many rows of
# orders and lineitem (some 80 MB while they are sorted and collected), or of
# so many bytes of lineitem files where these ask for more partitions; their
# number has a bound.
PART_ROWS = 300_000
LINE_BYTES = 8 << 20
MOST_PARTITIONS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def order_heads(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Order-level fields of the documents: one row per ``orders`` row.

    ``status``: keep only heads with this payment status, filtered on the
    source code *before* the mapping, so the predicate reaches the Parquet
    scan (a CASE mapping compared with a constant cannot be folded back
    into a pushable predicate by the optimizer)."""
    o = table(spark, sf_dir, "orders")
    if status is not None:
        codes = [k for k, v in STATUS_MAP.items() if v == status]
        o = o.where(F.col("o_orderstatus").isin(codes))
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("channel"),
        F.date_format("o_orderdate", CREATED_AT_FORMAT).alias("created_at"),
        _case(F.col("o_orderstatus"), STATUS_MAP).alias("payment_status"),
    )


def signed_price(l: DataFrame) -> Column:
    """Unit price of a line; some returned lines carry a negative price so
    that the reject split has work (driver prices are never negative)."""
    neg = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.05)
    return F.when(neg, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))


def item_rows(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Flat item lines with the evolving field names of the documents:
    even line numbers use ``qty``/``unit_price``, odd ones
    ``quantity``/``price`` (the other pair is null). With ``partitions``
    the lines that have an order id are dealt to so many by it, as narrow
    rows (a map task holds its rows while it deals them)."""
    l = table(spark, sf_dir, "lineitem")
    l = l.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("item_pos"),
        F.col("l_quantity").alias("quantity"),
        signed_price(l).alias("price"),
    )
    if partitions:
        l = l.where(F.col("order_id").isNotNull()).repartition(partitions, "order_id")
    odd = (F.col("item_pos") % 2) == 1
    return l.select(
        "order_id",
        "item_pos",
        F.when(~odd, F.col("quantity")).alias("item_qty"),
        F.when(odd, F.col("quantity")).alias("item_quantity"),
        F.when(~odd, F.col("price")).alias("item_unit_price"),
        F.when(odd, F.col("price")).alias("item_price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploded line form (what ``explode`` of the documents yields),
    built as one equi-join on the string order id. Orders without lines
    produce no row (inner join = explode semantics)."""
    return item_rows(spark, sf_dir).join(order_heads(spark, sf_dir), "order_id", "inner")


def _line_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Shuffle partitions for the heads and lines of all orders, where their
    size asks for more than a task per core or than the session has (else
    None: the session's). A larger count of the session is not enough: AQE
    would join its partitions to the advisory size, whatever their rows take
    in memory. Rows are counted from the files' footers."""
    rows = sum(table(spark, sf_dir, name).count() for name in ("orders", "lineitem"))
    size = path_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    wanted = max(-(-rows // PART_ROWS), -(-size // LINE_BYTES))
    session = file_writers(spark)
    enough = min(session, spark.sparkContext.defaultParallelism)
    return min(wanted, max(MOST_PARTITIONS, session)) if wanted > enough else None


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents: order fields + ``items`` array.

    Lines are grouped per order with a partial (map-side) collect, so a
    hot order is merged from per-task fragments; the array is sorted so
    item positions are deterministic. Orders without lines get a null
    ``items`` (left join), which is what the explode variants differ on.
    An order document is bounded by the lines of one order: that is the
    unit of the input format itself.

    Grouping and join sort what they are given, so where the session's
    partitions could be too large to be sorted in memory, both sides go to
    a number of them that follows their rows (``_line_partitions``), which
    serves grouping and join.
    """
    partitions = _line_partitions(spark, sf_dir)
    heads, rows = order_heads(spark, sf_dir), item_rows(spark, sf_dir, partitions)
    if partitions:
        heads = heads.repartition(partitions, "order_id")
    items = (
        rows.groupBy("order_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("item_pos").alias("line_no"),
                        F.col("item_qty").alias("qty"),
                        F.col("item_quantity").alias("quantity"),
                        F.col("item_unit_price").alias("unit_price"),
                        F.col("item_price").alias("price"),
                    )
                )
            ).alias("items")
        )
    )
    return heads.join(items, "order_id", "left")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers.csv stand-in: id, city, raw is_active text.

    ``nation`` is the fixed 25-row TPC-H dimension at every scale factor,
    so broadcasting it is size-bounded by construction."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("city"),
        _case(F.col("c_mktsegment"), SEGMENT_ACTIVE_TEXT).alias("is_active"),
    )


def refunds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """refunds.csv stand-in: returned lines with a high discount refund
    ``extendedprice * tax`` (computed exactly in decimals)."""
    l = table(spark, sf_dir, "lineitem")
    return l.where((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.08)).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"))
        .cast(NUM)
        .alias("amount"),
        F.date_format("l_shipdate", CREATED_AT_FORMAT).alias("created_at"),
    )
