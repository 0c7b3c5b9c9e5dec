"""Input files of the job, written by Spark from the driver's tables.

The job's real inputs are files (CSV customers/refunds, daily order
documents). To run the file sources over data that grows with the
tables, the table adapters are written once into the shared work folder:

* ``orders/order_month=YYYY-MM/`` -- order documents as JSON lines, one
  directory per month (plus one malformed file in 1997-03 for the
  quarantine path);
* ``daily/`` -- the reference's own layout (``stage_daily_files``);
* ``customers.csv/`` and ``refunds.csv/`` -- CSV with a header.

A copy is keyed by the size/mtime of the source tables and reused until
they change; the marker is the success file of the last output, so an
interrupted staging is rewritten from scratch (all writes overwrite).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.schemas import CUSTOMERS_FILE, ORDERS_FILE_PREFIX, REFUNDS_FILE
from ledgerloom.session import fingerprint, list_paths, move_files, path_exists, work_path
from ledgerloom.sinks.files import file_writers, write_csv
from ledgerloom.sources import tables as T
from ledgerloom.sources.files import MONTH_PARTITION

DAY = "order_day"
NOTE = "note"
MIXED_CUSTOMERS = "customers_mixed.csv"

# Fixed values of the staged fixture: month that receives a malformed file.
BAD_MONTH = "1997-03"
# order documents that one writer task sorts by month (some 20 MB)
PIECE_DOCS = 50_000
# bumped whenever the staged layout changes, so old copies are not reused
LAYOUT_VERSION = "10"
BAD_TEXT = '{"order_id": "broken", "items": [ this is not json'


def _stage_base(spark: SparkSession, sf_dir: str) -> str:
    key = fingerprint(spark, *[f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "nation")])
    return work_path(spark, "stage", f"v{LAYOUT_VERSION}-{key}")


def _month() -> Column:
    return F.substring("created_at", 1, 7)


def _dealt_by_month(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in partitions of about ``PIECE_DOCS``, month after
    month: small months share a partition, a large one is cut, so a month is
    in few files and no partition is too large to be sorted in memory.

    The months' sizes are counted over the order heads (a document each; one
    row a month reaches the driver). A range partitioning would build the
    documents twice, once to sample them; a rebalance makes pieces of the
    session's advisory size, whatever they take in memory."""
    heads = T.order_heads(spark, sf_dir)
    sizes = heads.groupBy(_month().alias("of_month")).agg(F.count(F.lit(1)).alias("month_docs")).collect()
    total, months = 0, []
    for month, n in sorted(sizes, key=lambda r: (r[0] is None, r[0])):
        months.append((month, total, n))
        total += n
    by_core = -(-total // spark.sparkContext.defaultParallelism)
    piece = max(1, min(PIECE_DOCS, max(PIECE_DOCS // 25, by_core)), total // max(T.MOST_PARTITIONS, file_writers(spark)))
    places = spark.createDataFrame(months, "of_month string, first_doc long, month_docs long")
    place = F.col("first_doc") + F.pmod(F.xxhash64("order_id", "customer_id", "created_at"), F.col("month_docs"))
    placed = docs.join(F.broadcast(places), F.col(MONTH_PARTITION).eqNullSafe(F.col("of_month")))
    dealt = placed.repartitionById(max(1, -(-total // piece)), F.floor(place / piece).cast("int"))
    return dealt.select(*docs.columns)


def stage_inputs(spark: SparkSession, sf_dir: str) -> str:
    sf_dir = sf_dir.rstrip("/")
    base = _stage_base(spark, sf_dir)
    if path_exists(spark, f"{base}/refunds.csv/_SUCCESS"):
        return base
    docs = T.order_documents(spark, sf_dir).withColumn(MONTH_PARTITION, _month())
    # an order field that the read schema does not declare (the items hold
    # one too, line_no)
    docs = docs.withColumn(NOTE, F.concat(F.lit("note of "), "customer_id"))
    _dealt_by_month(spark, docs, sf_dir).write.mode("overwrite").partitionBy(MONTH_PARTITION).json(f"{base}/orders")
    # appended next to the month's JSON part files (append keeps them)
    spark.range(1).select(F.lit(BAD_TEXT).alias("value")).write.mode("append").text(
        f"{base}/orders/{MONTH_PARTITION}={BAD_MONTH}"
    )
    write_csv(T.customers_raw(spark, sf_dir), f"{base}/customers.csv", sep=",")
    _write_mixed_parts(T.customers_raw(spark, sf_dir), f"{base}/{MIXED_CUSTOMERS}")
    write_csv(T.refunds_raw(spark, sf_dir), f"{base}/refunds.csv", sep=",")
    return base


def _write_mixed_parts(customers: DataFrame, path: str) -> None:
    """Part files of one folder whose headers differ in order and letter
    case; cities hold a line break and quotes in part of the rows."""
    odd = F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 1
    city = F.when(F.col("customer_id").endswith("7"), F.concat(F.lit('"new"\n'), "city")).otherwise(F.col("city"))
    customers = customers.withColumn("city", city)
    whole = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    write = lambda df, mode: df.write.mode(mode).options(**whole).csv(path)
    write(customers.where(odd).select("customer_id", "city", "is_active"), "overwrite")
    turned = [F.col("is_active").alias("IS_ACTIVE"), F.col("city").alias("City"), F.lit("x").alias("more"), F.col("customer_id").alias("Customer_Id")]
    write(customers.where(~odd).select(*turned), "append")


def stage_daily_files(spark: SparkSession, sf_dir: str) -> str:
    """The reference's own input layout in one folder: one multi-line JSON
    array per day named ``orders_YYYY-MM-DD.json`` plus customers.csv and
    refunds.csv. Returns the folder.

    Each day file is a single JSON array, so a day has to be written by
    one task: rows are numbered within their day (sort-based window, not
    collected in memory) to place the opening and closing brackets, the
    day directories are written in parallel, and the part files are then
    renamed to the day names (file-system metadata, one per day)."""
    sf_dir = sf_dir.rstrip("/")
    base = _stage_base(spark, sf_dir)
    folder = f"{base}/daily"
    if path_exists(spark, f"{folder}/{REFUNDS_FILE}/_SUCCESS"):
        return folder
    docs = T.order_documents(spark, sf_dir).withColumn(DAY, F.date_format(F.to_date("created_at"), "yyyy-MM-dd"))
    w = Window.partitionBy(DAY).orderBy("order_id")
    whole_day = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rn, n = F.row_number().over(w), F.count(F.lit(1)).over(whole_day)
    doc = F.to_json(F.struct("order_id", "customer_id", "channel", "created_at", "payment_status", "items"))
    text = F.concat(F.when(rn == 1, F.lit("[\n")).otherwise(F.lit("")), doc, F.when(rn == n, F.lit("\n]")).otherwise(F.lit(",")))
    parts = f"{base}/daily_parts"
    # the explicit day shuffle keeps its partition count (AQE would shrink
    # a small input to a few tasks, each then writing many day files)
    docs = docs.repartition(file_writers(spark), DAY)
    docs.select(DAY, text.alias("value")).write.mode("overwrite").partitionBy(DAY).text(parts)
    moves = []
    for path in list_paths(spark, f"{parts}/{DAY}=*/part-*"):
        day = path.rsplit("/", 2)[-2].split("=", 1)[1]
        moves.append((path, f"{folder}/{ORDERS_FILE_PREFIX}{day}.json"))
    move_files(spark, moves, folder)
    write_csv(T.customers_raw(spark, sf_dir), f"{folder}/{CUSTOMERS_FILE}", sep=",")
    write_csv(T.refunds_raw(spark, sf_dir), f"{folder}/{REFUNDS_FILE}", sep=",")
    return folder
