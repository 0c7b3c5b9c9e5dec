"""Registered queries: one per operator group of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the driver's tables (or
files Spark wrote from them into the shared work folder) and returns a
DataFrame whose columns are named exactly like the matching statement in
``plans.oracle``. Builders that exercise a sink or a stream run that
write first and return the data read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import active_flag, parse_date, safe_number, to_double
from ledgerloom.operators import lines as L
from ledgerloom.operators import sales as S
from ledgerloom.operators.skew import hot_keys
from ledgerloom.plans import metrics as M
from ledgerloom.plans import report as R
from ledgerloom.plans.month_job import run_month
from ledgerloom.plans.staging import MIXED_CUSTOMERS, stage_daily_files, stage_inputs
from ledgerloom.schemas import CUSTOMERS_FILE, PAID, REFUNDS_FILE, REJECTS, REJECTS_FILE, TABLE_DAILY_SALES
from ledgerloom.session import work_path
from ledgerloom.sinks import files as K
from ledgerloom.sources import files as SRC
from ledgerloom.sources import tables as T
from ledgerloom.sources.open_json import read_open_orders
from ledgerloom.streaming.landing import land_orders, landed_clean

Builder = Callable[[SparkSession, str], DataFrame]

# The month the file-based queries select.
MONTH = (1997, 3)


# ---------------------------------------------------------------- helpers
def _paid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = T.order_heads(spark, sf_dir, status=PAID)  # the status reaches the scan
    return L.normalize_items(L.paid_only(T.item_rows(spark, sf_dir).join(heads, "order_id")))


def _good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.split_rejects(_paid_lines(spark, sf_dir))[0]


def _kept_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-first over lines; orders are keyed by order_id, so it runs on
    the item side before the head join (see report.from_keyed_tables)."""
    return R.keyed_lines(T.order_heads(spark, sf_dir, status=PAID), T.item_rows(spark, sf_dir))[3]


def _per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.per_order(_kept_lines(spark, sf_dir))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.type_customers(T.customers_raw(spark, sf_dir))


def _refund_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.refunds_per_order(T.refunds_raw(spark, sf_dir))


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[to_double(c).alias(c) if c in names else F.col(c) for c in df.columns])


def _doc_rows(docs: DataFrame, *extra: str) -> DataFrame:
    return docs.select(
        "order_id",
        "customer_id",
        "channel",
        "created_at",
        "payment_status",
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        *extra,
    )


def _table_chain(spark: SparkSession, sf_dir: str, grain: str = "line", sort: bool = True) -> R.SalesFrames:
    # only paid heads are used: ask the source for them (pushed to Parquet);
    # the chain's own paid filter stays on top
    return R.from_keyed_tables(
        T.order_heads(spark, sf_dir, status=PAID),
        T.item_rows(spark, sf_dir),
        T.customers_raw(spark, sf_dir),
        T.refunds_raw(spark, sf_dir),
        grain=grain,
        sort=sort,
    )


# ---------------------------------------------------------------- sources
def scan_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers.csv (written from the tables) read back under the
    declared all-string schema."""
    base = stage_inputs(spark, sf_dir)
    return SRC.read_customers_raw(spark, f"{base}/{CUSTOMERS_FILE}")


def scan_csv_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files with headers of different order and letter case, and
    fields with quotes and line breaks."""
    base = stage_inputs(spark, sf_dir)
    return SRC.read_customers_raw(spark, f"{base}/{MIXED_CUSTOMERS}")


def scan_csv_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds.csv (written from the tables), the amount as number."""
    base = stage_inputs(spark, sf_dir)
    raw = SRC.read_refunds_raw(spark, f"{base}/{REFUNDS_FILE}")
    return raw.select("order_id", to_double(safe_number("amount")).alias("amount"), "created_at")


def scan_json_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order documents of one month in one scan of its
    partition directory; the malformed file of that month goes to
    quarantine, not to the result."""
    base = stage_inputs(spark, sf_dir)
    docs = SRC.read_orders_month(spark, f"{base}/orders", *MONTH, layout="month_partitions")
    clean, _ = SRC.split_corrupt(docs)
    return _doc_rows(clean, SRC.MONTH_PARTITION)


def scan_json_month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 in the reference's own layout: one multi-line JSON array per
    day named orders_YYYY-MM-DD.json in one folder; the month is chosen by
    file name (glob + day validation) in a single scan."""
    folder = stage_daily_files(spark, sf_dir)
    clean, _ = SRC.split_corrupt(SRC.read_orders_month(spark, folder, *MONTH, layout="daily_files"))
    return _doc_rows(clean, "source_file")


def open_schema_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of one month with every order and item field the
    documents hold, declared or not (here ``note`` and ``line_no``)."""
    base = stage_inputs(spark, sf_dir)
    docs = read_open_orders(spark, f"{base}/orders", *MONTH, layout="month_partitions")
    clean, _ = SRC.split_corrupt(docs)
    lines = L.normalize_items(L.explode_items(clean))
    return _doubles(
        lines.select("order_id", "customer_id", "note", "item_pos", F.col("item_line_no").cast("int").alias("line_no"), "item_qty", "item_unit_price"),
        "item_qty",
        "item_unit_price",
    )


def union_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written with {qty, unit_price} and lines written with
    {quantity, price}, unioned by name (missing fields are null)."""
    items = T.item_rows(spark, sf_dir)
    old = items.where(F.col("item_qty").isNotNull()).select("order_id", "item_pos", "item_qty", "item_unit_price")
    new = items.where(F.col("item_quantity").isNotNull()).select("order_id", "item_pos", "item_quantity", "item_price")
    return SRC.union_by_name(old, new)


def union_clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose order id is a number and whose items hold
    {line_no int, qty text}, united with documents whose order id is text
    and whose items hold {line_no bigint, qty bigint, status}."""
    l = T.table(spark, sf_dir, "lineitem")
    line, qty = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    even = F.col("l_orderkey") % 2 == 0

    def documents(rows: DataFrame, order_id: Column, *fields: Column) -> DataFrame:
        return rows.groupBy(order_id.alias("order_id")).agg(F.collect_list(F.struct(*fields)).alias("items"))

    old = documents(
        l.where(even), F.col("l_orderkey").cast("bigint"), line.cast("int").alias("line_no"), qty.cast("string").alias("qty")
    )
    new = documents(
        l.where(~even),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")),
        line.cast("bigint").alias("line_no"),
        qty.alias("qty"),
        F.col("l_linestatus").alias("status"),
    )
    return SRC.union_by_name(old, new).select("order_id", F.inline("items"))


# ---------------------------------------------------------- lines / filters
def paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payment_status = 'paid'."""
    return L.paid_only(T.order_heads(spark, sf_dir, status=PAID))


def explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> one row per item, all item fields
    flattened as item_*, empty documents dropped."""
    return L.explode_items(T.order_documents(spark, sf_dir))


def explode_lines_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As explode_lines, but a document without items gives one row."""
    return L.explode_items(T.order_documents(spark, sf_dir), keep_empty=True)


def coalesce_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """quantity and price from whichever field name is present."""
    lines = L.normalize_items(L.explode_items(T.order_documents(spark, sf_dir)))
    return _doubles(lines.select("order_id", "item_pos", "item_qty", "item_unit_price"), "item_qty", "item_unit_price")


def lines_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid lines with price >= 0."""
    return K.reject_rows(L.split_rejects(_paid_lines(spark, sf_dir))[0])


def lines_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2/K1 rows: paid lines with price < 0."""
    return K.reject_rows(L.split_rejects(_paid_lines(spark, sf_dir))[1])


def rejects_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the reject sink -- rejected lines written as rejects_items.csv
    (header, comma) and read back under the declared reject schema."""
    out = work_path(spark, "rejects", uuid.uuid4().hex[:12])
    K.write_rejects(L.split_rejects(_paid_lines(spark, sf_dir))[1], out, replace_empty=True)
    return SRC.read_csv(spark, f"{out}/{REJECTS_FILE}", REJECTS)


# ------------------------------------------------------------ functions
def normalize_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw is_active text -> boolean."""
    raw = T.customers_raw(spark, sf_dir)
    return raw.select("customer_id", "city", F.col("is_active").alias("is_active_text"), active_flag("is_active").alias("is_active"))


def _refund_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An amount of every line as text: some unparseable, some with more
    decimals or digits than money has."""
    l = T.table(spark, sf_dir, "lineitem")
    amount = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)")
    text = (
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .when(F.col("l_linenumber") == 6, F.lit(""))
        .when(F.col("l_linenumber") == 5, F.concat(amount.cast("string"), F.lit("37")))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("9"), F.lpad(F.col("l_orderkey").cast("string"), 14, "0"), F.lit(".25")))
        .otherwise(amount.cast("string"))
    )
    return l.select(F.col("l_orderkey").cast("string").alias("order_id"), text.alias("amount_text"))


def safe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """text -> number without failing; bad -> null, or 0 by policy."""
    t = _refund_texts(spark, sf_dir)
    return t.select(
        "order_id",
        "amount_text",
        to_double(safe_number("amount_text")).alias("amount"),
        to_double(safe_number("amount_text", default=0.0)).alias("amount_or_zero"),
    )


def _created_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """created_at text in the layouts met in order files (one per order,
    chosen by a rule on the order key), plus unparseable text."""
    o = T.table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 17
    text = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 3, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 4, F.date_format(d, "yyyy/MM/dd"))
        .when(k == 5, F.date_format(d, "M/d/yyyy"))
        .when(k == 6, F.date_format(d, "MM/dd/yyyy HH:mm:ss"))
        .when(k == 7, F.date_format(d, "yyyyMMdd"))
        .when(k == 8, F.date_format(d, "MMMM d, yyyy"))
        .when(k == 9, F.date_format(d, "dd-MMM-yyyy"))
        .when(k == 10, F.date_format(d, "yyyy/MM/dd HH:mm"))
        .when(k == 11, F.date_format(d, "d MMMM yyyy"))
        .when(k == 12, F.date_format(d, "MMM d, yyyy h:mm a"))
        .when(k == 13, F.date_format(d, "MM.dd.yyyy"))
        .when(k == 14, F.date_format(d, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(k == 15, F.date_format(d, "yyyyMMddHHmmss"))
        .otherwise(F.concat(F.lit("week of "), F.date_format(d, "yyyyMMdd")))
    )
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"), text.alias("created_text"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """created_at text -> DATE, null when unparseable."""
    t = _created_texts(spark, sf_dir)
    return t.select("order_id", "created_text", parse_date("created_text").alias("order_date"))


# ------------------------------------------------------------ keep-first
def first_line_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First good line per order (created_at, position,
    content), one exchange, partial top-1 before it."""
    return _doubles(_kept_lines(spark, sf_dir), "item_qty", "item_unit_price")


def _split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents per order: even lines at the order time, odd lines
    as a copy stamped at noon of the same day."""
    items = T.item_rows(spark, sf_dir).withColumn("odd", F.col("item_qty").isNull())
    grouped = items.groupBy("order_id", "odd").agg(
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
    heads = T.order_heads(spark, sf_dir)
    docs = grouped.join(heads, "order_id")
    noon = F.concat(F.substring("created_at", 1, 10), F.lit(" 12:00:00"))
    return docs.withColumn("created_at", F.when(F.col("odd"), noon).otherwise(F.col("created_at"))).drop("odd")


def first_order_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 at document grain: the first document of each order is kept
    whole (all its lines), later copies are dropped."""
    docs = R.first_documents(_split_documents(spark, sf_dir))
    lines = L.normalize_items(L.explode_items(docs))
    return _doubles(lines.select("order_id", "created_at", "item_pos", "item_qty", "item_unit_price"), "item_qty", "item_unit_price")


def unique_customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer listed twice (second time with a lower-case
    city); one row per customer survives, chosen by content."""
    raw = T.customers_raw(spark, sf_dir)
    copies = raw.withColumn("city", F.lower("city"))
    return S.normalize_customers(SRC.union_by_name(raw, copies))


# ------------------------------------------------------------ sales chain
def line_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_gross = qty * unit price (exact)."""
    g = S.with_line_gross(_good_lines(spark, sf_dir)).select("order_id", "item_pos", "item_qty", "item_unit_price", "line_gross")
    return _doubles(g, "item_qty", "item_unit_price", "line_gross")


def per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: per-order sums of the kept lines."""
    return _doubles(_per_order(spark, sf_dir), "items_sold", "gross_revenue_eur")


def per_order_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order rows of active customers, with their city."""
    hot = hot_keys(T.order_heads(spark, sf_dir, status=PAID), "customer_id")
    po = S.attach_customers(_per_order(spark, sf_dir), _customers(spark, sf_dir), hot)
    return _doubles(po, "items_sold", "gross_revenue_eur")


def refunds_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/P10: refunds summed per order (all refund dates)."""
    return _doubles(_refund_sums(spark, sf_dir), "refunds_eur")


def per_order_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order rows with their refunds, 0 when none."""
    po = S.attach_refunds(_per_order(spark, sf_dir), _refund_sums(spark, sf_dir))
    return _doubles(po, "items_sold", "gross_revenue_eur", "refunds_eur")


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5/K5: the orders_clean table, written and read back."""
    path = work_path(spark, "tables", uuid.uuid4().hex[:12], "orders_clean")
    K.write_table(_table_chain(spark, sf_dir, sort=False).orders_clean, path, replace_empty=True)
    return spark.read.parquet(path)


def daily_city_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the whole chain over whole tables."""
    return _table_chain(spark, sf_dir).report


def daily_city_sales_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 at order grain: every good line of an order counts."""
    return _table_chain(spark, sf_dir, grain="all").report


def report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct report dates and their month end."""
    return S.report_dates(_table_chain(spark, sf_dir, sort=False).report)


def daily_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as ';' CSV with '%.2f' numbers,
    one directory per day plus the all-days file; read back as text
    lines (headers excluded)."""
    out = work_path(spark, "exports", uuid.uuid4().hex[:12])
    report = _table_chain(spark, sf_dir, sort=False).report
    K.export_daily_csvs(report, out, replace_empty=True)
    header = ";".join(report.columns)
    day = spark.read.text(f"{out}/daily_summary").select(
        F.lit("day").alias("target"),
        F.regexp_extract(F.col("_metadata.file_path"), r"day=([0-9]{8})", 1).alias("day"),
        F.col("value").alias("line"),
    )
    all_days = spark.read.text(f"{out}/daily_summary_all.csv").select(
        F.lit("all").alias("target"), F.lit(None).cast("string").alias("day"), F.col("value").alias("line")
    )
    return day.unionByName(all_days).where(F.col("line") != header)


def sorted_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/O1: the all-days CSV with the number of each line when its part
    files are read in the order of their names. Lines are numbered within
    their file; only the line counts of the files are summed in one task."""
    out = work_path(spark, "exports", uuid.uuid4().hex[:12])
    report = _table_chain(spark, sf_dir, sort=False).report
    K.export_daily_csvs(report, out, replace_empty=True)
    read = spark.read.text(f"{out}/daily_summary_all.csv").where(F.col("value") != ";".join(report.columns))
    lines = read.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("nth"), "value")
    counts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("file", F.coalesce(before, F.lit(0)).alias("start"))
    numbered = lines.withColumn("own", F.row_number().over(Window.partitionBy("file").orderBy("nth")))
    return numbered.join(starts, "file").select((F.col("start") + F.col("own")).alias("line_no"), F.col("value").alias("line"))


def month_job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that the monthly job returns, as rows."""
    base = stage_inputs(spark, sf_dir)
    out = work_path(spark, "jobs", uuid.uuid4().hex[:12])
    found = run_month(spark, f"{base}/orders", out, *MONTH, layout="month_partitions", side_dir=base, replace_empty=True)
    return spark.createDataFrame(sorted(found.items()), "metric string, value bigint")


def quality_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M4/A4: counters of the chain as (metric, value) rows."""
    heads = T.order_heads(spark, sf_dir)
    lines = _paid_lines(spark, sf_dir)
    return M.counters_frame(heads, L.paid_only(heads), lines, _kept_lines(spark, sf_dir))


def month_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly job on month-partitioned JSON-lines files written
    from the tables (1997-03):
    JSON + CSV in, tables and CSV out; returns daily_city_sales as read
    back from its written table."""
    base = stage_inputs(spark, sf_dir)
    out = work_path(spark, "jobs", uuid.uuid4().hex[:12])
    run_month(spark, f"{base}/orders", out, *MONTH, layout="month_partitions", side_dir=base, replace_empty=True)
    return spark.read.parquet(f"{out}/tables/{TABLE_DAILY_SALES}")


def month_job_daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 on the reference's own input folder (day files + customers.csv +
    refunds.csv side by side); returns daily_city_sales read back."""
    folder = stage_daily_files(spark, sf_dir)
    out = work_path(spark, "jobs", uuid.uuid4().hex[:12])
    run_month(spark, folder, out, *MONTH, replace_empty=True)
    return spark.read.parquet(f"{out}/tables/{TABLE_DAILY_SALES}")


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming landing of all staged order files into Parquet
    (availableNow, exactly-once file sink), read back."""
    base = stage_inputs(spark, sf_dir)
    run = work_path(spark, "landing", uuid.uuid4().hex[:12])
    land_orders(spark, f"{base}/orders", f"{run}/landed", f"{run}/checkpoint")
    return _doc_rows(landed_clean(spark.read.parquet(f"{run}/landed")))


def builders() -> dict[str, Builder]:
    return {
        "scan_csv_customers": scan_csv_customers,
        "scan_csv_parts": scan_csv_parts,
        "scan_csv_refunds": scan_csv_refunds,
        "scan_json_month": scan_json_month,
        "scan_json_month_files": scan_json_month_files,
        "open_schema_lines": open_schema_lines,
        "union_evolving": union_evolving,
        "union_clashing": union_clashing,
        "paid_orders": paid_orders,
        "explode_lines": explode_lines,
        "explode_lines_outer": explode_lines_outer,
        "coalesce_alternates": coalesce_alternates,
        "lines_good": lines_good,
        "lines_rejected": lines_rejected,
        "rejects_file": rejects_file,
        "normalize_active": normalize_active,
        "safe_numeric": safe_numeric,
        "parse_dates": parse_dates,
        "first_line_per_order": first_line_per_order,
        "first_order_document": first_order_document,
        "unique_customers_dim": unique_customers_dim,
        "line_gross": line_gross,
        "per_order": per_order,
        "per_order_active": per_order_active,
        "refunds_per_order": refunds_per_order,
        "per_order_refunds": per_order_refunds,
        "orders_clean": orders_clean,
        "daily_city_sales": daily_city_sales,
        "daily_city_sales_all_lines": daily_city_sales_all_lines,
        "report_dates": report_dates,
        "daily_csv_export": daily_csv_export,
        "sorted_csv_lines": sorted_csv_lines,
        "quality_counters": quality_counters,
        "month_job_counters": month_job_counters,
        "month_job": month_job,
        "month_job_daily_files": month_job_daily_files,
        "landed_orders": landed_orders,
    }
