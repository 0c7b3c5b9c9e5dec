"""Function-for-function API of the monthly job (same names and
signatures as the job's public functions), each a thin composition of
the ``ledgerloom`` operators. Quantities and money come back as doubles
at this API's edges; inside, sums are exact decimals.

Re-aimed: tables are Parquet folders instead of a database file
(``write_table``), and the whole job is ``run_month``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import safe_number, to_double
from ledgerloom.operators import dedup
from ledgerloom.operators import lines as L
from ledgerloom.operators import sales as S
from ledgerloom.operators.skew import hot_keys
from ledgerloom.plans.month_job import run_month
from ledgerloom.sinks import files as K
from ledgerloom.sources import files as SRC

__all__ = [
    "read_customers",
    "read_refunds",
    "read_orders_for_month",
    "explode_items",
    "explode_items_and_normalize",
    "detect_and_save_rejects",
    "deduplicate_keep_first",
    "compute_per_order_and_agg",
    "aggregate_orders",
    "write_table",
    "export_daily_csvs",
    "export_csvs",
    "run_month",
]

ITEM_COLUMNS = ["order_id", "customer_id", "channel", "created_at", "item_qty", "item_unit_price"]


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """customers.csv -> (customer_id string, city string, is_active
    boolean); a missing file gives the typed empty frame."""
    return S.type_customers(SRC.read_customers_raw(spark, str(path)))


def read_refunds(spark: SparkSession, path: str) -> DataFrame:
    """refunds.csv -> (order_id string, amount double, created_at string);
    an unparseable amount is 0.0."""
    raw = SRC.read_refunds_raw(spark, str(path))
    return raw.select("order_id", to_double(safe_number("amount", default=0.0)).alias("amount"), "created_at")


def read_orders_for_month(spark: SparkSession, input_dir: str, year: int, month: int) -> DataFrame:
    """Every parsed order document of orders_YYYY-MM-DD.json files of the
    month (one scan; malformed files are left out, see
    ``sources.files.split_corrupt`` for the quarantine)."""
    clean, _ = SRC.split_corrupt(SRC.read_orders_month(spark, str(input_dir), year, month))
    return clean


def _item_lines(df: DataFrame) -> DataFrame:
    """Exploded + normalized lines with the item columns as doubles."""
    lines = L.item_lines(df) if "items" in df.columns else df
    return lines.withColumn("item_qty", to_double("item_qty")).withColumn("item_unit_price", to_double("item_unit_price"))


def explode_items(df: DataFrame) -> DataFrame:
    """One row per item: order_id, customer_id, channel, created_at,
    item_qty, item_unit_price (doubles; ``qty``/``quantity`` and
    ``unit_price``/``price`` accepted per row), then ``item_pos`` (and
    ``source_file`` when read from files): the keep-first tie-break that
    makes the first line of an order deterministic. Empty documents give
    no row."""
    lines = _item_lines(df)
    cols = ITEM_COLUMNS + ["item_pos", "source_file"]
    return lines.select(*[c for c in cols if c in lines.columns])


def explode_items_and_normalize(orders: DataFrame) -> DataFrame:
    """One row per item keeping every order column except ``items`` and
    every item field as ``item_<field>``; a document without items gives
    one row; missing quantity or price count as 0."""
    return L.apply_null_policy(L.normalize_items(L.explode_items(orders, keep_empty=True)), "zero").transform(
        lambda d: d.withColumn("item_qty", to_double("item_qty")).withColumn("item_unit_price", to_double("item_unit_price"))
    )


def detect_and_save_rejects(df: DataFrame, out_dir: str, csv_encoding: str = "utf-8") -> DataFrame:
    """Write lines with a negative unit price to ``<out>/rejects_items.csv``
    (only if there are any) and return the lines with price >= 0. A frame
    without that column is returned as it is (P17)."""
    if "item_unit_price" not in df.columns:
        return df
    good, rejects = L.split_rejects(df)
    K.write_rejects(rejects.select(*ITEM_COLUMNS) if set(ITEM_COLUMNS) <= set(rejects.columns) else rejects, str(out_dir), csv_encoding)
    return good


def deduplicate_keep_first(df: DataFrame) -> DataFrame:
    """First line per order_id by created_at (nulls last, then position
    and content, so the pick is deterministic); without created_at one
    row per order_id; without order_id the frame unchanged."""
    if "order_id" not in df.columns:
        return df
    if "created_at" not in df.columns:
        return dedup.unique_by_key(df, "order_id")
    return dedup.keep_first(df, "order_id", tuple(c for c in ("created_at", "source_file", "item_pos") if c in df.columns))


def _exact(lines: DataFrame) -> DataFrame:
    return lines.withColumn("item_qty", safe_number("item_qty")).withColumn("item_unit_price", safe_number("item_unit_price"))


def compute_per_order_and_agg(
    items_df: DataFrame, customers_df: DataFrame, refunds_df: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(per-order rows of active customers with city, order_date and
    refunds_eur; daily city/channel report). Customers and orders with
    very many lines are spread over tasks by salted joins."""
    po = S.per_order(_exact(items_df))
    enriched = S.enrich(po, customers_df.select("customer_id", "city", F.col("is_active").cast("boolean").alias("is_active")),
                        S.refunds_per_order(refunds_df), hot_keys(items_df, "customer_id"), hot_keys(items_df, "order_id"))
    per_order = enriched.select(
        "order_id", "customer_id", "city", "channel", "created_at", "order_date",
        to_double("items_sold").alias("items_sold"),
        to_double("gross_revenue_eur").alias("gross_revenue_eur"),
        to_double("refunds_eur").alias("refunds_eur"),
    )
    return per_order, S.daily_city_sales(enriched)


aggregate_orders = compute_per_order_and_agg


def write_table(df: DataFrame, db_path: str, table_name: str) -> bool:
    """Replace table ``table_name`` (a Parquet folder under ``db_path``);
    an empty frame leaves the existing table as it is."""
    return K.write_table(df, f"{str(db_path).rstrip('/')}/{table_name}")


def export_daily_csvs(agg_df: DataFrame, out_dir: str, sep: str = ";", ffmt: str = "%.2f", encoding: str = "utf-8") -> bool:
    """One CSV per date (``daily_summary/day=YYYYMMDD/``) and one for all
    dates (``daily_summary_all.csv/``), floats printed with ``ffmt``."""
    return K.export_daily_csvs(agg_df, str(out_dir), sep=sep, encoding=encoding, float_format=ffmt)


def export_csvs(agg: DataFrame, out_dir: str, sep: str, enc: str, ffmt: str) -> bool:
    return export_daily_csvs(agg, out_dir, sep=sep, ffmt=ffmt, encoding=enc)
