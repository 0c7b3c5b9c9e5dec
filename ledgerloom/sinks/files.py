"""Sinks (K1-K5): rejects CSV, tables, per-day and all-days report CSVs.

Writers are the only actions of the job. Each output is written by the
executors in parallel (no collect, no per-date loop of jobs):

* per-day report files are one ``partitionBy('day')`` write; dynamic
  partition overwrite replaces the days being written and keeps the
  other months' days (D25);
* the all-days report is a directory of part files in the report's order
  (a range-partitioned sort, no single-task funnel);
* an empty result leaves an existing table/file untouched unless
  ``replace_empty`` is set (D24).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerloom.functions.scalar import day_key, money_text, to_double
from ledgerloom.schemas import (
    CSV_ENCODING,
    CSV_FLOAT_FORMAT,
    CSV_SEP,
    DAILY_ALL,
    DAILY_PREFIX,
    REJECTS_FILE,
)
from ledgerloom.session import remove_folder, swap_folder

DAY_COLUMN = "day"


def file_writers(spark) -> int:
    """Writer tasks for outputs with one file per key: the session's
    shuffle partition count (default parallelism when that is not a
    number)."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return max(1, spark.sparkContext.defaultParallelism)


def write_csv(
    df: DataFrame,
    path: str,
    sep: str = CSV_SEP,
    encoding: str = CSV_ENCODING,
    header: bool = True,
    partition_by: str | None = None,
) -> None:
    w = (
        df.write.mode("overwrite")
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    w.csv(path)


def reject_rows(rejects: DataFrame) -> DataFrame:
    """The reject file's columns (doubles at the edge)."""
    return rejects.select(
        "order_id",
        "customer_id",
        "channel",
        "created_at",
        to_double("item_qty").alias("item_qty"),
        to_double("item_unit_price").alias("item_unit_price"),
    )


def write_rejects(rejects: DataFrame, out_dir: str, encoding: str = CSV_ENCODING, replace_empty: bool = False) -> bool:
    """K1: ``<out>/rejects_items.csv`` (comma separated, header), written
    only when there is at least one reject unless ``replace_empty``. As
    with tables, the rows are written beside it and asked there (A7)."""
    rows = reject_rows(rejects)
    spark = rows.sparkSession
    fresh = f"{out_dir}/.{REJECTS_FILE}-{uuid.uuid4().hex[:12]}"
    try:
        write_csv(rows, fresh, sep=",", encoding=encoding)
        found = spark.read.schema(rows.schema).option("header", True).option("encoding", encoding).csv(fresh)
        if not replace_empty and found.isEmpty():
            return False
        swap_folder(spark, fresh, f"{out_dir}/{REJECTS_FILE}")
        return True
    finally:
        remove_folder(spark, fresh)


def write_table(df: DataFrame, path: str, replace_empty: bool = False) -> bool:
    """K5: replace a table stored as Parquet at ``path``. The rows are
    written once, beside the table, and then take its place: a write that
    fails leaves the old table readable, and ``df`` may read it. Whether
    there are rows is asked of the written files, not of the plan (A7)."""
    spark = df.sparkSession
    head, _, name = path.rstrip("/").rpartition("/")
    fresh = f"{head}/.{name}-{uuid.uuid4().hex[:12]}" if head else f".{name}-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(fresh)
        if not replace_empty and spark.read.schema(df.schema).parquet(fresh).isEmpty():
            return False
        swap_folder(spark, fresh, path.rstrip("/"))
        return True
    finally:
        remove_folder(spark, fresh)


def formatted_report(report: DataFrame, float_format: str = CSV_FLOAT_FORMAT) -> DataFrame:
    """Floating columns as printf text, DATE as yyyy-MM-dd."""
    cols = []
    for f in report.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(money_text(f.name, float_format).alias(f.name))
        elif f.name == "date":
            cols.append(F.date_format("date", "yyyy-MM-dd").alias("date"))
        else:
            cols.append(F.col(f.name))
    return report.select(*cols)


def export_daily_csvs(
    report: DataFrame,
    out_dir: str,
    sep: str = CSV_SEP,
    encoding: str = CSV_ENCODING,
    float_format: str = CSV_FLOAT_FORMAT,
    replace_empty: bool = False,
) -> bool:
    """K2/K3/K4: one file per non-null date under
    ``<out>/daily_summary/day=YYYYMMDD/`` and every row (null dates too)
    under ``<out>/daily_summary_all.csv/``. The formatted report is
    written once; the emptiness test and both outputs read that copy, so
    the plan of the report runs once."""
    spark = report.sparkSession
    text = formatted_report(report, float_format)
    staged = f"{out_dir}/.report-{uuid.uuid4().hex[:12]}"
    try:
        text.write.parquet(staged)
        text = spark.read.schema(text.schema).parquet(staged)
        if not replace_empty and text.isEmpty():
            return False
        _write_days(text, out_dir, sep, encoding)
        # O1: a range-partitioned sort, so the part files in the order of
        # their names, one after the other, are the sorted report
        write_csv(text.orderBy("date", "city", "channel"), f"{out_dir}/{DAILY_ALL}", sep, encoding)
        return True
    finally:
        remove_folder(spark, staged)


def _write_days(text: DataFrame, out_dir: str, sep: str, encoding: str) -> None:
    # One file per day: the cost of this write is per file, not per byte,
    # so the day shuffle keeps the session's partition count (an explicit
    # count, which AQE does not coalesce) and days are written in
    # parallel instead of all by the one task a small report shrinks to.
    writers = file_writers(text.sparkSession)
    per_day = (
        text.where(F.col("date").isNotNull())
        .withColumn(DAY_COLUMN, day_key(F.to_date("date")))
        .repartition(writers, DAY_COLUMN)
        .sortWithinPartitions(DAY_COLUMN, "city", "channel")
    )
    write_csv(per_day, f"{out_dir}/{DAILY_PREFIX.rstrip('_')}", sep, encoding, partition_by=DAY_COLUMN)
