"""The monthly job, files in -> tables and CSV out.

Actions, in order (compare: the reference runs ~18 actions plus one job
per date, re-reading the JSON for each):

1. land the month's documents (corrupt ones included) as Parquet in the
   run folder -- the only JSON parse; also cuts the lineage, so a lost
   executor later costs a Parquet re-read, not a re-parse;
2. quarantine (corrupt documents), if any;
3. normalized paid lines -> Parquet;
4. rejects CSV, if any;
5. enriched per-order rows -> Parquet (keep-first/per-order/joins);
6. ``orders_clean`` and ``daily_city_sales`` tables from the enriched
   rows; per-day and all-days CSV from the written report table;
7. counters, from the written Parquet (row counts are in its footers), so
   a task that ran twice counts once.

Run folders live under the shared work folder (``spark.checkpoint.dir``).
A run's folder is named by its arguments and by length and time of its
input files, and the success file of each written step is the ledger: a
job that was killed, started again on the same input, goes on at its first
unfinished step. Success removes the folder. (Two equal jobs at one time
are not meant to run.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import lines as L
from ledgerloom.operators import sales as S
from ledgerloom.plans import metrics as M
from ledgerloom.plans.report import first_documents, from_lines
from ledgerloom.schemas import (
    CSV_ENCODING,
    CSV_FLOAT_FORMAT,
    CSV_SEP,
    CUSTOMERS_FILE,
    ORDERS_FILE_PREFIX,
    REFUNDS_FILE,
    PAID,
    TABLE_DAILY_SALES,
    TABLE_ORDERS_CLEAN,
)
from ledgerloom.session import fingerprint, list_paths, path_exists, remove_folder, work_path
from ledgerloom.sinks import files as K
from ledgerloom.sources import files as SRC
from ledgerloom.sources.open_json import day_files, typed


def _salvaged(landed: DataFrame, input_dir: str, path: str) -> DataFrame:
    """The landed documents, with the day files that did not parse as
    documents read again element by element; only what is no document
    stays in quarantine. At most one name per day is looked at."""
    spark = landed.sparkSession
    unreadable = F.col(SRC.CORRUPT_COLUMN).startswith(SRC.UNREADABLE)
    names = [r[0] for r in landed.where(unreadable).select("source_file").distinct().collect()]
    if not names:
        return landed
    typed(day_files(spark, input_dir, names)).select(*landed.columns).write.mode("overwrite").parquet(path)
    rest = landed.where(F.coalesce(~unreadable, F.lit(True)))
    return rest.unionByName(spark.read.parquet(path))


def _run_folder(spark: SparkSession, input_dir: str, side_dir: str, year: int, month: int, *arguments: object) -> str:
    """The folder of this run: equal arguments and input files, equal name."""
    name = f"{year:04d}-{month:02d}"
    found = [f"{input_dir}/{ORDERS_FILE_PREFIX}{name}-*.json", f"{input_dir}/{SRC.MONTH_PARTITION}={name}/*"]
    for side in (CUSTOMERS_FILE, REFUNDS_FILE):
        found += [f"{side_dir}/{side}", f"{side_dir}/{side}/*"]
    files = sorted(path for pattern in found for path in list_paths(spark, pattern))
    key = "|".join(map(str, (input_dir, side_dir, *arguments, fingerprint(spark, *files))))
    return work_path(spark, "runs", f"{name}-{hashlib.sha1(key.encode()).hexdigest()[:16]}")


def _step(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of a step: written unless an earlier run finished it."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _counters(landed: DataFrame, lines: DataFrame, enriched: DataFrame, grain: str) -> dict[str, int]:
    """M1-M4: counts of the written tables; the lines before and after
    keep-first, which at line grain leaves one for each order id."""
    bad = landed[SRC.CORRUPT_COLUMN].isNotNull()
    good = L.split_rejects(lines)[0]
    kept = good.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")) if grain == "line" else good
    heads = {
        "orders_corrupt": F.count_if(bad),
        "orders_loaded": F.count_if(~bad),
        "orders_paid": F.count_if(~bad & (F.col("payment_status") == PAID)),
    }
    found: dict[str, int] = {}
    for frame, metrics in ((landed, heads), (lines, M.line_metrics())):
        found |= frame.agg(*[m.alias(k) for k, m in metrics.items()]).first().asDict()
    return found | {"lines_good": good.count(), "lines_kept": kept.count(), "orders_enriched": enriched.count()}


def run_month(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    year: int,
    month: int,
    layout: str = "daily_files",
    grain: str = "line",
    keep_empty: bool = False,
    null_policy: str = "drop",
    sep: str = CSV_SEP,
    encoding: str = CSV_ENCODING,
    float_format: str = CSV_FLOAT_FORMAT,
    warehouse: str | None = None,
    replace_empty: bool = False,
    side_dir: str | None = None,
) -> dict[str, int]:
    """Run the job for one month; returns the quality counters.

    ``input_dir`` holds the order files; customers.csv and refunds.csv
    are read from ``side_dir`` (default: the same folder)."""
    input_dir = input_dir.rstrip("/")
    side_dir = (side_dir or input_dir).rstrip("/")
    run = _run_folder(spark, input_dir, side_dir, year, month, out_dir, warehouse, layout, grain, keep_empty, null_policy)
    warehouse = warehouse or f"{out_dir}/tables"

    # 1. land the month (one JSON parse)
    raw = _step(spark, f"{run}/docs", lambda: SRC.read_orders_month(spark, input_dir, year, month, layout=layout))
    landed = _salvaged(raw, input_dir, f"{run}/salvaged")
    docs, quarantine = SRC.split_corrupt(landed)

    # 2. quarantine
    K.write_table(quarantine, f"{out_dir}/quarantine", replace_empty=replace_empty)

    # 3. paid, normalized lines
    paid = L.paid_only(docs)
    if grain == "order":
        paid = first_documents(paid)
    lines = _step(spark, f"{run}/lines", lambda: L.item_lines(paid, keep_empty=keep_empty, null_policy=null_policy))

    customers = SRC.read_customers_raw(spark, f"{side_dir}/{CUSTOMERS_FILE}")
    refunds = SRC.read_refunds_raw(spark, f"{side_dir}/{REFUNDS_FILE}")
    frames = from_lines(lines, customers, refunds, grain=grain, normalized=True, sort=False)

    # 4. rejects
    K.write_rejects(frames.rejects, out_dir, encoding=encoding, replace_empty=replace_empty)

    # 5. enriched per-order rows
    enriched = _step(spark, f"{run}/enriched", lambda: frames.enriched)

    # 6. outputs; the CSV export reads the written report table back
    # instead of aggregating a second time
    K.write_table(S.orders_clean(enriched), f"{warehouse}/{TABLE_ORDERS_CLEAN}", replace_empty)
    report_path = f"{warehouse}/{TABLE_DAILY_SALES}"
    if K.write_table(S.daily_city_sales(enriched, sort=True, orders_unique=(grain == "line")), report_path, replace_empty):
        K.export_daily_csvs(spark.read.parquet(report_path), out_dir, sep, encoding, float_format, replace_empty)

    # 7. counters; then nothing reads the run folder again
    counters = _counters(landed, lines, enriched, grain)
    remove_folder(spark, run)
    return counters
