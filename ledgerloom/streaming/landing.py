"""Incremental landing of daily order files (Structured Streaming).

The same file source as the batch job, run as a stream over the
month-partitioned JSON-lines folder: each new file (a day's orders are
appended to their month directory) is parsed once and appended to a
Parquet table partitioned by ``order_month`` (the access pattern of the
monthly job: one month is one partition of few, large files). Malformed records are landed too, with their raw text
in ``_corrupt_record``, so the quarantine is a filter on the same table
and every file is parsed exactly once. The file sink's commit log makes
the output exactly-once across restarts and task retries;
``availableNow`` processes what is there and stops, so the same code
also serves as a catch-up batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.schemas import CORRUPT_COLUMN, ORDER_DOC
from ledgerloom.sources.files import MONTH_PARTITION

STREAM_SCHEMA = StructType(ORDER_DOC.fields + [StructField(MONTH_PARTITION, StringType())])


def order_stream(spark: SparkSession, source_dir: str, multi_line: bool = False, max_files: int = 1000) -> DataFrame:
    """Streaming read of a month-partitioned order directory."""
    return (
        spark.readStream.schema(STREAM_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("maxFilesPerTrigger", max_files)
        .json(source_dir)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def land_orders(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    multi_line: bool = False,
) -> int:
    """Run the landing stream to completion (``availableNow``); returns the
    number of input rows processed in this run (0 when nothing is new)."""
    q = (
        order_stream(spark, source_dir, multi_line)
        .writeStream.format("parquet")
        .partitionBy(MONTH_PARTITION)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(target_dir)
    )
    # Spark keeps the last updates only, so they are gathered while it runs
    rows: dict[int, int] = {}
    ended = False
    while not ended:
        ended = q.awaitTermination(1)
        rows.update({int(p["batchId"]): int(p.get("numInputRows", 0)) for p in q.recentProgress})
    return sum(rows.values())


def landed_clean(landed: DataFrame) -> DataFrame:
    """Documents of the landed table that parsed."""
    return landed.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def landed_quarantine(landed: DataFrame) -> DataFrame:
    """Records of the landed table that did not parse."""
    return landed.where(F.col(CORRUPT_COLUMN).isNotNull()).select("source_file", MONTH_PARTITION, CORRUPT_COLUMN)
