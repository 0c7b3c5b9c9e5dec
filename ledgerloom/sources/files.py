"""File sources of the order model.

* CSV with a header, declared all-string schema, columns by name in each
  part file (S1); a missing file is a typed empty frame, not an error (S2).
* Order documents as JSON, one scan per month with a declared schema
  (S3/S4): either the reference's flat layout of day files
  ``orders_YYYY-MM-DD.json`` (multi-line arrays; the day is validated
  from ``_metadata.file_name``) or a month-partitioned directory
  ``order_month=YYYY-MM/`` that daily files are appended to (JSON lines,
  splittable; a month is one partition directory, listed alone).
* Malformed input never fails the read. ``_corrupt_record`` holds the
  line that does not parse, the items text of a document whose items are
  no array, or the byte length of a multi-line file that does not parse;
  ``split_corrupt`` routes those rows to a quarantine frame (S5). A
  zero-byte file yields no row.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.scalar import month_day_names
from ledgerloom.schemas import (
    CORRUPT_COLUMN,
    CUSTOMERS_RAW,
    ORDER_DOC,
    ORDERS_FILE_PREFIX,
    REFUNDS_RAW,
)
from ledgerloom.sources.unify import aligned, clash

LAYOUTS = ("daily_files", "month_partitions")
MONTH_PARTITION = "order_month"
UNREADABLE = "unreadable file, bytes: "  # then its length


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    code = cond() if cond else None
    return code == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed frame with no rows."""
    return spark.createDataFrame([], schema)


def _header_groups(spark: SparkSession, path: str, sep: str, encoding: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of the CSV files under a path, files of one
    header together. Only names and headers (one line a file) reach the
    driver; a single file needs no pass."""
    text = spark.read.option("encoding", encoding).text(path)
    files = text.inputFiles()
    if len(files) < 2:
        return []
    lines = text.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("nth"))
    heads = lines.groupBy("file").agg(F.min_by("value", "nth").alias("head"))
    groups: dict[str, list[str]] = {}
    for row in heads.collect():
        groups.setdefault(row["head"].strip("\ufeff"), []).append(unquote(row["file"]))
    names = lambda head: next(csv.reader([head], delimiter=sep))
    return [(names(head), sorted(own)) for head, own in sorted(groups.items())]


def _by_name(found: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of ``found``, names matched without case."""
    own: dict[str, str] = {}
    for c in found.columns:
        own.setdefault(c.strip("\ufeff \t").lower(), c)
    columns = [F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None) for f in schema.fields]
    return found.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, schema.fields)])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    sep: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = True,
) -> DataFrame:
    """CSV (file or directory of part files) as the declared
    columns. With a header they are taken by name, without case: other
    columns are ignored, absent ones are null, and every part file may
    have an order of its own. Without one the schema is positional. A
    quoted field may hold line breaks (``multi_line``; a file is then read
    by one task -- part files are the unit of parallel reads). A missing
    path gives a typed empty frame."""
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    try:
        if not header:
            return reader.schema(schema).csv(path)
        groups = _header_groups(spark, path, sep, encoding)
        if len(groups) < 2:
            return _by_name(reader.csv(path), schema)
        # one positional scan per distinct header, then by name
        frames = []
        for names, files in groups:
            fields = [StructField(f"c{k}", StringType()) for k in range(len(names))]
            own = reader.schema(StructType(fields)).option("enforceSchema", True).csv(files)
            seen: set[str] = set()
            plain = [n.strip("\ufeff \t").lower() for n in names]
            keep = [k for k, n in enumerate(plain) if not (n in seen or seen.add(n))]
            frames.append(_by_name(own.select(*[F.col(f"c{k}").alias(plain[k] or f"_c{k}") for k in keep]), schema))
        return union_by_name(*frames)
    except AnalysisException as e:
        if _is_missing_path(e):
            return empty_frame(spark, schema)
        raise


def read_customers_raw(spark: SparkSession, path: str) -> DataFrame:
    """customers.csv: customer_id, city, is_active as text."""
    return read_csv(spark, path, CUSTOMERS_RAW)


def read_refunds_raw(spark: SparkSession, path: str) -> DataFrame:
    """refunds.csv: order_id, amount (text), created_at."""
    return read_csv(spark, path, REFUNDS_RAW)


def read_orders_month(
    spark: SparkSession,
    input_dir: str,
    year: int,
    month: int,
    layout: str = "daily_files",
    multi_line: bool | None = None,
) -> DataFrame:
    """Every order document of one month, in one scan.

    Returns the document columns plus ``source_file`` (file name, the
    keep-first tie-break) and ``_corrupt_record``. Days absent from the
    input are simply not there; nothing is listed on the driver.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if multi_line is None:
        multi_line = layout == "daily_files"
    # items stay text at first, so that one document of another shape does
    # not fail the array that a whole day file is; a multi-line file that
    # does not parse is one all-null row, and its text is not kept
    as_text = [StructField(f.name, StringType()) for f in ORDER_DOC.fields if f.name != CORRUPT_COLUMN or not multi_line]
    reader = (
        spark.read.schema(StructType(as_text))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    try:
        if layout == "daily_files":
            glob = f"{ORDERS_FILE_PREFIX}{year:04d}-{month:02d}-*.json"
            valid = [f"{ORDERS_FILE_PREFIX}{d}.json" for d in month_day_names(year, month)]
            df = reader.json(f"{input_dir.rstrip('/')}/{glob}")
            return _documents(df, multi_line).where(F.col("source_file").isin(valid))
        # list only this month's partition directory, not every month the
        # input holds; as with day files, where a document is filed decides
        # its month (not its created_at text)
        month_dir = f"{input_dir.rstrip('/')}/{MONTH_PARTITION}={year:04d}-{month:02d}"
        df = reader.option("basePath", input_dir).json(month_dir)
        return _documents(df, multi_line)
    except AnalysisException as e:
        if _is_missing_path(e):
            return empty_frame(spark, ORDER_DOC).withColumn("source_file", F.lit(None).cast("string"))
        raise


def _documents(df: DataFrame, multi_line: bool) -> DataFrame:
    """The read text fields as typed documents with ``source_file`` and
    ``_corrupt_record``: the items text when it is no array of objects, the
    line that did not parse, or the length of the file that did not."""
    fields = [f.name for f in ORDER_DOC.fields if f.name != CORRUPT_COLUMN]
    items = F.from_json(F.col("items"), ORDER_DOC["items"].dataType)
    if multi_line:
        size = F.col("_metadata.file_size").cast("string")
        whole = F.when(F.coalesce(*fields).isNull(), F.concat(F.lit(UNREADABLE), size))
    else:
        whole = F.col(CORRUPT_COLUMN)
    wrong = F.when(F.col("items").isNotNull() & items.isNull(), F.col("items"))
    rest = [c for c in df.columns if c not in (*fields, CORRUPT_COLUMN)]
    return df.select(
        *[items.alias(c) if c == "items" else F.col(c) for c in fields],
        F.coalesce(whole, wrong).alias(CORRUPT_COLUMN),
        *rest,
        F.col("_metadata.file_name").alias("source_file"),
    )


def split_corrupt(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean documents, quarantine rows). A malformed record has its
    text in ``_corrupt_record`` and null fields; it never reaches the
    sums. Both frames keep a real column next to the corrupt text, so the
    JSON source never has to answer a query on that column alone."""
    if CORRUPT_COLUMN not in docs.columns:
        return docs, docs.where(F.lit(False))
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    clean = docs.where(~bad).drop(CORRUPT_COLUMN)
    quarantine = docs.where(bad).select("source_file", "order_id", CORRUPT_COLUMN)
    return clean, quarantine


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing on one side is null
    there; duplicates are kept. Where frames hold a column under different
    types, all take the common one first (``unify``)."""
    if clash(*frames):
        frames = aligned(*frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: StructType | str | None = None) -> DataFrame:
    """A frame from driver-side Python rows (tests and small
    hand-made inputs only), schema inferred or declared."""
    return spark.createDataFrame(rows, schema) if schema is not None else spark.createDataFrame(rows)
