"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import work_path

# The white space of every word rule in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Hot keys of a join: rows per salt, and most keys of the broadcast set.
SALT_ROWS = 2_000
MOST_HOT = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared work folder and read
    back: cuts the lineage, survives lost executors, fixes every value
    that later jobs rely on. Nothing reads the write's shuffles again, so
    Spark removes their files when it ends, not when the driver happens to
    collect its garbage."""
    spark = df.sparkSession
    path = work_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sizes them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def pick_rows(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is in ``keys`` (one column, named
    ``key``, distinct); of repeated rows with one key, one."""
    name = fresh(docs, "_key")
    kept = keys.select(F.col("key").alias(name))
    hit = docs.withColumn(name, key).alias("d").join(kept.alias("k"), F.expr(f"d.{name} <=> k.{name}"), "left_semi")
    firsts = [F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns]
    return hit.groupBy(name).agg(*firsts).select(*[F.col(f"`{c}`") for c in docs.columns])


def spread(facts: DataFrame, dim: DataFrame, key: str, by: list[str], counts: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with a column ``salt`` to join on as
    well: rows of a hot key are dealt over salts by the hash of ``by``, and
    its partner rows repeated once per salt. ``counts`` has (key, many),
    the facts per key, and ``total`` is at least the number of facts. A key
    is hot from SALT_ROWS facts, or from more where over MOST_HOT keys
    could be: with total / MOST_HOT as the least, the broadcast set holds
    MOST_HOT keys at most, whatever the data."""
    least = max(SALT_ROWS, -(-total // MOST_HOT))
    hot = counts.where((F.col("many") >= least) & F.col(key).isNotNull())
    hot = F.broadcast(written(hot.select(key, F.ceil(F.col("many") / SALT_ROWS).cast("int").alias("salts")), "hot"))
    dealt = facts.join(hot, key, "left")
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64(*by), F.col("salts"))).otherwise(F.lit(0)).cast("int")
    salts = F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.lit(0)))
    return dealt.withColumn("salt", salt).drop("salts"), dim.join(hot, key, "left").withColumn("salt", F.explode(salts)).drop("salts")


def word_count(text: Column) -> Column:
    """Number of words: white-space runs between non-blank ends, plus one.
    Null and blank texts have none."""
    body = F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")
    gaps = F.regexp_count(body, F.lit(SPACE))
    return F.when(text.isNull() | (body == ""), F.lit(0)).otherwise(gaps + 1).cast("long")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of an Arrow string column; a null is
    empty. No copy of the text is made when nothing is null or sliced."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
