"""Order documents with every field they hold (P14, P15), element by
element (S5).

``read_orders_month`` reads declared fields only, and one array element
that is no object makes its whole day file unreadable there. Here a
document is a VARIANT first: the text of a day file is parsed once and its
array taken apart by ``variant_explode``, so an element that is no
document goes to quarantine alone; the set of order and item fields is
found in one aggregate over all documents (``schema_of_variant_agg``), or
given by the caller, and becomes columns. Values stay text, as in the
declared read; a nested value is its JSON text.

Names that differ only in letter case are one column (the first non-null
value, names in order), declared names first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalar import month_day_names
from ledgerloom.schemas import CORRUPT_COLUMN, ITEM_RAW, ORDER_DOC, ORDERS_FILE_PREFIX
from ledgerloom.session import list_paths
from ledgerloom.sources.files import MONTH_PARTITION, UNREADABLE

OBJECT = "OBJECT<%"
MAP = "map<string,variant>"
DECLARED = [f.name for f in ORDER_DOC.fields if f.name not in ("items", CORRUPT_COLUMN)]
DECLARED_ITEM = [f.name for f in ITEM_RAW.fields]


@dataclass(frozen=True)
class Fields:
    """Names found in the documents and in their items."""

    order: tuple[str, ...] = ()
    item: tuple[str, ...] = ()


def _day_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(doc, source_file, _corrupt_record): the elements of day files; a
    file that is no JSON is one row without ``doc``."""
    text = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_name").alias("source_file"))
    # a file that is one document counts as an array of it
    array = F.when(F.ltrim("value").startswith("{"), F.concat(F.lit("["), "value", F.lit("]"))).otherwise(F.col("value"))
    parsed = text.select("source_file", F.try_parse_json(array).alias("file"), F.octet_length("value").alias("size"))
    parsed = parsed.withColumn("file", F.when(F.schema_of_variant("file").startswith("ARRAY"), F.col("file")))
    rows = parsed.lateralJoin(spark.tvf.variant_explode_outer(F.col("file").outer()))
    unreadable = F.when(F.col("file").isNull(), F.concat(F.lit(UNREADABLE), F.col("size").cast("string")))
    rows = rows.where("value is not null or (file is null and size > 0)")
    return rows.select(F.col("value").alias("doc"), "source_file", unreadable.alias(CORRUPT_COLUMN))


def _lines(spark: SparkSession, month_dir: str, input_dir: str) -> DataFrame:
    """The same for JSON lines of a month's partition; a line that is no
    JSON is one row without ``doc``."""
    text = spark.read.option("basePath", input_dir).text(month_dir).where(F.trim("value") != "")
    doc = F.try_parse_json("value")
    return text.select(
        doc.alias("doc"),
        F.col("_metadata.file_name").alias("source_file"),
        F.when(doc.isNull(), F.col("value")).alias(CORRUPT_COLUMN),
        MONTH_PARTITION,
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(
        F.try_parse_json(F.lit("0")).alias("doc"), F.lit("").alias("source_file"), F.lit("").alias(CORRUPT_COLUMN)
    )


def day_files(spark: SparkSession, input_dir: str, names: Sequence[str]) -> DataFrame:
    """(doc, source_file, _corrupt_record) of the named day files."""
    paths = [p for n in names for p in list_paths(spark, f"{input_dir.rstrip('/')}/{n}")]
    return _day_elements(spark, paths) if paths else _nothing(spark)


def variant_documents(spark: SparkSession, input_dir: str, year: int, month: int, layout: str = "daily_files") -> DataFrame:
    """(doc VARIANT, source_file, _corrupt_record) of one month."""
    if layout == "daily_files":
        return day_files(spark, input_dir, [f"{ORDERS_FILE_PREFIX}{d}.json" for d in month_day_names(year, month)])
    month_dir = f"{input_dir.rstrip('/')}/{MONTH_PARTITION}={year:04d}-{month:02d}"
    return _lines(spark, month_dir, input_dir) if list_paths(spark, month_dir) else _nothing(spark)


def _object_type(spark: SparkSession, text: str | None) -> StructType | None:
    """The type that ``schema_of_variant_agg`` wrote, if it is an object's."""
    if not text or not text.startswith("OBJECT<"):
        return None
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), text)
    found = spark.range(0).select(F.lit(None).cast(ddl).alias("t")).schema["t"].dataType
    return found if isinstance(found, StructType) else None


def find_fields(docs: DataFrame) -> Fields:
    """Every field name of the documents and of their items: one pass."""
    spark = docs.sparkSession
    of = lambda v: F.when(F.schema_of_variant(v).like(OBJECT), F.col(v))
    items = docs.where("doc is not null").select(of("doc").alias("doc")).withColumn("items", F.try_variant_get("doc", "$.items", "variant"))
    items = items.withColumn("items", F.when(F.schema_of_variant("items").startswith("ARRAY"), F.col("items")))
    each = items.lateralJoin(spark.tvf.variant_explode_outer(F.col("items").outer()))
    # a document is counted with its first item only
    first = F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("doc"))
    each = each.select(first.alias("doc"), of("value").alias("item"))
    got = each.agg(F.schema_of_variant_agg("doc"), F.schema_of_variant_agg("item")).first()
    order, item = (_object_type(spark, t) for t in got)
    return Fields(tuple(order.names) if order else (), tuple(item.names) if item else ())


def _columns(declared: Sequence[str], found: Sequence[str]) -> dict[str, list[str]]:
    """Column name -> the field names it takes."""
    out: dict[str, list[str]] = {n: [n] for n in declared}
    own = {n.lower(): n for n in declared}
    for name in sorted(found):
        kept = own.setdefault(name.lower(), name)
        fields = out.setdefault(kept, [])
        if name not in fields:
            fields.append(name)
    return out


def _text(object_: Column, names: Sequence[str]) -> Column:
    values = [F.try_variant_get(F.try_element_at(object_, F.lit(n)), "$", "string") for n in names]
    return values[0] if len(values) == 1 else F.coalesce(*values)


def typed(docs: DataFrame, fields: Fields = Fields()) -> DataFrame:
    """Documents with the declared columns, then the other order fields;
    ``items`` is an array of structs of all item fields. A row that is no
    document, or whose items are no array of objects, has its text in
    ``_corrupt_record``."""
    rest = [c for c in docs.columns if c not in ("doc", "source_file", CORRUPT_COLUMN)]
    taken = {"items", CORRUPT_COLUMN, "source_file", *rest}
    order = {c: n for c, n in _columns(DECLARED, fields.order).items() if c.lower() not in taken}
    item = _columns(DECLARED_ITEM, fields.item)
    row = docs.select("*", F.try_variant_get("doc", "$", MAP).alias("_order"))
    row = row.withColumn("_items", F.try_element_at("_order", F.lit("items")))
    row = row.withColumn("_array", F.try_variant_get("_items", "$", f"array<{MAP}>"))
    items = F.transform("_array", lambda i: F.struct(*[_text(i, names).alias(c) for c, names in item.items()]))
    absent = F.col("_items").isNull() | (F.schema_of_variant("_items") == "VOID")
    wrong = F.when(F.col("doc").isNotNull() & F.col("_order").isNull(), F.to_json("doc"))
    wrong = F.coalesce(wrong, F.when(~absent & F.col("_array").isNull(), F.to_json("_items")))
    return row.select(
        *[_text(F.col("_order"), names).alias(c) for c, names in order.items() if c in DECLARED],
        items.alias("items"),
        *[_text(F.col("_order"), names).alias(c) for c, names in order.items() if c not in DECLARED],
        F.coalesce(CORRUPT_COLUMN, wrong).alias(CORRUPT_COLUMN),
        *rest,
        "source_file",
    )


def read_open_orders(
    spark: SparkSession,
    input_dir: str,
    year: int,
    month: int,
    layout: str = "daily_files",
    fields: Fields | None = None,
) -> DataFrame:
    """All documents of a month with all their fields. Without ``fields``
    one pass over the month finds them first."""
    docs = variant_documents(spark, input_dir, year, month, layout)
    return typed(docs, find_fields(docs) if fields is None else fields)
