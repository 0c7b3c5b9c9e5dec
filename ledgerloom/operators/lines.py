"""From order documents to item lines.

``explode`` is a narrow operator (no shuffle): each document becomes its
lines inside the same task, and the item struct is flattened by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ledgerloom.functions.scalar import first_present, safe_number
from ledgerloom.schemas import NUM, PAID, PRICE_FIELDS, QTY_FIELDS

LINE_KEYS = ["order_id", "customer_id", "channel", "created_at"]


def paid_only(docs: DataFrame) -> DataFrame:
    """Keep documents whose ``payment_status`` is exactly 'paid'
    (null or other case is dropped)."""
    return docs.where(F.col("payment_status") == PAID)


def explode_items(docs: DataFrame, keep_empty: bool = False, items: str = "items") -> DataFrame:
    """X1/X2/X3 + P14/P15: one row per item.

    All document columns except ``items`` are kept, ``item_pos`` is the
    0-based position in the array, and every field of the item struct
    becomes ``item_<field>`` (nested structs flatten with '_' joins).
    ``keep_empty=False``: a null/empty array gives no row (X1);
    ``keep_empty=True``: it gives one row with null item fields (X2).
    """
    gen = F.posexplode_outer if keep_empty else F.posexplode
    others = [c for c in docs.columns if c != items]
    exploded = docs.select(*others, gen(F.col(items)).alias("item_pos", "_item"))
    item_type = docs.schema[items].dataType
    assert isinstance(item_type, ArrayType), f"{items} must be an array"
    flat = _flatten("_item", "item", item_type.elementType)
    return exploded.select(*others, "item_pos", *flat)


def _flatten(path: str, prefix: str, dtype) -> list:
    if not isinstance(dtype, StructType):
        return [F.col(path).alias(prefix)]
    out = []
    for f in dtype.fields:
        out.extend(_flatten(f"{path}.`{f.name}`", f"{prefix}_{f.name}", f.dataType))
    return out


def normalize_items(lines: DataFrame) -> DataFrame:
    """``item_qty`` and ``item_unit_price`` as exact numbers.

    Alternative field names are coalesced per row (preferred first);
    bad numeric text becomes null. Other order columns are kept, the
    alternative raw columns are dropped."""
    qty_cols = [f"item_{n}" for n in QTY_FIELDS if f"item_{n}" in lines.columns]
    price_cols = [f"item_{n}" for n in PRICE_FIELDS if f"item_{n}" in lines.columns]
    qty = safe_number(first_present(*qty_cols)) if qty_cols else F.lit(None).cast(NUM)
    price = safe_number(first_present(*price_cols)) if price_cols else F.lit(None).cast(NUM)
    drop = set(qty_cols) | set(price_cols)
    keep = [c for c in lines.columns if c not in drop]
    return lines.select(*keep, qty.alias("item_qty"), price.alias("item_unit_price"))


def apply_null_policy(lines: DataFrame, null_policy: str = "drop") -> DataFrame:
    """With ``null_policy='zero'`` a missing quantity or price
    counts as 0 (the line is kept); with 'drop' nulls stay null, so a
    null-price line satisfies neither side of the reject split."""
    if null_policy == "drop":
        return lines
    if null_policy != "zero":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    zero = F.lit(0).cast(NUM)
    return lines.withColumn("item_qty", F.coalesce("item_qty", zero)).withColumn(
        "item_unit_price", F.coalesce("item_unit_price", zero)
    )


def split_rejects(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) -- price >= 0 is good, price < 0 is a reject.
    Both are filters over the same input; a null price is in neither."""
    price = F.col("item_unit_price")
    return lines.where(price >= 0), lines.where(price < 0)


def item_lines(docs: DataFrame, keep_empty: bool = False, null_policy: str = "drop") -> DataFrame:
    """Documents -> normalized item lines (explode + F5/F6 + null policy)."""
    return apply_null_policy(normalize_items(explode_items(docs, keep_empty)), null_policy)
