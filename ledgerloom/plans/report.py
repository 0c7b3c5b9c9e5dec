"""The monthly sales chain as lazily built DataFrames (E1 without sinks).

Nothing here runs an action: each function returns DataFrames whose plan
Catalyst optimizes as a whole (filters pushed into the scans, one
exchange shared by keep-first / per-order / refund join, AQE at run
time). Sinks (``ledgerloom.sinks``) are the only place actions happen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerloom.operators import dedup, lines as L, sales as S
from ledgerloom.operators.skew import HOT_ROWS, hot_keys

GRAINS = ("line", "order", "all")


@dataclass
class SalesFrames:
    lines: DataFrame  # paid, normalized item lines (before the split)
    good: DataFrame  # price >= 0
    rejects: DataFrame  # price < 0 (reject output)
    kept: DataFrame  # lines that enter the per-order sums
    per_order: DataFrame
    enriched: DataFrame  # per-order + refunds + active customers + order_date
    report: DataFrame  # daily_city_sales
    orders_clean: DataFrame


def line_order(df: DataFrame) -> tuple[str, ...]:
    """Keep-first order of lines: created_at, then file, then position."""
    return tuple(c for c in ("created_at", "source_file", "item_pos") if c in df.columns)


def from_lines(
    lines: DataFrame,
    customers_raw: DataFrame,
    refunds_raw: DataFrame,
    grain: str = "line",
    null_policy: str = "drop",
    sort: bool = True,
    normalized: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> SalesFrames:
    """Chain from exploded lines (which still carry ``payment_status``).

    ``grain='line'`` keeps the first good line per order (reference
    behaviour); ``'order'``/``'all'`` keep every good line (documents are
    de-duplicated before explode by ``from_documents`` for 'order').
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    paid = L.paid_only(lines)
    if not normalized:
        paid = L.apply_null_policy(L.normalize_items(paid), null_policy)
    good, rejects = L.split_rejects(paid)
    kept = dedup.keep_first(good, "order_id", line_order(good)) if grain == "line" else good
    # without keep-first and without keyed heads, one order_id may own many
    # per-order rows (copies of a document with other times/channels)
    order_source = kept if grain == "all" else None
    return _finish(paid, good, rejects, kept, customers_raw, refunds_raw, grain, sort, good, hot_rows, order_source)


def _finish(
    paid, good, rejects, kept, customers_raw, refunds_raw, grain, sort, hot_source, hot_rows, order_source=None
) -> SalesFrames:
    """Shared tail of the chain. ``hot_source`` has at least as many rows
    per customer as the per-order frame (an upper bound), so counting it
    finds every hot customer without recomputing per-order; likewise
    ``order_source`` for order ids, when those can repeat."""
    po = S.per_order(kept)
    salt_rows = max(1, hot_rows // 4) if hot_rows else None
    hot = hot_keys(hot_source, "customer_id", hot_rows, salt_rows) if hot_rows else None
    hot_orders = hot_keys(order_source, "order_id", hot_rows, salt_rows) if hot_rows and order_source is not None else None
    enriched = S.enrich(po, S.type_customers(customers_raw), S.refunds_per_order(refunds_raw), hot, hot_orders)
    return SalesFrames(
        lines=paid,
        good=good,
        rejects=rejects,
        kept=kept,
        per_order=po,
        enriched=enriched,
        # at line grain keep-first leaves one row per order_id all the way
        # through per-order and both (key-unique) joins
        report=S.daily_city_sales(enriched, sort=sort, orders_unique=(grain == "line")),
        orders_clean=S.orders_clean(enriched),
    )


def from_keyed_tables(
    heads: DataFrame,
    items: DataFrame,
    customers_raw: DataFrame,
    refunds_raw: DataFrame,
    grain: str = "line",
    null_policy: str = "drop",
    sort: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> SalesFrames:
    """Chain from order heads keyed by ``order_id`` plus flat item rows.

    Precondition: ``heads`` has at most one row per order_id (a keyed
    table such as ``orders``). Then every line of an order carries the
    same head fields, so the keep-first order (created_at, position,
    head fields, item fields) reduces to (position, item fields) and
    keep-first can run on the item side *before* the join: its partial
    top-1 cuts the item rows to about one per order and map task before
    the shuffle, and the head join then reuses that order_id
    partitioning. The paid filter is pushed to the heads, the price
    split to the items. Results equal ``from_lines(items JOIN heads)``.
    """
    paid, good, rejects, kept = keyed_lines(heads, items, grain, null_policy)
    return _finish(
        paid, good, rejects, kept, customers_raw, refunds_raw, grain, sort, L.paid_only(heads), hot_rows
    )


def keyed_lines(
    heads: DataFrame, items: DataFrame, grain: str = "line", null_policy: str = "drop"
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(paid lines, good, rejects, kept) for heads keyed by order_id; see
    ``from_keyed_tables``."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    lines = L.apply_null_policy(L.normalize_items(items), null_policy)
    good_items, reject_items = L.split_rejects(lines)
    paid_heads = L.paid_only(heads)
    kept_items = dedup.keep_first(good_items, "order_id", ("item_pos",)) if grain == "line" else good_items
    return tuple(f.join(paid_heads, "order_id") for f in (lines, good_items, reject_items, kept_items))


def first_documents(docs: DataFrame) -> DataFrame:
    """W1 at document grain: first document per order_id (created_at,
    then source file, then content)."""
    order = tuple(c for c in ("created_at", "source_file") if c in docs.columns)
    return dedup.keep_first(docs, "order_id", order)


def from_documents(
    docs: DataFrame,
    customers_raw: DataFrame,
    refunds_raw: DataFrame,
    grain: str = "line",
    keep_empty: bool = False,
    null_policy: str = "drop",
    sort: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> SalesFrames:
    """Chain from nested order documents: P1 on documents (before explode,
    so unpaid documents are never exploded), optional document-grain
    keep-first, explode + normalize, then ``from_lines``."""
    paid = L.paid_only(docs)
    if grain == "order":
        paid = first_documents(paid)
    lines = L.item_lines(paid, keep_empty=keep_empty, null_policy=null_policy)
    return from_lines(lines, customers_raw, refunds_raw, grain=grain, sort=sort, normalized=True, hot_rows=hot_rows)
