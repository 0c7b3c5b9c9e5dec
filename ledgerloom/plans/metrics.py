"""Data-quality counters (M1-M4, A4).

The monthly job counts its written tables (``month_job``). ``observed``
attaches ``Observation`` metrics to a frame that is consumed anyway; a
retried task may count twice there. For reporting as data,
``counters_frame`` returns the same counters as a (metric, value) table
built from global aggregates (partial count per task, one tiny final).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics to ``df``; read them with
    ``obs.get`` after the first action that consumes the returned frame."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def rows_count() -> Column:
    return F.count(F.lit(1))


def line_metrics(price: str = "item_unit_price") -> dict[str, Column]:
    p = F.col(price)
    return {
        "lines_paid": rows_count(),
        "lines_rejected": F.count_if(p < 0),
        "lines_null_price": F.count_if(p.isNull()),
    }


def _counts(df: DataFrame, **metrics: Column) -> DataFrame:
    """(metric, value) rows from one aggregate over ``df``."""
    return df.agg(*[m.cast("long").alias(k) for k, m in metrics.items()]).unpivot([], list(metrics), "metric", "value")


def counters_frame(
    docs: DataFrame,
    paid_docs: DataFrame,
    lines: DataFrame,
    kept: DataFrame,
) -> DataFrame:
    """(metric, value): orders loaded, paid orders (before de-duplication),
    paid lines, rejected lines (price < 0), lines with no price, lines
    kept by keep-first. One aggregate a frame."""
    return (
        _counts(docs, orders_loaded=rows_count())
        .unionByName(_counts(paid_docs, orders_paid=rows_count()))
        .unionByName(_counts(lines, **line_metrics()))
        .unionByName(_counts(kept, lines_kept=rows_count()))
    )
