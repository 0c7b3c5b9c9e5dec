"""Keep-first per key (W1, O2, O3, P11) and unique dimension rows.

``row_number() over (partition by key order by ...) = 1`` is planned by
Catalyst as a *partial* WindowGroupLimit before the exchange and a final
one after it: every map task forwards at most one row per key, so a hot
key (even one third of all rows, or the null key) is cut down before the
shuffle and never gathered whole into one task.

The order is total: ``created_at`` (nulls last), then the given position
columns, then every remaining column. The surviving row is therefore the
same for any partitioning and any shuffle-partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    key: str | Sequence[str] = "order_id",
    order_by: Sequence[str] = ("created_at",),
    rank_col: str = "_rn",
    prefer: str | None = None,
) -> DataFrame:
    """First row per ``key`` (one column or several) by ``order_by`` then
    all other columns, all ascending with nulls last; rows where the
    boolean ``prefer`` is true come before all others."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [c for c in order_by if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [prefer] if c in df.columns],
        *[F.col(c).asc_nulls_last() for c in order + rest],
    )
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def unique_by_key(df: DataFrame, key: str | Sequence[str], prefer: str | None = None) -> DataFrame:
    """One row per key, chosen deterministically by content; a row
    where the boolean ``prefer`` is true wins."""
    return keep_first(df, key=key, order_by=(), prefer=prefer)
