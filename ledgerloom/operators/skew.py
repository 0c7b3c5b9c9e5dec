"""Hot-key handling for fact x dimension joins.

A dimension keyed join (one dimension row per key) sends every fact row
of a key to one task. When one key holds a large share of the facts
(a third of all orders for one customer, say), that task carries it
alone. ``salted_join`` spreads such keys:

1. ``hot_keys``: exact row count per key over the facts (partial
   aggregation, so only (key, count) pairs are shuffled); a key with at
   least ``min_rows`` rows is hot and gets ``ceil(rows / salt_rows)``
   salts. The set holds the ``MOST_HOT`` largest such keys at most -- a
   bound that does not grow with the data, so it may be broadcast. A key
   beyond it has at most ``rows / MOST_HOT`` rows and joins unsalted.
2. Fact rows of a hot key get a deterministic salt in [0, salts) from a
   hash of their own columns (stable under task retries); other rows
   get salt 0. Rows without a key match nothing, so that hash itself is
   their salt: a left join does not gather them in one task.
3. The dimension row of a hot key is repeated once per salt; in total
   at most ``rows / salt_rows`` extra rows. Other rows appear once, with
   salt 0.
4. Join on (key, salt): a hot key is split into pieces of about
   ``salt_rows`` fact rows however large it is, and every fact row still
   meets exactly its one dimension row. No row is dropped or sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed defaults: a key is hot from HOT_ROWS fact rows; a hot key is cut
# into pieces of about SALT_ROWS fact rows.
HOT_ROWS = 1_000_000
SALT_ROWS = 250_000
MOST_HOT = 100_000


def hot_keys(facts: DataFrame, key: str, min_rows: int = HOT_ROWS, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(key, _salts) for keys with at least ``min_rows`` rows; of those the
    ``MOST_HOT`` largest at most (a partial top-k, no sort of all keys)."""
    return (
        facts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .orderBy(F.desc("_rows"), key)
        .limit(MOST_HOT)
        .select(key, F.ceil(F.col("_rows") / F.lit(salt_rows)).cast("long").alias("_salts"))
    )


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    hot: DataFrame,
    salt_by: Sequence[str],
    how: str = "inner",
    prepare_dim: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> DataFrame:
    """``facts JOIN dim USING (key)`` with hot keys spread by salt.
    ``dim`` must hold at most one row per key -- or ``prepare_dim`` makes
    it so: it receives the salted dimension and the partition keys
    ``[key, '_salt']`` (e.g. to de-duplicate and filter), so that work is
    done on the join's own partitioning and the dimension moves once.
    ``hot`` comes from ``hot_keys`` (bounded); ``salt_by`` are fact columns
    whose hash picks the salt (e.g. the fact's own id)."""
    flag = F.broadcast(hot.select(key, "_salts"))
    own = F.xxhash64(*[F.col(c) for c in salt_by])
    salt = F.when(F.col(key).isNull(), own).when(F.col("_salts").isNotNull(), F.pmod(own, F.col("_salts")))
    f = facts.join(flag, key, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("long")).drop("_salts")
    copies = F.when(
        F.col("_salts").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
    ).otherwise(F.array(F.lit(0).cast("long")))
    d = dim.join(flag, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    if prepare_dim is not None:
        d = prepare_dim(d, [key, "_salt"])
    return f.join(d, [key, "_salt"], how).drop("_salt")
