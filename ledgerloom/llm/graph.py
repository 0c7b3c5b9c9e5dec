"""Connected components of an edge table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written


def _to_roots(parents: DataFrame) -> DataFrame:
    """(node, up) with every ``up`` a root: pointer doubling, so rounds
    grow with the log of the longest chain of hooks."""
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("root"))
        # a node that is nobody's child row is its own root
        parents = written(
            parents.join(above, "up", "left").select(
                "node", F.coalesce("root", "up").alias("up"), (F.coalesce("root", "up") != F.col("up")).alias("moved")
            ),
            "hooks",
        )
        if parents.where("moved").isEmpty():
            return parents.drop("moved")
        parents = parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b; longs): the
    smallest node that it reaches. Each round hooks every node to its
    smallest neighbour, follows the hooks to their roots and contracts the
    edges; all tables are written, none is collected. Repeated edges do no
    harm: the first contraction merges them."""
    edges = written(edges.where("a <> b").select("a", "b"), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        roots = _to_roots(written(hooks.select("node", F.least("node", "near").alias("up")), "hooks"))
        if labels is None:
            labels = roots.select("node", F.col("up").alias("label"))
        else:
            moved = roots.select(F.col("node").alias("label"), F.col("up").alias("to"))
            labels = written(
                labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels"
            )
        up = lambda c: roots.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        contracted = edges.join(up("a"), "a").join(up("b"), "b").where("a_up <> b_up")
        edges = written(
            contracted.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "edges"
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
