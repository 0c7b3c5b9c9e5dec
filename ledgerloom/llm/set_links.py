"""Links between shingle sets by prefix lists with set-relation skipping.

Shingles are ordered by how many sets hold them, rare ones first. Two sets
that are similar enough share a shingle within their prefixes, so a list
of (set, position) per prefix shingle finds every link:

* Position blocks. Entries of a list are grouped by size class and
  position class; a block is summed up by its sizes, the most shingles
  that can follow and its labels. Block pairs that cannot hold a link
  (sizes, positions, or one and the same component) are skipped whole.
* Answers of a similar set. Each list has a leader, the member with the
  fewest rare shingles: its overlap with every member is computed, which
  is linear, and merges groups of copies. The others' answers follow from
  it: two known overlaps with the leader bound the overlap of two members
  from above (skip) and below (link, without reading sets). Where that
  leaves it open and one of the two is linked to the leader, the overlap
  is the leader's, less the shingles which that member lacks and plus
  those it adds: only differences are compared. Any other pair is
  compared in full.

Pairs within one component are never formed. All bounds are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import spread, written
from ledgerloom.llm.graph import components

# A list with more members than this outside its leader's links gets
# another leader among them, for LEADERS rounds at most.
LEADER_ROWS = 64
LEADERS = 4


def linked(percent: int, both: Column, m: Column, n: Column) -> Column:
    """100 * intersection >= percent * union."""
    return (100 + percent) * both >= percent * (m + n)


def labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return nodes.withColumn("label", F.col("node"))
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def overlaps(pairs: DataFrame, sets: DataFrame, percent: int, apart: bool = False) -> DataFrame:
    """(a, b, both, m, n) of the written pairs (a, b): intersection and
    sizes of the full sets. With ``apart`` also, for linked pairs, the
    shingles that b lacks and those that it adds."""
    facts = pairs.join(sets.select(F.col("node").alias("b"), F.col("n"), F.col("shingles").alias("b_set")), "b")
    owners = sets.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("shingles").alias("a_set"))
    facts, owners = spread(facts, owners, "a", ["b"], pairs.groupBy("a").agg(F.count(F.lit(1)).alias("many")), pairs.count())
    joined = facts.join(owners, ["a", "salt"]).withColumn("both", F.size(F.array_intersect("a_set", "b_set")).cast("long"))
    more = []
    if apart:
        near = linked(percent, F.col("both"), F.col("m"), F.col("n"))
        more = [F.when(near, F.array_except("a_set", "b_set")).alias("lacks"), F.when(near, F.array_except("b_set", "a_set")).alias("adds")]
    return joined.select("a", "b", "both", "m", "n", *more)


def prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """(s, node, n, pos, indexed): the entries of every set's prefix, for
    sets that can have a link. ``indexed`` entries are in the shorter
    prefix that is enough for the smaller set of a pair."""
    each = sets.select("node", F.explode("shingles").alias("s"))
    times = written(each.groupBy("s").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "times")
    total = sets.agg(F.sum("n")).first()[0] or 0
    facts, dim = spread(each, times, "s", ["node"], times, total)
    shared = facts.join(dim, ["s", "salt"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("many", "s"))).alias("shared"))
    n, alone = F.col("n"), F.col("n") - F.size("shared")
    probe = n - F.expr(f"({percent} * n + 99) div 100") + 1
    index = n - F.expr(f"({2 * percent} * n + {99 + percent}) div {100 + percent}") + 1
    heads = sets.select("node", "n").join(shared, "node").select("node", "n", alone.alias("alone"), probe.alias("probe"), index.alias("index"), "shared")
    heads = heads.where("alone < probe").withColumn("shared", F.slice("shared", 1, F.greatest(F.lit(0), F.col("probe") - F.col("alone")).cast("int")))
    entry = heads.select("node", "n", "alone", "index", F.posexplode("shared").alias("k", "item"))
    pos = F.col("alone") + F.col("k")
    return entry.select("item.s", "node", "n", pos.alias("pos"), (pos < F.col("index")).alias("indexed"))


def _by_list(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """``entries`` with the columns of their list (``lists``, written, with
    its number of entries ``many``)."""
    total = lists.agg(F.sum("many")).first()[0] or 0
    facts, dim = spread(entries, lists, "s", ["node"], lists, total)
    return facts.join(dim, ["s", "salt"]).drop("salt", "many")


def _lead(entries: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(entries with their list's leader ``p`` and their ``both`` with it,
    the leaders' answers), for lists of several entries."""
    lists = entries.groupBy("s").agg(F.min(F.struct("pos", "node")).alias("top"), F.count(F.lit(1)).alias("many"))
    lists = written(lists.where("many > 1").select("s", F.col("top.node").alias("p"), "many"), "lists")
    spokes = written(_by_list(entries, lists), "spokes")
    pairs = written(spokes.where("p <> node").select(F.col("p").alias("a"), F.col("node").alias("b")).distinct(), "star")
    answers = written(overlaps(pairs, sets, percent, apart=True), "answers")
    return spokes, answers


def _cross_pairs(left: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of unlike labels that a list finds and no bound rules
    out, with ``sure`` (the lower bound links them) and ``via``: the
    leader's answer they can be derived from."""
    size = F.floor(F.log(F.col("n").cast("double")) * 20).cast("int")
    left = left.select("*", size.alias("c"), F.expr("(16 * pos) div n").cast("int").alias("q"))
    blocks = left.groupBy("s", "done", "c", "q").agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max(F.col("n") - F.col("pos")).alias("rest"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.max("indexed").alias("indexed"),
    )
    blocks = written(blocks, "blocks")
    meet = F.expr(
        f"x.s = y.s and y.indexed and y.least <= x.most and 100 * y.most >= {percent} * x.least"
        f" and {100 + percent} * least(x.rest, y.rest) >= {percent} * (x.least + y.least)"
        " and not (x.low = x.high and y.low = y.high and x.low = y.low)"
    )
    key = ["s", "done", "c", "q"]
    both = blocks.alias("x").join(blocks.alias("y"), meet)
    both = both.select(*[F.col(f"x.{k}").alias(k) for k in key], *[F.col(f"y.{k}").alias(f"y_{k}") for k in key[1:]])
    x = left.join(both, key).alias("x")
    y = left.where("indexed").alias("y")
    alpha = f"{percent} * (x.n + y.n)"
    found = x.join(
        y,
        F.expr(
            "x.s = y.s and x.y_done = y.done and x.y_c = y.c and x.y_q = y.q and x.label <> y.label"
            " and x.node <> x.p and y.node <> y.p"
            f" and (y.n < x.n or (y.n = x.n and y.node < x.node)) and 100 * y.n >= {percent} * x.n"
            f" and {100 + percent} * least(x.n - x.pos, y.n - y.pos) >= {alpha}"
            f" and {100 + percent} * (least(x.both, y.both) + least(x.n - x.both, y.n - y.both)) >= {alpha}"
        ),
    )
    via = "named_struct('p', x.p, 'base', {0}.node, 'other', {1}.node, 'both', {1}.both)"
    return (
        found.select(
            F.expr("least(x.node, y.node)").alias("a"),
            F.expr("greatest(x.node, y.node)").alias("b"),
            F.expr(f"{100 + percent} * (x.both + y.both - x.m) >= {alpha}").alias("sure"),
            F.expr(f"case when y.done then {via.format('y', 'x')} when x.done then {via.format('x', 'y')} end").alias("via"),
        )
        .groupBy("a", "b")
        .agg(F.max("sure").alias("sure"), F.max("via").alias("via"))
    )


def _derived(pairs: DataFrame, answers: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among pairs whose overlap follows from a leader's."""
    known = answers.select(F.col("a").alias("p"), F.col("b").alias("base"), F.col("n").alias("base_n"), "lacks", "adds")
    asked = pairs.select("a", "b", "via.p", "via.base", "via.other", "via.both").join(known, ["p", "base"])
    asked = asked.join(sets.select(F.col("node").alias("other"), "n", "shingles"), "other")
    overlap = F.col("both") - F.size(F.array_intersect("shingles", "lacks")) + F.size(F.array_intersect("shingles", "adds"))
    return asked.where(linked(percent, overlap, F.col("n"), F.col("base_n"))).select("a", "b")


def link(sets: DataFrame, percent: int, links: DataFrame | None = None, close: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """(node, label) of the linked sets, or None where there are none.
    ``sets`` is the written (node, n, shingles), unlike in content.
    ``links`` (a, b) are known before; ``close`` may drop pairs (a, b)
    that a cheaper exact-enough test rules out before sets are read."""
    entries = written(prefix_lists(sets, percent), "entries")
    spokes, answers = _lead(entries, sets, percent)
    near = linked(percent, F.col("both"), F.col("m"), F.col("n"))
    known = answers.select(F.col("a").alias("p"), F.col("b").alias("node"), "both", "m", near.alias("done"))
    # the leader itself: its own overlap is its size
    own = spokes.join(known, ["p", "node"], "left").withColumns(
        {
            "both": F.coalesce("both", "n"),
            "m": F.coalesce("m", "n"),
            "done": F.coalesce("done", F.lit(True)),
        }
    )
    left = written(own, "led")
    found = [answers.where(near).select("a", "b")] + ([links.select("a", "b")] if links is not None else [])
    open_ = left.where("not done").select("s", "node", "n", "pos", "indexed")
    for _ in range(LEADERS - 1):
        large = open_.groupBy("s").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > LEADER_ROWS)
        large = written(large, "large")
        if large.isEmpty():
            break
        again, more = _lead(written(_by_list(open_, large), "unled"), sets, percent)
        found.append(more.where(near).select("a", "b"))
        met = more.select(F.col("a").alias("p"), F.col("b").alias("node"), near.alias("done"))
        open_ = written(again.join(met, ["p", "node"], "left").where("not done").select("s", "node", "n", "pos", "indexed"), "again")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = written(links, "links")
    labels = None if links.isEmpty() else components(links)
    left = labelled(left, labels)
    several = left.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("many"))
    several = written(several.where("low <> high").select("s", "many"), "several")
    left = written(_by_list(left, several), "open")
    pairs = written(_cross_pairs(left, percent), "pairs")
    sure = pairs.where("sure").select("a", "b")
    rest = pairs.where("not sure")
    if close is not None:
        rest = written(close(rest), "close")
    full = written(rest.where("via is null").select("a", "b"), "compared")
    tested = overlaps(full, sets, percent).where(linked(percent, F.col("both"), F.col("m"), F.col("n"))).select("a", "b")
    new = sure.unionByName(_derived(rest.where("via is not null"), answers, sets, percent)).unionByName(tested)
    new = written(new, "found")
    if new.isEmpty():
        return labels
    return components(links.unionByName(new))
