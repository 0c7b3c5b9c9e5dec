"""Filter interaction audit: what each filter removes in every order.

Filters are Boolean conditions on a document ("fails"); each has one bit.
The filter on copies is an existential self-join: a left-semi join on the
text's hash, the exact text and a smaller doc_id marks its failures. Its
ids and the failing ids of the other filters are united, their bits
combined per id, and documents are counted per part, bit combination and
labels. That small table answers every order of the filters: a step
removes the rows whose combination holds its bit and none of the earlier
ones.

Copies at scale: narrow rows (id, hash, bits) tell which hashes several
ids share. Only texts of such hashes travel to the join while that set
passes a size check, otherwise all do. The join's right side is one row
per distinct text (its smallest id), reduced before it is shuffled; hot
texts are split by salts.

A null text is empty. A null doc_id is smaller than no other and has none
smaller, so it neither fails nor causes a failure as a copy. Repeated rows
are counted as often as they stand. A null part is the empty string. Of
repeated labels, one with 1 is enough. Labels with a null id, and columns
other than those named, are not read. An empty table gives no row.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, spread, written

# Hashes of shared texts are broadcast up to this count (8 bytes each).
BROADCAST_ROWS = 500_000
COPIES = "E"


def text_filters(text: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """(measures, conditions over their names): the audited filters."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    measures = {
        "words": words,
        "capitals": F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        "points": F.length(text),
        "marked": text.rlike(r"[#$%&*|]"),
    }
    conditions = {
        "A": F.size("words") < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
        "C": 100 * F.col("capitals") > 3 * F.col("points"),
        "D": F.col("marked"),
    }
    return measures, conditions


def _counts(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("many")), rows.count()


def copy_ids(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, hash) of the rows whose exact text a smaller doc_id has.
    ``texts`` is (doc_id, hash, text); ``rows`` holds the written (doc_id,
    hash) of the same rows."""
    shared = rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = written(shared.where("low < high").select("hash"), "shared")
    if shared.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(shared), "hash", "left_semi")
    texts = texts.where("doc_id is not null")
    least = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("doc_id"))
    later, first = spread(texts, least, "hash", ["doc_id"], *_counts(rows, "hash"))
    same = (
        (F.col("a.hash") == F.col("b.hash"))
        & (F.col("a.salt") == F.col("b.salt"))
        & (F.col("a.text") == F.col("b.text"))
        & (F.col("b.doc_id") < F.col("a.doc_id"))
    )
    return later.alias("a").join(first.alias("b"), same, "left_semi").select("doc_id", "hash")


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang") -> tuple[DataFrame, list[str]]:
    """((part, mask, good, toxic, n), filter letters): documents by part,
    combination of failing filters and labels."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
    ).withColumn("hash", F.xxhash64("text"))
    measures, conditions = text_filters(F.col("text"))
    letters = [*conditions, COPIES]
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions.values())), F.lit(0))
    measured = texts.select("doc_id", "hash", "part", *[c.alias(n) for n, c in measures.items()])
    rows = written(measured.select("doc_id", "hash", "part", bits.alias("bits")), "audited")
    copies = copy_ids(texts.select("doc_id", "hash", "text"), rows)
    counted = rows.groupBy("doc_id", "hash", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    failures = counted.where("bits > 0").select("doc_id", "hash", "bits")
    failures = failures.unionByName(copies.select("doc_id", "hash", F.lit(1 << len(conditions)).alias("bits")))
    mask = failures.groupBy("doc_id", "hash").agg(F.bit_or("bits").alias("mask"))
    same = F.col("c.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("c.hash") == F.col("m.hash"))
    masked = counted.alias("c").join(mask.alias("m"), same, "left")
    masked = masked.select("c.doc_id", "c.hash", "part", F.coalesce("mask", F.lit(0)).alias("mask"), "n")
    is_one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    )
    facts, marks = spread(masked.where("doc_id is not null"), marks, "doc_id", ["hash"], *_counts(rows, "doc_id"))
    known = facts.join(marks, ["doc_id", "salt"], "left")
    known = known.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "n")
    unknown = masked.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n")
    every = known.unionByName(unknown)
    return written(every.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "combinations"), letters


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for every part, order and step."""
    counts, letters = combinations(docs, labels, part)
    bit = {f: 1 << k for k, f in enumerate(letters)}
    everything = (1 << len(letters)) - 1
    # a step depends on its filter and on which filters came before it
    asked = [(bit[f], before) for f in letters for before in range(everything + 1) if not before & bit[f]]
    at = F.explode(F.array([F.struct(F.lit(b).alias("bit"), F.lit(e).alias("before")) for b, e in asked])).alias("at")
    each = counts.select("part", "mask", "good", "toxic", "n", at).select("*", "at.bit", "at.before")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    orders = 1
    for k in range(2, len(letters) + 1):
        orders *= k
    total = lambda when, n=F.col("n"): F.sum(F.when(when, n).otherwise(F.lit(0))).cast("long")
    sums = each.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, F.col("n") * F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("n") * F.col("toxic")).alias("toxic_lost"),
        # of the orders, one in |mask| has this filter before the others that fail
        total(fails, F.col("n") * F.expr(f"{orders} div bit_count(mask)")).alias("shapley"),
    )
    steps = [
        ("".join(order), k + 1, bit[order[k]], sum(bit[f] for f in order[:k]))
        for order in permutations(letters)
        for k in range(len(order))
    ]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    return sums.join(F.broadcast(steps), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
