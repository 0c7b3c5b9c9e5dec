"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash. Sizes are summed by source and the
first 12 hash bits; the bucket in which a source's running sum crosses
its budget is the boundary. Only that bucket is split by the next 12
bits, and so on, until the boundary is one hash value. What lies below is
taken, what lies above is not: a filter, no sort. A target beyond a
source's own size takes every document once and finds the threshold for
the repeats. The boundary document is taken in part (its first words), so
a source's sum meets its whole-number target.

Targets: sources by code point (null last) weigh as ``WEIGHTS`` repeats;
they share ``SHARE`` of all sizes; no target exceeds ``CAP`` times its
source, and the excess goes to the others by weight. The fixed point of
that resharing is the level ``lam`` with sum(min(cap, lam * weight)) =
total, found from prefix sums over the sources by cap / weight.

Null texts have size 0; a null doc_id is hashed by its text; rows with
the same hash at the boundary share the rest in proportion to size.
Empty tables give empty results. Reruns agree: nothing is random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
LEVEL_BITS, LEVELS = 12, 5  # 60 hash bits


def hash60(doc_id: Column, text: Column) -> Column:
    """First 60 bits of the MD5 of the id (of the text for a null id)."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("n"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size). One row
    per source: the frame is as small as the list of sources."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("nth") - 1) % len(WEIGHTS) + 1).cast("int"))
    s = (
        sizes.withColumn("nth", F.row_number().over(by_name))
        .withColumn("w", w)
        .withColumn("cap", CAP * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("w"))
    )
    order = Window.orderBy("ratio", "nth")
    every = Window.partitionBy()
    s = (
        s.withColumn("k", F.row_number().over(order))
        .withColumn("cap_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("w_left", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(every))
    )
    level = (SHARE * F.col("total") - F.coalesce(F.col("cap_before"), F.lit(0))) / F.col("w_left")
    s = s.withColumn("level", level)
    lam = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("k", "level"))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), lam * F.col("w"))
    return s.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def thresholds(sized: DataFrame) -> DataFrame:
    """Per source: (source, source_size, target, base, cut, rest, tied).
    Take ``base`` (0 or 1) whole copies of everything, one more of what
    hashes below ``cut``, and ``rest`` words of the ``tied`` words that
    hash to ``cut``. ``sized`` is (source, size, hash)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.col("target") >= F.col("source_size")
    state = written(
        targets(sums)
        .withColumn("base", F.when(whole, 1).otherwise(0))
        .withColumn("budget", F.floor("target").cast("long") - F.col("base") * F.col("source_size"))
        .withColumn("below", F.lit(0).cast("long"))
        .withColumn("prefix", F.lit(0).cast("long"))
        .withColumn("tied", F.col("source_size")),
        "sources",
    )
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        # only rows of the boundary bucket of the level before
        inside = sized.alias("d").join(
            state.select("source", "prefix").alias("s"),
            F.expr(f"d.source <=> s.source and shiftright(d.hash, {shift + LEVEL_BITS}) = s.prefix"),
        )
        buckets = inside.groupBy(F.col("d.source").alias("source"), F.shiftright("d.hash", shift).alias("bucket")).agg(
            F.sum("d.size").alias("words")
        )
        running = F.sum("words").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        )
        buckets = buckets.withColumn("before", F.coalesce(running, F.lit(0)))
        # the last bucket that starts within the budget
        crossed = (
            buckets.alias("b")
            .join(state.alias("s"), F.expr("b.source <=> s.source and s.below + b.before <= s.budget"))
            .groupBy(F.col("s.source").alias("source"))
            .agg(F.max(F.struct("b.bucket", "b.before", "b.words")).alias("at"))
        )
        state = written(
            state.alias("s")
            .join(crossed.alias("c"), F.expr("s.source <=> c.source"))
            .select(
                "s.source",
                "s.source_size",
                "s.target",
                "s.base",
                "s.budget",
                (F.col("s.below") + F.col("c.at.before")).alias("below"),
                F.col("c.at.bucket").alias("prefix"),
                F.col("c.at.words").alias("tied"),
            ),
            f"level{level}",
        )
    return state.select(
        "source", "source_size", "target", "base", F.col("prefix").alias("cut"),
        F.least(F.col("budget") - F.col("below"), F.col("tied")).alias("rest"), "tied",
    )


def extra_words(size: Column, hashed: Column) -> Column:
    """Words of the threshold copy of a document."""
    part = F.floor(F.col("rest") * size / F.greatest(F.col("tied"), F.lit(1))).cast("long")
    return F.when(hashed < F.col("cut"), size).when(hashed == F.col("cut"), part).otherwise(F.lit(0)).cast("long")


def plan_mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row."""
    sized = written(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            hash60(F.col("doc_id"), F.col("text")).alias("hash"),
        ),
        "sizes",
    )
    cuts = thresholds(sized)
    taken = F.col("base") * F.col("size") + extra_words(F.col("size"), F.col("hash"))
    return (
        sized.alias("d")
        .join(cuts.alias("c"), F.expr("d.source <=> c.source"))
        .select("doc_id", "size", "source_size", "target", taken.alias("taken"))
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a document taken
    twice is two rows; the boundary document's last copy holds its first
    ``taken`` words. Texts are filtered in place, never shuffled."""
    size, hashed, copies = fresh(docs, "_size"), fresh(docs, "_hash"), fresh(docs, "_copy")
    marked = docs.withColumn(size, word_count(F.col("text"))).withColumn(
        hashed, hash60(F.col("doc_id"), F.col("text"))
    )
    cuts = thresholds(
        written(marked.select("source", F.col(size).alias("size"), F.col(hashed).alias("hash")), "sizes")
    ).withColumnRenamed("source", "_cut_source")
    cuts = cuts.select(F.struct("_cut_source", "base", "cut", "rest", "tied").alias(copies))
    joined = marked.join(cuts, marked["source"].eqNullSafe(F.col(copies)["_cut_source"]))
    cut = F.col(copies)
    part = F.floor(cut["rest"] * F.col(size) / F.greatest(cut["tied"], F.lit(1))).cast("long")
    extra = F.when(F.col(hashed) < cut["cut"], F.col(size)).when(F.col(hashed) == cut["cut"], part).otherwise(0)
    out = joined.withColumn(
        copies, F.explode(F.filter(F.array(cut["base"] * F.col(size), extra.cast("long")), lambda n: n > 0))
    )
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col(copies).cast("int")), "")
    return out.withColumn("text", F.when(F.col(copies) < F.col(size), head).otherwise(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
