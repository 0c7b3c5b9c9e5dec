"""Chat formatting by quotation linking.

Lines of a message have a quote level (leading ``>``, blanks allowed
between). Runs of non-blank lines of one level are passages. A passage is
normalised (lower case, white space collapsed, lines joined) and hashed.
Quoted passages are joined to the own (level 0) passages of earlier
messages of the conversation; a message answers the latest message that
its outermost matched quote level comes from, else the message before it.
Messages are returned with their reply links, depth and thread, and with
quotes and attribution lines removed: ordered by (conv_id, thread, turn),
each message follows the one it answers.

The latest earlier match is found without pairs: own passages and quotes
with one (conversation, hash) are looked up by blocks of turns, whose
maxima are carried over, so a hot passage or conversation is split.

Null texts are empty. A message with a null conv_id or turn stands alone
(no links, depth 0). Rows with the same conv_id and turn are one position
in the conversation: they share links found by any of them. Empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, written
from ledgerloom.llm.native import let

TURN_BLOCK = 1024
QUOTE = r"^[ \t>]*>"
ATTRIBUTION = r"^[ \t]*On .* wrote:[ \t\r]*$"


def _lines(text: Column) -> Column:
    """array<struct(level, body)> of a message's lines."""

    def parse(line: Column) -> Column:
        mark = F.regexp_extract(line, QUOTE, 0)
        return F.struct(
            F.length(F.regexp_replace(mark, r"[ \t]", "")).alias("level"),
            F.substr(line, F.length(mark) + 1).alias("body"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), parse)


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, SPACE, " ")))


def _passages(lines: Column) -> Column:
    """array<struct(level, hash)>: runs of non-blank lines of one level."""
    blank = lambda line: _normal(line["body"]) == ""

    def runs(marked: Column) -> Column:
        # a run starts where the level or the blankness changes
        first = F.filter(
            F.sequence(F.lit(0), F.size(marked) - 1),
            lambda i: (i == 0) | (F.get(marked, i)["key"] != F.get(marked, i - 1)["key"]),
        )
        return let(
            first,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    F.get(marked, i)["key"].alias("level"),
                    F.md5(
                        _normal(
                            F.array_join(
                                F.transform(
                                    F.slice(marked, i + 1, F.coalesce(F.get(at, k + 1), F.size(marked)) - i),
                                    lambda m: m["body"],
                                ),
                                " ",
                            )
                        ).cast("binary")
                    ).alias("hash"),
                ),
            ),
        )

    marked = F.transform(
        lines, lambda x: F.struct(F.when(blank(x), F.lit(-1)).otherwise(x["level"]).alias("key"), x["body"].alias("body"))
    )
    return F.filter(let(marked, runs), lambda p: p["level"] >= 0)


def _clean(lines: Column) -> Column:
    """Own text: without quoted lines, and without an attribution line
    right before a quote."""
    own = F.filter(
        lines,
        lambda x, i: (x["level"] == 0)
        & ~(x["body"].rlike(ATTRIBUTION) & F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))),
    )
    return F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^[\s]+|[\s]+$", "")


def latest_before(events: DataFrame, keys: list[str]) -> DataFrame:
    """``events`` (keys, turn, own boolean) with ``found``: the largest
    turn below the row's own at which an ``own`` row of the same keys
    stands. Two levels: inside blocks of turns, and over block maxima."""
    turn = F.when(F.col("own"), F.col("turn"))
    inside = Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    e = events.withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    blocks = (
        e.groupBy(*keys, "block").agg(F.max(turn).alias("top")).withColumn("carried", F.max("top").over(before))
        .select(*keys, "block", "carried")
    )
    return (
        e.withColumn("near", F.max(turn).over(inside))
        .join(blocks, [*keys, "block"])
        .withColumn("found", F.coalesce("near", "carried"))
        .drop("block", "near", "carried")
    )


def _threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, depth, thread) by pointer doubling: after
    k rounds a message points 2^k links up, so rounds grow with the log of
    the longest chain."""
    state = written(
        links.select(
            "conv_id", "turn", "reply_to",
            F.coalesce("reply_to", "turn").alias("up"),
            F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        ),
        "threads",
    )
    done, active = state.where("reply_to is null"), state.where("reply_to is not null")
    while not active.isEmpty():
        above = done.unionByName(active).select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more")
        )
        step = written(
            active.join(above, ["conv_id", "up"]).select(
                "conv_id", "turn", "reply_to", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("more") > 0).alias("moved"),
            ),
            "threads",
        )
        # what points at a root is done: only longer chains go on
        done = done.unionByName(step.where("not moved").drop("moved"))
        active = step.where("moved").drop("moved")
    return done.select("conv_id", "turn", "reply_to", "depth", F.col("up").alias("thread"))


def link(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, reply_to, depth, thread, n_quotes, n_linked,
    clean_text) for every row."""
    parsed = written(
        messages.select("conv_id", "turn", "role", _lines(F.col("text")).alias("lines")).select(
            "conv_id", "turn", "role", _passages(F.col("lines")).alias("passages"), _clean(F.col("lines")).alias("clean_text")
        ),
        "messages",
    )
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    passages = (
        parsed.where(placed)
        .select("conv_id", "turn", F.explode("passages").alias("p"))
        .select("conv_id", "turn", "p.level", "p.hash")
        .distinct()
    )
    quotes = passages.where("level > 0").select("conv_id", "hash").distinct()
    # own passages that nobody quotes take no part
    events = passages.join(quotes, ["conv_id", "hash"], "left_semi").withColumn("own", F.col("level") == 0)
    linked = written(latest_before(events, ["conv_id", "hash"]).where("level > 0"), "quotes")
    answers = (
        linked.groupBy("conv_id", "turn")
        .agg(
            F.min(F.when(F.col("found").isNotNull(), F.struct("level", (-F.col("found")).alias("minus")))).alias("best"),
            F.count(F.lit(1)).alias("n_quotes"),
            F.count("found").alias("n_linked"),
        )
        .select("conv_id", "turn", (-F.col("best.minus")).alias("answered"), "n_quotes", "n_linked")
    )
    positions = parsed.where(placed).select("conv_id", "turn").distinct().withColumn("own", F.lit(True))
    links = (
        latest_before(positions, ["conv_id"])
        .join(answers, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", F.coalesce("answered", "found").alias("reply_to"), "n_quotes", "n_linked")
    )
    links = written(links, "links")
    out = _threads(links).join(links.drop("reply_to"), ["conv_id", "turn"])
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        parsed.alias("m")
        .join(out.alias("t"), ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "reply_to", zero("depth"), F.coalesce("thread", "turn").alias("thread"),
            zero("n_quotes"), zero("n_linked"), "clean_text",
        )
    )
