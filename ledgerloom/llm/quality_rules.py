"""Quality rules: learned decision lists over text statistics.

Statistics of every whole text are built from Spark's own functions. A
list is learned by sequential covering from labelled statistics: a rule
grows by the threshold condition of best information gain, is pruned on
rows kept from growing, and is accepted if it is precise enough there;
the rows it covers are removed and the next rule is grown on the rest.
The ordered rules become one ``CASE WHEN`` expression, so applying the
list is a filter inside the scan's own stage.

Learning sees at most ``SAMPLE_ROWS`` labelled documents (smallest id
hashes); the statistics and the verdicts cover all documents.

A null text has no words and fails the base rule. Labels of unknown
documents or without a quality are ignored; without labels the list is
empty and only the base rule decides. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written
from ledgerloom.llm.native import let, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 8000
MIN_PRECISION = 0.95
MIN_COVER = 8
MAX_RULES = 24
MAX_CONDITIONS = 4
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text has twice."""

    def covered(marked: Column) -> Column:
        # equal windows are neighbours after sorting by (hash, position)
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = F.filter(marked, lambda m, j: same(m, F.get(marked, j - 1)) | same(m, F.get(marked, j + 1)))
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda m: m["i"])),
            zero,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        )["n"]

    def counted(windows: Column) -> Column:
        marked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
            let(marked, covered)
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW)))
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).otherwise(
        let(hashed, lambda h: let(windows(h), counted))
    )


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, the statistics, n_lines) of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    dup = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    counts = let(
        words_of(F.col("text")),
        lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")),
    )
    return docs.select(
        "doc_id",
        counts.alias("w"),
        F.length(F.translate(text, BLANKS, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        dup.alias("d"),
    ).select(
        "doc_id",
        F.col("w.n_words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("d.dup").cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("d.n").cast("long").alias("n_lines"),
    )


def features() -> dict[str, Column]:
    """What conditions may test."""
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / per_word,
        "symbols_per_word": F.col("n_symbols") / per_word,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / per_word,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.threshold if self.above else row[self.feature] < self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _best_condition(rows: list[tuple[dict, int]], names: list[str]) -> Condition | None:
    """Threshold of best gain towards bad rows: one sorted sweep a feature."""
    bad = sum(y for _, y in rows)
    base = math.log2(bad / len(rows))
    best, found = 1e-9, None
    for name in names:
        order = sorted(rows, key=lambda r: r[0][name])
        n_low = bad_low = 0
        for k in range(len(order) - 1):
            n_low += 1
            bad_low += order[k][1]
            low, high = order[k][0][name], order[k + 1][0][name]
            if low == high:
                continue
            for above, p, n in ((False, bad_low, n_low), (True, bad - bad_low, len(order) - n_low)):
                if p < MIN_COVER:
                    continue
                gain = p * (math.log2(p / n) - base)
                if gain > best:
                    best, found = gain, Condition(name, above, (low + high) / 2)
    return found


def _value(rule: Rule, rows: list[tuple[dict, int]]) -> float:
    hit = [y for x, y in rows if covers(rule, x)]
    return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0


def _prune(rule: Rule, rows: list[tuple[dict, int]]) -> Rule:
    """Drop conditions while the rule does as well on the pruning rows."""
    while len(rule) > 1:
        shorter = max((rule[:k] + rule[k + 1 :] for k in range(len(rule))), key=lambda r: _value(r, rows))
        if _value(shorter, rows) < _value(rule, rows):
            break
        rule = shorter
    return rule


def learn(rows: list[tuple[dict, int]]) -> list[Rule]:
    """Ordered rules that mark bad rows (label 1). Every third row prunes
    and accepts, the others grow."""
    names = list(rows[0][0]) if rows else []
    grow, prune = [r for k, r in enumerate(rows) if k % 3], rows[::3]
    found: list[Rule] = []
    while len(found) < MAX_RULES and any(y for _, y in grow):
        rule: Rule = ()
        left = grow
        while len(rule) < MAX_CONDITIONS and any(not y for _, y in left):
            condition = _best_condition(left, names)
            if condition is None:
                break
            rule += (condition,)
            left = [r for r in left if covers(rule, r[0])]
        if not rule:
            break
        rule = _prune(rule, prune)
        hit = [y for x, y in prune if covers(rule, x)]
        own = [y for x, y in grow if covers(rule, x)]
        precise = all(h and sum(h) >= MIN_PRECISION * len(h) for h in (hit, own))
        if not precise or len(own) < MIN_COVER:
            break
        found.append(rule)
        grow = [r for r in grow if not covers(rule, r[0])]
        prune = [r for r in prune if not covers(rule, r[0])]
    return found


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules learned from at most ``max_rows`` labelled documents. Labels
    other than 0 and 1 are left out; of several for one id the smallest
    counts, and of several texts of one id the smallest."""
    picked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    labelled = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id")  # at most max_rows ids
    labelled = labelled.groupBy("doc_id").agg(F.min("text").alias("text"))
    # written, so that no feature expression repeats the statistics' work
    stats = written(statistics(labelled.select("doc_id", "text")), "statistics")
    cols = [c.alias(n) for n, c in features().items()]
    seen = stats.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", *cols).collect()
    seen.sort(key=lambda r: tuple(r))
    names = seen[0].asDict().keys() - {"doc_id", "quality"} if seen else set()
    return learn([({n: r[n] for n in sorted(names)}, 1 - r["quality"]) for r in seen])


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: false where a rule fits."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, the five statistics, base_failed, kept) for every row."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return statistics(docs).select(
        "doc_id", *STATISTICS, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept")
    )
