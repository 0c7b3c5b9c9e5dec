"""Column helpers for the operators that stay in Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE

CHUNK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda variable is
    evaluated per row, where a repeated expression inside another lambda
    would be evaluated per element."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def starts(lengths: Column) -> Column:
    """Running sums before each element of an array of longs, chunk by
    chunk, so that long arrays are not copied per element."""

    def chain(values: Column, first: Column) -> Column:
        zero = F.struct(F.array().cast("array<bigint>").alias("at"), first.cast("bigint").alias("sum"))
        return F.aggregate(
            values,
            zero,
            lambda a, x: F.struct(F.concat(a["at"], F.array(a["sum"])).alias("at"), (a["sum"] + x).alias("sum")),
        )["at"]

    total = lambda values: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / CHUNK).cast("int") - 1, F.lit(0))),
        lambda c: F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)),
    )
    return let(
        chunks,
        lambda parts: let(
            chain(F.transform(parts, total), F.lit(0)),
            lambda base: F.flatten(F.transform(parts, lambda values, c: chain(values, F.get(base, c)))),
        ),
    )


def matches(text: Column, pattern: str) -> Column:
    """Non-overlapping matches, leftmost first, as an array of
    struct(start, end, value); code points, end exclusive."""
    size = lambda parts: F.transform(parts, lambda p: F.length(p).cast("bigint"))

    def place(found: Column, gaps: Column) -> Column:
        step = F.zip_with(size(gaps), size(found), lambda gap, own: gap + F.coalesce(own, F.lit(0)))
        return let(
            starts(step),
            lambda at: F.transform(
                found,
                lambda value, i: F.struct(
                    (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"),
                    (F.get(at, i) + F.length(F.get(gaps, i)) + F.length(value)).alias("end"),
                    value.alias("value"),
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern, -1), lambda gaps: place(found, gaps)),
    )
