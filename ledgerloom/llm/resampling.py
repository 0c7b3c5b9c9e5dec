"""Target-distribution importance resampling by hashed word n-grams.

Texts are scanned by an Aho-Corasick automaton. Its dictionary holds the
distinct words of a stretch of texts, each bounded by delimiters, with the
word's CRC-32 and byte length as payload: a match is a whole word, and
every word matches exactly once. A run of words needs no bytes of its own:
the CRC of two neighbours and the blank between them is composed from
their payloads (a CRC is linear, so appending n bytes is one linear map of
the first CRC, and these maps multiply). The CRC picks a feature's bucket.

Counting sums buckets over all documents and over the target texts; a
bucket's gain compares the two shares. Scoring scans again and sums gains.
A document's Gumbel noise comes from its id, and the highest scores are
drawn: resampling without replacement in proportion to importance, alike
in every run.

Memory: a dictionary lives for a stretch of CHUNK_BYTES (or one longer
text). Only the bucket counts, a table of fixed size, and the histogram of
scores (integers within about 100,000 values, however many rows) reach the
driver; ranks are found within ranges of (score, doc_id).

A null or wordless text has no feature and weight 0. A null doc_id hashes
as an empty one and loses ties. Repeated rows are scored alike and ranked
next to each other. An empty target gives gains against nothing (t = T =
0); an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm.common import parts, utf8, written

BUCKETS = 10_000
RUN = 1  # words in the longest feature
LEAST_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
CHUNK_BYTES = 2 << 20

# Letters and digits stay (A-Z lower-cased), so do bytes of other
# alphabets; every other byte is a delimiter.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _linear(images: np.ndarray) -> np.ndarray:
    """Four tables of 256 for the linear map that sends bit k to images[k]."""
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            table[byte] ^= np.where(np.arange(256) >> bit & 1, images[8 * byte + bit], 0).astype(np.uint32)
    return table


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & np.uint32(255)]
    for byte in range(1, 4):
        out = out ^ table[byte][(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _appending(steps: int = 32) -> list[np.ndarray]:
    """Maps of a CRC under appending 1, 2, 4, ... zero bytes. The first is
    read off the CRC itself: its constant part cancels in the XOR."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    reverse = 0xEDB88320  # fixed value: the polynomial of CRC-32
    images = []
    for bit in bits.tolist():
        for _ in range(8):
            bit = (bit >> 1) ^ (reverse if bit & 1 else 0)
        images.append(bit)
    maps = [_linear(np.array(images, np.uint32))]
    while len(maps) < steps:
        maps.append(_linear(_apply(maps[-1], _apply(maps[-1], bits))))
    return maps


_MAPS = _appending()
_BLANK = np.uint32(zlib.crc32(b" "))


def compose(crc: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of two strings put together, from both and the second's length."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        on = (length >> k) & 1 == 1
        out[on] = _apply(_MAPS[k], out[on])
    return out ^ after


def scan(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, CRC-32, byte length) of every word, in order."""
    n = len(offsets) - 1
    of = np.repeat(np.arange(n), np.diff(offsets))
    line = np.full(len(raw) + n + 1, 32, np.uint8)
    line[np.arange(len(raw)) + of + 1] = _FOLD[raw]
    data = line.tobytes()
    words = list(set(data.split()))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, word in enumerate(words):
        automaton.add_word(f" {word.decode('latin-1')} ", k)
    automaton.make_automaton()
    hits = np.fromiter(chain.from_iterable(automaton.iter(data.decode("latin-1"))), np.int64).reshape(-1, 2)
    starts = offsets[:-1] + np.arange(n) + 1  # of the texts in the line
    text = np.searchsorted(starts, hits[:, 0] - 1, "right") - 1
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)[hits[:, 1]]
    return text, crc, np.array([len(w) for w in words], np.int64)[hits[:, 1]]


def features(column: pa.Array, run: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """(first text, next text, words per text, [(text, bucket) of the runs
    of 1, 2, ... words]) for stretches of texts."""
    raw, offsets = utf8(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        text, crc, length = scan(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        one = np.ones(len(length), np.int64)
        after = compose(np.full(len(crc), _BLANK), crc, length)  # a blank and the word
        size, found, whole, at = length + one, [], crc, text
        for k in range(run):
            if k:
                same = text[k:] == text[: len(text) - k] if k < len(text) else np.zeros(0, bool)
                whole = compose(whole[: len(same)], after[k:], size[k:])
                at = text[: len(same)]
                found.append((at[same], whole[same] % np.uint32(buckets)))
            else:
                found.append((at, whole % np.uint32(buckets)))
        yield a, b, np.bincount(text, minlength=b - a), found
        a = b


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts`` per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in features(batch.column(0), run, buckets):
                for _, bucket in found:
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over the own."""
    k, s_all, t_all = len(own), float(own.sum()), float(target.sum())
    ratio = (target + 1.0) * (s_all + k) / ((own + 1.0) * (t_all + k))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, many, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for a, b, per_text, found in features(batch.column("text"), run, len(gain)):
                words[a:b] = per_text
                for text, bucket in found:
                    many[a:b] += np.bincount(text, minlength=b - a)
                    np.add.at(total, a + text, gain[bucket])
            columns = [pa.array(x) for x in (words, many, total // np.maximum(many, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def scored(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighed`` with ``score``: the weight and the id's Gumbel noise."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


def ranked(scores: DataFrame, eligible, percent: int = DRAW_PERCENT) -> DataFrame:
    """``scores`` (written) with ``rank``: 1, 2, 3 ... by falling score,
    ties by smaller doc_id, for the drawn percentage of the eligible rows;
    null for the others."""
    chosen = scores.where(eligible)
    histogram = sorted(((r["score"], r["n"]) for r in chosen.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    draws = percent * sum(n for _, n in histogram) // 100
    cut, above = None, 0
    for score, n in histogram:
        if above >= draws:
            break
        cut, above = score, above + n
    if cut is None:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    high = eligible & (F.col("score") >= cut)
    ranges = scores.where(high).withColumn("row", F.monotonically_increasing_id())
    ranges = ranges.repartitionByRange(parts(scores.sparkSession), *order).withColumn("range", F.spark_partition_id())
    ranges = written(ranges, "ranges")
    sizes = sorted(ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.concatenate(([0], np.cumsum([r["n"] for r in sizes]))).tolist()
    start = F.create_map(*chain.from_iterable((F.lit(r["range"]), F.lit(b)) for r, b in zip(sizes, before)))
    nth = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.element_at(start, F.col("range"))
    drawn = ranges.withColumn("rank", nth.cast("long")).withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = scores.where(~high).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = DRAW_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``, drawn towards the texts of ``target``."""
    gain = gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets))
    scores = written(scored(weights(docs, gain, run), seed), "scores")
    return ranked(scores, F.col("n_words") >= least_words, percent)
