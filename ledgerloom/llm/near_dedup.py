"""MinHash near-dedup with odd sketches.

A document's set holds its distinct word shingles (A-Z lower-cased) as
64-bit hashes. Documents with equal sets form a class; only one per class
goes on. ``HASHES`` MinHash values give ``BANDS`` band keys, and an odd
sketch: every (index, value) sample flips one bit of a small bitmap, so
the XOR of two bitmaps keeps the samples on which they differ, and its
population count estimates the similarity precisely where it is high.

Classes that share a band key are candidates, but no bucket's pairs are
written out. Each bucket pairs its most central member (the one in the
largest buckets: the original of its copies) with the others: linear in
its size, and it merges groups of copies. Pairs whose odd sketches
estimate far too low (``SKETCH_FLOOR``, over five standard deviations
below 0.8) are dropped; all others are confirmed on the full sets. The
members of buckets that still hold several components meet through lists
of their rarest shingles (``set_links``): only pairs across components
that positions, sizes and known overlaps leave open, again sketches first
and full sets last. Components follow from confirmed links.

With 24 bands of 4 values a pair at a threshold of 0.85 is missed with
probability 2e-8, at 0.8 with 3e-6.

Null and blank texts have an empty set and are linked with nothing. A
text with fewer words than a shingle has its whole sequence as one. A null
doc_id loses against any other. Repeated rows are one class. Empty tables
give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix64, pick_rows, spread, written
from ledgerloom.llm.graph import components
from ledgerloom.llm.set_links import labelled, link, linked, overlaps
from ledgerloom.llm.shingles import digest, full_sets, sets_of

ROWS, BANDS = 4, 24
HASHES = ROWS * BANDS
SKETCH_BITS = 512
SKETCH_FLOOR = 0.58

_RNG = np.random.default_rng(20240608)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minhash(values: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of a non-empty set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(values), 4096):
        np.minimum(best, ((values[a : a + 4096, None] * _MUL + _ADD) >> np.uint64(20)).min(axis=0), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BASE)
    for k in range(ROWS):
        keys = mix64(keys ^ rows[:, k]) + _STEP[k]
    return keys.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words."""
    cell = mix64(samples ^ (_ADD + np.uint64(1))) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(cell.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def sketch_limit(similarity: float) -> float:
    """Population count of the XOR expected at a similarity: each of the
    2k(1 - J) differing samples flips one of the bits."""
    differing = 2 * HASHES * (1 - similarity)
    return SKETCH_BITS / 2 * (1 - math.exp(-2 * differing / SKETCH_BITS))


def features(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, sha, n, digest, bands, sketch) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, bands, sketches = [], [], [], []
            for values in sets_of(batch.column("text"), size):
                n.append(len(values))
                digests.append(digest(values) if len(values) else None)
                samples = minhash(values) if len(values) else None
                bands.append(band_keys(samples) if len(values) else None)
                sketches.append(odd_sketch(samples) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("sha"),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "sha", "n", "digest", "bands", "sketch"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("sha"), "text")
    return rows.mapInArrow(run, "doc_id long, sha binary, n long, digest binary, bands array<long>, sketch array<long>")


def text_key() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))


def close_sketches(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """The pairs (a, b, ...) whose odd sketches do not rule the link out."""
    sketch = lambda c: classes.select(F.col("node").alias(c), F.col("sketch").alias(f"{c}_sketch"))
    apart = sum(
        (F.bit_count(F.get("a_sketch", F.lit(k)).bitwiseXOR(F.get("b_sketch", F.lit(k)))) for k in range(SKETCH_BITS // 64)),
        F.lit(0),
    )
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("many"))
    facts, dim = spread(pairs.join(sketch("b"), "b"), sketch("a"), "a", ["b"], counts, pairs.count())
    return facts.join(dim, ["a", "salt"]).where(apart <= sketch_limit(floor)).select(*pairs.columns)


def link_classes(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(node, label) of the linked classes. ``classes`` is the written
    (node, doc_id, digest, bands, sketch)."""

    def by_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
        total = keys.agg(F.sum("many")).first()[0] or 0
        facts, dim = spread(rows, keys, "key", ["node"], keys, total)
        return facts.join(dim, ["key", "salt"]).drop("salt")

    members = classes.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    buckets = written(by_key(members, written(shared, "shared")), "buckets")
    central = written(buckets.groupBy("node").agg(F.sum("many").alias("central")), "central")
    wanted = classes.join(central, "node", "left_semi").select("node", "doc_id", "digest")
    sets = written(full_sets(docs, written(wanted, "wanted"), size), "sets")
    # every bucket's most central member against its others
    top = buckets.join(central, "node").groupBy("key", "many").agg(F.max(F.struct("central", (-F.col("node")).alias("minus"))).alias("top"))
    top = written(top.select("key", "many", (-F.col("top.minus")).alias("p")), "top")
    spokes = by_key(buckets.drop("many"), top).where("p <> node").select(F.col("p").alias("a"), F.col("node").alias("b"))
    star = close_sketches(written(spokes.distinct(), "spokes"), classes, SKETCH_FLOOR)
    tested = overlaps(written(star, "star"), sets, percent)
    links = written(tested.where(linked(percent, F.col("both"), F.col("m"), F.col("n"))).select("a", "b"), "links")
    labels = None if links.isEmpty() else components(links)
    # buckets of several components: their members' other pairs
    placed = labelled(buckets.select("key", "node"), labels)
    several = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("many"))
    several = written(several.where("low <> high").select("key", "many"), "several")
    left = by_key(buckets.select("key", "node"), several).select("node").distinct()
    left = written(sets.join(left, "node", "left_semi"), "left")
    if left.isEmpty():
        return labels
    return link(left, percent, links, lambda pairs: close_sketches(pairs, classes, SKETCH_FLOOR))


def group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, sha, n_shingles, component_id, label) for every row, where
    the component's id is the smallest doc_id reachable. Components may
    share an id (null, or rows with one doc_id and unlike texts); ``label``
    tells them apart, and is null for empty sets."""
    rows = written(features(docs, size), "features")
    classes = written(
        rows.where("n > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    labels = link_classes(docs, classes, size, percent)
    placed = labelled(classes.select("node", "digest", "doc_id"), labels)
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("many"))
    facts, dim = spread(placed, smallest, "label", ["node"], smallest.select("label", "many"), classes.count())
    of_class = written(facts.join(dim, ["label", "salt"]).select("digest", "component_id", "label"), "components")
    sized = rows.where("n > 0").select("doc_id", "sha", "n", "digest")
    copies = sized.groupBy("digest").agg(F.count(F.lit(1)).alias("many"))
    facts, dim = spread(sized, of_class, "digest", ["doc_id", "sha"], copies, rows.count())
    placed = facts.join(dim, ["digest", "salt"])
    alone = rows.where("n = 0").select("*", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("label"))
    out = ["doc_id", "sha", F.col("n").alias("n_shingles"), "component_id", "label"]
    return placed.select(*out).unionByName(alone.select(*out))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns: 3 words, similarity 0.85."""
    return group(docs, size=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row of the
    smallest doc_id (of several such rows, the smallest text hash)."""
    groups = written(group(docs, size, percent), "groups")
    empty = groups.where("n_shingles = 0").select("doc_id", "sha").distinct()
    best = (
        groups.where("n_shingles > 0")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label", "doc_id")
        .agg(F.min("sha").alias("sha"))
    )
    keys = best.select("doc_id", "sha").unionByName(empty)
    return pick_rows(docs, F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("sha")), keys.select(F.struct("doc_id", "sha").alias("key")))
