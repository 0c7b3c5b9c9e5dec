"""The Jaccard join against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, set_join, set_links, shingles
from ledgerloom.llm.common import utf8
from tests.llm.test_near_dedup import brute_components, brute_set, corpus


def drifting(seed=11):
    """Groups of near copies whose members are linked through others, one
    large group, and passages that unlike texts share."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(3000)]
    rows = corpus(seed)
    shared = [rng.choice(words) for _ in range(40)]
    for _ in range(6):
        text = [rng.choice(words) for _ in range(rng.choice([9, 40, 120]))]
        for _ in range(25):  # a chain: each copy alters the one before
            text = list(text)
            for _ in range(rng.randrange(1, 1 + max(1, len(text) // 30))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text.insert(rng.randrange(len(text)), rng.choice(words))
            rows.append((0, " ".join(text)))
    original = [rng.choice(words) for _ in range(100)]
    for _ in range(120):  # copies about the threshold from each other
        text = list(original)
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(100)] = rng.choice(words)
        rows.append((0, " ".join(text)))
    for _ in range(60):
        own = [rng.choice(words) for _ in range(rng.randrange(0, 12))]
        rows.append((0, " ".join(own + shared[: rng.randrange(20, 40)])))
    rng.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


def found(docs, **options):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in set_join.group(docs, **options).collect())


@pytest.mark.parametrize("small", [False, True])
def test_components_equal_brute_force(spark, monkeypatch, small):
    if small:  # no broadcasts, hot keys everywhere, several leaders, many blocks
        monkeypatch.setattr(shingles, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(common, "SALT_ROWS", 7)
        monkeypatch.setattr(set_links, "LEADER_ROWS", 2)
        monkeypatch.setattr(set_join, "BLOCK_SHINGLES", 3000)
    rows = drifting()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("node", F.lit("x"))
    assert found(docs.repartition(5)) == brute_components(rows, 5, 80)


def test_other_parameters(spark):
    rows = drifting(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, size=2, percent=60) == brute_components(rows, 2, 60)


def test_edges(spark):
    rows = [(7, "A b"), (3, "a  b"), (None, "a b"), (None, None), (4, ""), (4, "x y z w v u"), (5, " \t"), (3, "a  b"), (9, "b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in set_join.group(docs).collect()), key=str)
    want = [(7, 1, 3), (3, 1, 3), (None, 1, 3), (None, 0, None), (4, 0, 4), (4, 2, 4), (5, 0, 5), (3, 1, 3), (9, 1, 9)]
    assert got == sorted(want, key=str)
    assert set_join.group(docs.limit(0)).count() == 0
    nulls = docs.select("doc_id", F.lit(None).cast("string").alias("text"))
    assert {r["n_shingles"] for r in set_join.group(nulls).collect()} == {0}


def test_narrowing_keeps_every_linked_set(spark):
    rows = drifting(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    classes = {r["doc_id"]: r for r in set_join.classes_of(docs, 5).collect()}
    counts = {r["mark"]: r["shared"] for r in set_join.shared_counts(docs, 5, 80, 4).collect()}
    sets = {k: brute_set(t, 5) for k, t in rows}
    for i, a in sets.items():
        for j, b in sets.items():
            if a != b and a and 100 * len(a & b) >= 80 * len(a | b):
                least = max(1, -(-80 * len(a) // 100) // 10)
                assert counts.get(classes[i]["mark"], 0) >= least, (i, j)


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    texts = ["", "a" * 90, " lead and trail ", "w1 w2 " * 50, None, "é" * 70 + " x", "  ", "end"]
    raw, offsets = utf8(pa.array(texts))
    whole = shingles.word_hashes(raw, offsets)
    for size in (1, 3, 10, 64):
        monkeypatch.setattr(shingles, "CHUNK_BYTES", size)
        parts = shingles.word_hashes(raw, offsets)
        assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
