"""Near-dedup against brute force over all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import near_dedup
from ledgerloom.llm.graph import components

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_set(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size, percent):
    sets = [(d, brute_set(t, size)) for d, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s), low[root(i)]) for i, (d, s) in enumerate(sets)]


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([30, 80, 200]))] for _ in range(25)]
    texts = [None, "", " \t\n", "one", "one two", "Two one", "ONE", "a b c", "É b c", "é b c"]
    for b in base:
        texts.append(" ".join(b))
        for _ in range(rng.randrange(6)):
            c = list(b)
            for _ in range(rng.randrange(1, 8)):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append("  ".join(c).upper())
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("sha", F.lit(1))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.report(docs).collect())
    assert got == sorted(brute_components(rows, 3, 85))


def test_every_near_pair_in_one_bucket_of_unlike_documents(spark):
    # a shared body makes all of them collide, few are linked
    rng = random.Random(5)
    body = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        tail = [f"t{rng.randrange(9)}x{j}" for j in range(20)] if i % 3 else [f"u{j}" for j in range(20)]
        rows.append((i, " ".join(body + tail)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.report(docs).collect())
    assert got == sorted(brute_components(rows, 3, 85))


def test_edges_and_kept_rows(spark):
    rows = [(None, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "A b c d"), (4, None), (5, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("k"))
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.report(docs).collect())
    assert got == [
        ("2", "2", True), ("2", "2", True), ("3", "2", False), ("4", "4", True), ("4", "4", True), ("5", "5", True),
        ("None", "2", False),
    ]
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5]
    assert near_dedup.report(docs.limit(0)).count() == 0


def test_components_that_share_an_id_keep_one_row_each(spark):
    unlike = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcdef"]
    rows = [(None, unlike[0]), (None, unlike[1]), (None, unlike[2]), (None, unlike[2].upper())]
    rows += [(5, unlike[3]), (5, unlike[4]), (6, unlike[4]), (5, unlike[3]), (None, unlike[5]), (9, unlike[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r["doc_id"]), r["text"].lower()) for r in near_dedup.keep_one(docs).collect())
    assert kept == sorted([("None", t) for t in unlike[:3]] + [("5", unlike[3]), ("5", unlike[4]), ("9", unlike[5])])


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    near_dist, far_dist = [], []
    for _ in range(50):
        other = values.copy()
        other[:80] = rng.integers(0, 1 << 63, 80, dtype=np.uint64)  # J about 0.92
        a, b = (near_dedup.odd_sketch(near_dedup.minhash(v)) for v in (values, other))
        near_dist.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
        c = near_dedup.odd_sketch(near_dedup.minhash(rng.integers(0, 1 << 63, 2000, dtype=np.uint64)))
        far_dist.append(int(np.bitwise_count((a ^ c).view(np.uint64)).sum()))
    assert max(near_dist) < near_dedup.sketch_limit(0.7) < near_dedup.sketch_limit(0.3) < min(far_dist)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(30)] + [(300, 299), (299, 50), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(30)} | {300: 50, 299: 50, 50: 50}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
