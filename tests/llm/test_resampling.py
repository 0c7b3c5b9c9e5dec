"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import resampling

LOWER = {c: c + 32 for c in range(65, 91)}
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_features(text, run):
    words = WORDS.findall((text or "").translate(LOWER))
    found = [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
    return words, [zlib.crc32(f.encode()) % 10_000 for f in found]


def brute(docs, target, run, least, percent):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for texts, counts in ((t for _, t in docs), s), (target, t):
        for text in texts:
            for b in brute_features(text, run)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10_000) / ((s[b] + 1) * (t.sum() + 10_000)))) for b in range(10_000)]
    out, chosen = [], []
    for doc_id, text in docs:
        words, buckets = brute_features(text, run)
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(buckets), weight, score, None])
        if len(words) >= least:
            chosen.append(out[-1])
    chosen.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for nth, row in enumerate(chosen[: percent * len(chosen) // 100], 1):
        row[4] = nth
    return sorted(map(tuple, out), key=str)


def corpus():
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{k}" for a in ("wort", "Été", "x", "ÄB", "日本", "9") for k in range(30)]
    rows = [(k, " ".join(rng.choice(vocabulary, rng.integers(0, 90)))) for k in range(300)]
    rows += [(400, None), (401, ""), (402, " \t--,."), (403, "a"), (404, "A,a\x00b  B-c\nD" * 9), (None, "wort1 wort2 " * 20)]
    rows += [(405, "x1 " * 30)] * 3 + [(None, "wort1 wort2 " * 20), (406, "no\x7fblank" + "z" * 5000 + " É é " * 40)]
    return rows, ["wort1 wort2 wort3 Été4", None, "日本5 x1 a", ""]


def test_equals_brute_force(spark):
    rows, target = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("own")).withColumn("row", F.lit(1))
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for run, least, percent in (1, 20, 10), (3, 5, 60), (1, 1, 100):
        got = resampling.resample(docs, wanted, run=run, least_words=least, percent=percent).drop("n_words")
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, run, least, percent)


def test_chunks_do_not_change_features(monkeypatch):
    import pyarrow as pa

    rows, _ = corpus()
    column = pa.array([t for _, t in rows])

    def found(size):
        monkeypatch.setattr(resampling, "CHUNK_BYTES", size)
        return [
            sorted((a + t, b) for a, _, _, runs in resampling.features(column, 2, 10_000) for t, b in zip(*[x.tolist() for x in runs[k]]))
            for k in range(2)
        ]

    assert found(1) == found(1 << 20)


def test_crc_composition():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.bytes(rng.integers(0, 40)), rng.bytes(rng.integers(0, 3000))
        got = resampling.compose(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
        assert int(got[0]) == zlib.crc32(a + b)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resampling.resample(docs, some.select("text")).count() == 0
    rows = resampling.resample(some, docs.select("text"), least_words=1, percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in rows] == [(1, 3, 1)]
    assert [r["rank"] for r in resampling.resample(some, some.select("text")).collect()] == [None]
