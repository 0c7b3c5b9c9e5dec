"""Suffix dedup against brute force over all windows."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import suffix_dedup as S


def brute(rows, width=50):
    raw = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in raw:
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - width + 1):
            low = first.get(b[s : s + width])
            if low is not None and (i is None or low < i):
                gone[s : s + width] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((str(i), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "éa", "thing", "and", "ou", "\x00", "😀", "tion", "  "]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    shared = [prose(k) for k in (8, 12, 30, 100)] + ["ab" * 60, "x" * 140, "x" * 50]
    texts = [None, "", "short", "x" * 49, "x" * 50, "x" * 51, "ab" * 100]
    for _ in range(60):
        parts = [prose(rng.randrange(1, 30))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(shared)[rng.randrange(5) :], prose(rng.randrange(3))]
        texts.append("".join(parts))
    texts += [texts[20], texts[20], texts[30][:-3], texts[31][60:]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def got(docs):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.report(docs).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 4000)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit(1)).withColumn("mark", F.lit(1))
    assert got(docs) == brute(rows)


def test_edges(spark):
    text = "a passage of more than fifty bytes that is said again and again by all"
    rows = [(None, text), (5, text), (5, text), (3, "z" + text + "z"), (7, None), (8, text[:49])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == brute(rows)
    assert got(docs.limit(0)) == []


def test_merge_equals_sorting():
    rng = np.random.default_rng(4)
    segments = [bytes(rng.integers(97, 99, rng.integers(50, 80), dtype=np.uint8)) for _ in range(40)]
    segments += [segments[0][3:] + b"abc", segments[1][:60] if len(segments[1]) > 60 else segments[1] + b"q"]
    ids = rng.permutation(len(segments)).astype(np.int64)
    want = {}
    for s, i in zip(segments, ids):
        for a in range(len(s) - 49):
            want[s[a : a + 50]] = min(want.get(s[a : a + 50], 10**9), i)
    found = S.smallest_ids(segments, ids).tolist()
    assert found == [want[s[a : a + 50]] for s in segments for a in range(len(s) - 49)]


def test_hot_anchor_is_spread(spark, monkeypatch):
    """A phrase between different words in every document: the anchors in
    it are hot, and no bucket grows with the number of documents."""
    monkeypatch.setattr(S, "BLOCK_BYTES", 8000)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    phrase = "of the said party of the first part herein be"
    rows = []
    for i in range(400):
        middle = phrase if i % 3 else phrase + " and of the second part" + ("" if i % 2 else " also")
        rows.append((i, f"{word()} {word()} {middle} {word()} {word()}"))
    rows += [(900, rows[7][1]), (None, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(docs) == brute(rows)
    # as blocks would send them: one entry per distinct window, dealt by its bytes
    raw = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for _, t in rows])
    _, first, last, text = S.anchor_runs(raw, offsets)
    found = S.hot_windows(raw, offsets, np.arange(len(rows)), first, last, text)
    sizes = [len(at) for _, at in S._by(found["key"], 40)]
    assert len(sizes) == 40 and max(sizes) < 2 * len(found) / 40


def test_hot_windows_with_one_hash(monkeypatch):
    """Windows that share a hash are told apart by their bytes."""
    monkeypatch.setattr(S, "window_keys", lambda raw: np.zeros(max(0, len(raw) - 49), np.uint64))
    texts = [b"a" * 52, b"b" * 51, b"a" * 51]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    ids = np.array([4, 5, 6])
    first, last = offsets[:-1], offsets[1:] - 50
    found = S.hot_windows(raw, offsets, ids, first, last, np.arange(3))
    assert {(w["body"].tobytes()[:1], int(w["id"])) for w in found} >= {(b"a", 4), (b"b", 5)}
    low = {b"a": 4, b"b": 2}
    told = np.array([(w["text"], w["at"], low[w["body"].tobytes()[:1]]) for w in found], S._TOLD)
    assert S.hot_places(raw, offsets, ids, told).tolist() == [52, 53, 103, 104]
