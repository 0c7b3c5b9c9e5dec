"""Filter audit against a replay of every order in plain Python."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, filter_audit


def fails(text, doc_id, rows):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text or "") > 3 * len(text or ""),
        "D": any(c in "#$%&*|" for c in text or ""),
        "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows),
    }


def replay(rows, quality, toxic):
    parts = {p or "" for *_, p in rows}
    judged = [(i, p or "", fails(t, i, rows)) for i, t, p in rows]
    out, removals = {}, {}
    for order in permutations("ABCDE"):
        left = list(range(len(judged)))
        for step, f in enumerate(order, 1):
            gone = [k for k in left if judged[k][2][f]]
            for p in parts:
                of = [k for k in gone if judged[k][1] == p]
                failing = [k for k in range(len(judged)) if judged[k][1] == p and judged[k][2][f]]
                out[p, "".join(order), step] = (
                    sum(judged[k][1] == p for k in left) - len(of),
                    len(of),
                    len(failing) - len(of),
                    sum(sum(judged[k][2].values()) == 1 for k in failing),
                    sum(judged[k][0] in quality for k in of),
                    sum(judged[k][0] in toxic for k in of),
                )
                removals[p, f] = removals.get((p, f), 0) + len(of)
            left = [k for k in left if not judged[k][2][f]]
    return sorted((p, o, s, *v, removals[p, o[s - 1]]) for (p, o, s), v in out.items())


def corpus():
    rng = random.Random(4)
    rows = [(1, None, "en"), (2, "", None), (3, "  ", "en"), (None, "", "en"), (None, "same", ""), (5, "same", "de")]
    for k in range(10, 60):
        n = rng.choice([3, 150, 260, 700])
        few = rng.random() < 0.4
        words = [("w%d" % rng.randrange(40 if few else 5000)) for _ in range(n)]
        if rng.random() < 0.3:
            words[0] = "A" * n
        if rng.random() < 0.3:
            words[-1] = "#|"
        rows.append((k, rng.choice([" ", "\t", "\n "]).join(words), rng.choice(["en", "de", None])))
    rows += [(rng.randrange(100, 200), t, p) for _, t, p in rng.choices(rows, k=30)]
    return rows + [rows[-1]] * 3 + [(None, rows[-1][1], "fr")] * 2


@pytest.mark.parametrize("small", [False, True])
def test_equals_replay(spark, monkeypatch, small):
    if small:  # no broadcast, and every shared text is hot
        monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(common, "SALT_ROWS", 2)
    rows = corpus()
    ids = [i for i, *_ in rows if i is not None]
    labels = [(i, i % 2, i % 3 == 0) for i in ids[::2]] + [(ids[0], 1, 1), (None, 1, 1), (ids[3], None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumn("hash", F.lit(1)).withColumn("salt", F.lit("x")).withColumn("mask", F.lit(9))
    marks = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, marks)
    quality = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t is not None and int(t) == 1 and i is not None}
    assert sorted(tuple(r) for r in got.collect()) == replay(rows, quality, toxic)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert filter_audit.audit(one, labels).where("removed = 1").count() == 120
