"""Pipeline stages, packing, mixing, exact dedup, language ID and URL
filter against brute force, and their edge cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.test_near_dedup import brute_components
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import exact_dedup, langid, mixing, near_dedup, packing, url_filter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, text string"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def brute_targets(sizes):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while len(fixed) < len(names):
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}
    return fixed


def check_mix(before, after):
    """``before`` and ``after``: (doc_id, source, text) rows."""
    size, took = Counter(), Counter()
    own = defaultdict(list)
    for doc_id, source, text in before:
        size[source] += len(words(text))
        own[doc_id].append(text)
    for doc_id, source, text in after:
        took[source] += len(words(text))
        assert any(t is not None and t.startswith(text) for t in own[doc_id])
    want = brute_targets(size)
    for source in size:
        assert abs(took[source] - want[source]) < 1 + 1e-6 * want[source], source


def check_pieces(rows, texts, encode):
    """Every id of ``texts`` (doc_id, text) in one piece; gapless sequences."""
    want, got, at = defaultdict(Counter), defaultdict(Counter), defaultdict(list)
    for doc_id, text in texts:
        for k, i in enumerate(encode(text)):
            want[doc_id][(k, i)] += 1
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0
        for k, i in enumerate(ids.tolist()):
            got[r["doc_id"]][(r["start"] + k, i)] += 1
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE_TOKENS and len(pieces) <= packing.MAX_SEGMENTS


def test_pipeline_stage_by_stage(spark, encode):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    extra = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, " 12 34 ")]
    planted = spark.createDataFrame(extra, "doc_id long, text string")
    docs = docs.unionByName(planted, allowMissingColumns=True)
    frames, kept = [], docs
    for name, stage in corpus_pipeline.STAGES:
        kept = near_dedup.written(stage(spark, kept, SF), f"test-{name}")
        frames.append([r.asDict() for r in kept.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == columns
    first, exact, near, mixed, pieces = frames
    ids = lambda rows: sorted(r["doc_id"] for r in rows)
    # language ID: what has no letter goes, clean documents stay
    everything = docs.collect()
    letters = {r["doc_id"] for r in everything if any(c.isalpha() for c in r["text"] or "")}
    assert set(ids(first)) <= letters and len(first) >= 0.97 * len(letters)
    # exact
    best = {}
    for r in first:
        key = norm(r["text"])
        best[key] = min(best.get(key, r["doc_id"]), r["doc_id"])
    assert ids(exact) == sorted(best.values())
    # near
    rows = [(r["doc_id"], r["text"]) for r in exact]
    assert ids(near) == sorted(d for d, _, low in brute_components(rows, 5, 80) if d == low)
    # mixing, packing
    check_mix([(r["doc_id"], r["source"], r["text"]) for r in near], [(r["doc_id"], r["source"], r["text"]) for r in mixed])
    check_pieces(pieces, [(r["doc_id"], r["text"]) for r in mixed], encode)


def test_packing_edges(spark, encode):
    texts = ["", None, "a", "word " * 9000, "é😀\n" * 50, "x" * 3000, "<|endoftext|>", "a", "x <|endoftext|><|endoftext|> y <|endoftext", *["t%d" % k * (k % 40) for k in range(300)]]
    rows = [(k if k else None, t) for k, t in enumerate(texts)] + [(3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("ids", F.lit(1))
    out = packing.pack(docs.repartition(2)).collect()
    check_pieces(out, rows, encode)
    for r in out:
        assert r["start"] + r["length"] <= r["doc_tokens"]
    assert packing.pack(docs.limit(0)).count() == 0
    assert sum(r["n"] for r in packing.digest_pieces(packing.pack(docs)).groupBy().agg(F.sum("length").alias("n")).collect()) == sum(len(encode(t)) for _, t in rows)


def test_packing_limits_on_loss_and_segments(spark):
    docs = spark.createDataFrame([(k, "red blue " * (k % 30 + 1)) for k in range(200)], "doc_id long, text string")
    out = packing.pack(docs.coalesce(1), sequence_tokens=256, max_segments=4, max_loss=150, loss_from=5).collect()
    per = defaultdict(lambda: [0, 0, 0])
    for r in out:
        for k, v in enumerate((r["length"], 1, r["loss_tokens"])):
            per[r["sequence_id"]][k] += v
    assert all(t <= 256 and s <= 4 and loss <= 150 for t, s, loss in per.values())


def test_mixing_equals_brute_force(spark):
    rows = [(k, ["b", "a", None, "c"][min(k % 7, 3)], None, " ".join(["w"] * (k * 37 % 23))) for k in range(400)]
    rows += [(None, "a", None, "x y z"), (5, "c", None, None), (6, "c", None, ""), (7, "c", None, rows[7][3])]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("target", F.lit("clash")).withColumn("_size", F.lit(0))
    plan = [r.asDict() for r in mixing.plan_mix(docs).collect()]
    assert len(plan) == len(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in plan)
    assert Counter(r["size"] for r in plan) == Counter(len(words(t)) for _, _, _, t in rows)
    size = Counter()
    for _, s, _, t in rows:
        size[s] += len(words(t))
    want = brute_targets(size)
    assert all(any(abs(r["target"] - w) < 1e-6 and r["source_size"] == size[s] for s, w in want.items()) for r in plan)
    key = lambda r: tuple(str(v) for v in r.values())
    again = [r.asDict() for r in mixing.plan_mix(docs.repartition(3)).collect()]
    assert sorted(map(key, again)) == sorted(map(key, plan))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    check_mix([(d, s, t) for d, s, _, t in rows], [(r["doc_id"], r["source"], r["text"]) for r in mixed.collect()])
    assert mixing.plan_mix(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_mixing_of_empty_texts_only(spark):
    docs = spark.createDataFrame([(1, "a", None, ""), (2, None, None, None)], SCHEMA)
    assert [(r["size"], r["taken"]) for r in mixing.plan_mix(docs).collect()] == [(0, 0)] * 2
    assert mixing.mix(docs).count() == 0


def test_exact_dedup_edges(spark):
    texts = ["a  b", "a\tb", " a b", None, "", "  ", "é", "A b", "x" * 300000, "x" * 300000, "a b"]
    rows = [(k + 1, "s", None, t) for k, t in enumerate(texts)] + [(None, "s", None, "é"), (None, "s", None, "only"), (3, "s", None, " a b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit("clash")).withColumn("winner", F.lit(2))
    groups = defaultdict(list)
    for d, _, _, t in rows:
        groups[norm(t)].append(d)
    got = exact_dedup.group_documents(docs).collect()
    assert len(got) == len(rows)
    least = lambda ds: min((d for d in ds if d is not None), default=None)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == Counter((d, least(ds), len(ds)) for ds in groups.values() for d in ds)
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns and Counter(norm(r["text"]) for r in kept.collect()) == Counter(groups.keys())
    past = spark.createDataFrame([(100, "é"), (101, "A  b"), (102, "never seen"), (103, "é"), (103, "A b")], "doc_id long, text string")
    history = past.select(exact_dedup.digest_of(F.col("text")).alias("digest"), F.col("doc_id").alias("winner"))
    left = exact_dedup.keep_distinct(docs, history).collect()
    assert Counter(norm(r["text"]) for r in left) == Counter(k for k in groups if k not in ("é", "A b"))
    assert exact_dedup.group_documents(docs.limit(0)).count() == 0 and exact_dedup.keep_distinct(docs.limit(0)).count() == 0


def test_exact_dedup_history_and_new_rows(spark):
    """Digests of the historical half only, of the other half only, and of
    both: each gets one verdict, over all its rows."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.floor(F.col("id") / F.when(F.col("id") < 200, 1).otherwise(5)).cast("string")).alias("text"))
    rows = docs.select("doc_id", exact_dedup.digest_of(F.col("text")).alias("digest"), "text", exact_dedup.historical(F.col("doc_id")).alias("old")).collect()
    want = defaultdict(list)
    for r in rows:
        want[bytes(r["digest"])].append((r["doc_id"], r["old"]))
    got = exact_dedup.decide(docs.select("doc_id", exact_dedup.digest_of(F.col("text")).alias("digest"))).collect()
    assert sorted((bytes(r["digest"]), r["keep_id"], r["group_size"], r["member"]) for r in got) == sorted(
        (d, min(ids)[0], len(ids), any(old for _, old in ids)) for d, ids in want.items()
    )
    kinds = {frozenset(old for _, old in ids) for ids in want.values()}
    assert kinds == {frozenset({True}), frozenset({False}), frozenset({True, False})}


def test_minimal_perfect_hash(spark):
    digests = np.random.default_rng(3).integers(0, 256, (5000, 32), dtype=np.uint8)
    sizes, bits, slots = exact_dedup.build_mphf(digests)
    assert sorted(slots.tolist()) == list(range(5000))
    assert (exact_dedup.lookup_mphf(sizes, bits, digests) == slots).all()


def test_language_id_held_out_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = docs.select("doc_id", "lang").join(langid.predict(docs, model), "doc_id").where("held_out and lang is not null").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ."), (None, "the house"), (5, "ein Haus " * 50000)], "doc_id long, text string")
    odd = odd.withColumn("score", F.lit("clash")).withColumn("lang", F.lit(None).cast("string"))
    got = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and got[k]["rejected"] for k in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[None]["lang_pred"] in model.langs
    assert langid.keep_identified(odd, model).columns == odd.columns
    assert langid.fit(odd) is None and {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_language_id_rejects_and_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r["lang"], r["text"]) for r in langid.sample(docs, rows_per_lang=150).collect())
    model = langid.train([t for _, t in rows], [y for y, _ in rows])
    strange = ["これは日本語の文章です", "Η γρήγορη καφέ αλεπού πηδάει πάνω", "זהו משפט בעברית", "Быстрая лиса прыгает", "asdf jkl qwer zxcv uiop hjkl vbnm", "½ ² ③"]
    assert all(r["rejected"] for r in langid._label(model, pa.array(strange)).to_pylist())
    made = langid.negatives([t for _, t in rows], np.random.default_rng(99))
    gone = [r["rejected"] for r in langid._label(model, pa.array(made)).to_pylist()]
    assert np.mean(gone) >= 0.95
    kept = langid.predict(docs, model).where("held_out and lang_pred <> 'und'").collect()
    assert np.mean([not r["rejected"] for r in kept]) >= 0.97

    def brute(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        cells = np.concatenate(langid._grams(raw)) if len(raw) else np.zeros(0, int)
        return model.table[cells].sum(axis=0) / max(1, len(cells)) + model.bias

    texts = ["", "ab", "Der Hund", "x" * 3000, None, " Über dem ", "y", "é" * 40] * 5
    for size in (1, 5, 64, 1 << 18):
        monkeypatch.setattr(langid, "WINDOW_BYTES", size)
        assert np.abs(langid._scores(model, pa.array(texts)) - [brute(t) for t in texts]).max() < 1e-3


def test_language_sample_is_bounded(spark):
    rows = [(1, "ein Haus %d" % (k % 3), "de") for k in range(300)] + [(2 + k, "a house %d" % k, "en") for k in range(50)] + [(900, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = Counter(r["lang"] for r in langid.sample(docs, rows_per_lang=20).collect())
    assert got["en"] == 20 and got["de"] <= 3 and set(got) <= {"de", "en"}
    assert {r["lang"] for r in langid.sample(docs, rows_per_lang=20, langs=1).collect()} <= {"de"}


def test_url_filter_edges(spark):
    cases = [
        (1, None, "", "", None, "allow"), (2, "no scheme", "", "", None, "allow"), (3, "http://A.NET", "a.net", "", None, "allow"),
        (4, "http://A.NET/x", "a.net", "/x", "net/", "block"), (5, "s://example.net/en/", "example.net", "/en/", "example.net/en/", "allow"),
        (6, "s://x.example.com/de/q?x=1#y", "x.example.com", "/de/q", "example.com/de/", "block"), (7, "s://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        (10, "http://evil.com/x.net /y", "evil.com", "/x.net /y", None, "allow"), (11, "http://a.com/b.org /fr/z", "a.com", "/b.org /fr/z", None, "allow"),
        (8, "s://q.org/fr/a", "q.org", "/fr/a", "org/fr/", "allow"), (None, "s://net/", "net", "/", "net/", "block"),
        (9, "s://é.net/" + "p" * 70000, "é.net", "/" + "p" * 70000, "net/", "block"), (9, "", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([c[:2] for c in cases], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()]
    assert Counter(got) == Counter((c[0], *c[2:]) for c in cases)
    assert url_filter.judge(pages.limit(0)).count() == 0
