"""Native operators against brute force in plain Python."""

import hashlib
import re

from pyspark.sql import functions as F

from ledgerloom.llm import pii, quality_rules, quote_threads

BLANK = re.compile(r"[\x20\x09-\x0D]+")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


PII_TEXTS = [
    None,
    "",
    "no data here",
    "mail a.b+c@x-y.co.uk, or A@B.c_d@e.f.g and @x.y z@w",
    "ips 1.2.3.4.5.6.7.8 256.1.1.1 001.02.003.255 1.2.3 99999999999999999999.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  111111111111, 12345678901234567890123",
    "phone +1 (319) 555-5132. +44.20.7946.0958 +123 ++1234567890+ +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6",
    "ünïcode 😀 z@ü.com q@mail.example.com 😀 4111111111111111  41111111",
    "1 2 3 4 " * 4000 + "a@b" + ".c" * 3000 + " " + "9" * 2000,
    "a@b.c" * 3 + "@d.e",
    "10.0.0.1" * 4,
]


def test_base_spans_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string")
    for r in pii.report(docs).collect():
        want = brute_spans(PII_TEXTS[r["doc_id"]])
        assert r["spans"] == ",".join(want), r["doc_id"]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(w.startswith(k) for w in want) for k in BASE
        ]


def test_disclosing_terms_are_removed_and_common_ones_stay(spark):
    rows = []
    for i in range(6):  # the nickname only stands by the entity, in different contexts
        rows.append((i, f"the talk{'x' * i} was zorblax boss@corp.example.com and the day{'y' * i}"))
    for i in range(6, 60):
        rows.append((i, "the talk was long and the day of the week"))
    for i in range(60, 70):  # copies are one context
        rows.append((i, "hidden wexford copy@corp.example.com hidden"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert all(spans[i].count("term") == 1 for i in range(6))
    assert all("term" not in spans[i] for i in range(6, 70))
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert texts[0] == "the talk was  [EMAIL] and the day"
    assert texts[60] == "hidden wexford [EMAIL] hidden"


def test_copies_of_a_passage_veto_no_disclosure(spark):
    rows = [(i, f"a{'x' * i} b{'y' * i} zorblax boss@corp.example.com c{'z' * i} d{'w' * i}") for i in range(3, 8)]
    rows += [(i, "greetings from zorblax boss@corp.example.com and company") for i in range(10, 30)]
    rows += [(i, "greetings from some other company and so on") for i in range(30, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert not [i for i, t in texts.items() if "zorblax" in t]
    assert texts[10] == "greetings from  [EMAIL] and company"


def test_disclosing_terms_go_anywhere_in_the_entity_documents(spark):
    far = " ".join(["the day of the week was long and the talk of the town went on"] * 3)
    rows = [(i, f"a{'x' * i} zorblax b{'y' * i}. {far}. boss@corp.example.com, {far} c{'z' * i} Zorblax") for i in range(3, 9)]
    rows += [(i, f"{far} {i}") for i in range(10, 100)]
    rows += [(i, "mail copy@corp.example.com " + far + " hidden wexford hidden") for i in range(100, 110)]
    rows.append((None, f"{far} boss@corp.example.com {far} zorblax {far}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    for i, text in rows:
        at = [m.start() for m in re.finditer("zorblax", text.lower())]
        assert [int(x.split(":")[1]) for x in found[i].split(",") if x.startswith("term")] == at
    texts = [r["text"].lower() for r in pii.sanitise(docs).collect()]
    assert not [t for t in texts if "zorblax" in t] and sum("wexford" in t for t in texts) == 10


def test_pii_edges(spark):
    rows = [(None, "a@b.cd"), (1, "a@b.cd"), (1, "a@b.cd"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("x"))
    got = sorted((str(r["doc_id"]), r["spans"]) for r in pii.report(docs).collect())
    assert got == [("1", "email:0:6"), ("1", "email:0:6"), ("2", ""), ("None", "email:0:6")]
    assert pii.report(docs.limit(0)).collect() == []


def brute_stats(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else set()
    marked = {i + j for i, g in enumerate(grams) if g in twice for j in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked),
    )


def test_statistics_equal_brute_force(spark):
    texts = [
        None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h i " * 3, "x # $ <y>\nx # $ <y>\n\n \nz",
        "w " * 40, "é 😀 ö\x0bq\x0cr\x85s t", " ".join(f"w{i % 50}" for i in range(300)), "a a a a a a a a a b " * 4 + "tail",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("w", F.lit(1))
    for r in quality_rules.judge(docs, []).collect():
        want = brute_stats(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality_rules.STATISTICS) == want, r
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"])


def test_long_text_statistics(spark):
    docs = spark.createDataFrame([(0, " ".join(f"w{i}" for i in range(120000)) + " w1 w2 w3 w4 w5 w6 w7 w8")], "doc_id long, text string")
    r = quality_rules.statistics(docs).first()
    assert (r["n_words"], r["n_repeat_words"]) == (120008, 16)


def test_decision_list_learns_thresholds(spark):
    rows = [({"a": float(i % 10), "b": float(i % 7)}, int(i % 10 >= 8 and i % 7 < 3)) for i in range(2000)]
    rules = quality_rules.learn(rows)
    assert rules
    wrong = sum(any(quality_rules.covers(r, x) for r in rules) != bool(y) for x, y in rows)
    assert wrong == 0
    assert quality_rules.learn([]) == []


def test_quality_edges(spark):
    docs = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 0)], "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    assert rules == []
    assert quality_rules.judge(docs, rules).count() == 3
    assert quality_rules.judge(docs.limit(0), rules).count() == 0


def test_quotes_link_and_leave(spark):
    rows = [
        (1, 0, "user", "Where is the\nred house?"),
        (1, 1, "assistant", "By the lake."),
        (1, 2, "user", "On Monday Bo wrote:\n> where is the red house?\n\nStill unclear."),
        (1, 3, "assistant", "> > Where is\n> > the red house?\n> By the   LAKE.\nYes."),
        (1, 4, "user", "> never said\nok"),
        (2, 0, "user", "By the lake."),
        (None, 0, "user", "> By the lake.\nhm"),
        (3, None, "user", None),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(5))
    got = {(r["conv_id"], r["turn"]): r for r in quote_threads.link(messages).collect()}
    assert len(got) == len(rows)
    reply = {k: v["reply_to"] for k, v in got.items()}
    assert [reply[(1, t)] for t in range(5)] == [None, 0, 0, 1, 3]
    assert got[(1, 2)]["clean_text"] == "Still unclear."
    assert got[(1, 3)]["clean_text"] == "Yes." and got[(1, 3)]["n_linked"] == 2
    assert (got[(1, 4)]["n_quotes"], got[(1, 4)]["n_linked"], got[(1, 4)]["depth"]) == (1, 0, 3)
    assert reply[(None, 0)] is None and reply[(2, 0)] is None and got[(3, None)]["clean_text"] == ""
    assert quote_threads.link(messages.limit(0)).count() == 0


def test_latest_before_over_blocks(spark):
    turns = [(1, "h", t, t % 5000 == 0) for t in range(0, 12000, 250)]
    events = spark.createDataFrame(turns, "c long, hash string, turn long, own boolean")
    for r in quote_threads.latest_before(events, ["c", "hash"]).collect():
        want = [t for _, _, t, own in turns if own and t < r["turn"]]
        assert r["found"] == (max(want) if want else None)


def test_long_chain_depth(spark):
    rows = [(7, t, "user", f"m{t}") for t in range(300)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["depth"], r["thread"]) for r in quote_threads.link(messages).collect()}
    assert got == {t: (t, 0) for t in range(300)}


def test_quality_labels_out_of_range_and_repeated(spark):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(k, good if k % 2 else "#|# " * 40) for k in range(40)] + [(3, good)] * 5 + [(None, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(k, k % 2) for k in range(40)] + [(3, 1)] * 4 + [(3, 7), (5, -1), (6, None), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    assert rules == quality_rules.fit(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), labels.where("quality in (0, 1)").distinct())
    odd = labels.select("doc_id", (F.col("quality") + 2).alias("quality"))
    assert quality_rules.fit(docs, odd) == [] and quality_rules.judge(docs, []).count() == len(rows)
