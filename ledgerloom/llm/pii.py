"""PII by information-theoretic sanitisation.

Base entities are found by fixed patterns (email, ip, card, phone). A
term in the documents of an entity discloses it in so far as seeing the
term predicts the entity: with document counts over the whole corpus, the
pointwise mutual information of entity and term is compared with the
entity's own information, log2(N / df(entity)). Their ratio is 1 for a
term that only occurs with the entity and 0 for an unrelated one. In all
documents that hold the entity, every occurrence of a term that reaches
``GENERALISE`` is replaced by a general mark, and of one that reaches
``REMOVE`` is removed.

The ``CONTEXT_WORDS`` terms on either side of an occurrence are its
context. A pair counts only with ``MIN_CONTEXTS`` different contexts, in
as many documents that differ in them, each counted once: copies of one
passage disclose nothing by repetition, and however many there are they
veto no pair. An edited copy is a context of its own where the edit is
near the term.

All counts cover all documents. Only Spark's own functions are used.
Quantifiers are possessive or single character classes, so long runs do
not recurse; separators inside card numbers and host names are replaced by
one private character of equal length before matching.

Null texts are empty and have no spans. Repeated rows are separate rows
with the same spans. Empty tables give empty results. Rows with a null
doc_id get their spans; they count in no statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written
from ledgerloom.llm.native import let, matches

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS = 4
MIN_CONTEXTS = 3
GENERALISE = 0.8
REMOVE = 0.95
MARK = "\ue000"  # private use; such characters of a text match no pattern

LOCAL = rf"A-Za-z0-9._%+{MARK}-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@(?=[A-Za-z0-9-]+{MARK})[A-Za-z0-9{MARK}-]++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
CARD = rf"[0-9{MARK}]{{2,}}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}]{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.cast("int"), F.lit(0)))
    return F.aggregate(F.transform(each, doubled), F.lit(0), lambda a, x: a + x) % 10 == 0


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")


def _of_kind(kind: str, found: Column) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), m["value"].alias("value")
        ),
    )


def base_spans(text: Column) -> Column:
    """array<struct(start, rank, end, value)> by start, then kind."""
    free = F.translate(text, MARK, "\ufffd")
    mail_text = F.regexp_replace(free, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)
    card_text = F.regexp_replace(free, r"(?<=[0-9])[ -](?=[0-9])", MARK)

    def in_range(m: Column) -> Column:
        return F.forall(F.split(m["value"], r"\."), lambda p: p.rlike(IP_PART))

    def is_card(m: Column) -> Column:
        return let(_digits(m["value"]), lambda d: F.length(d).between(14, 19) & _luhn(d))

    def is_phone(m: Column) -> Column:
        return F.length(_digits(m["value"])).between(10, 15)

    def when(test: Column, found: Column) -> Column:
        return F.when(test, found).otherwise(_none())

    email = when(free.rlike(r"@[A-Za-z0-9-]+\."), matches(mail_text, EMAIL))
    ip = when(free.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), F.filter(matches(free, IP), in_range))
    long_digits = free.rlike(r"[0-9][0-9 -]{12,}+")
    card = when(long_digits, F.filter(matches(card_text, CARD), is_card))
    phone = when(free.rlike(r"\+[0-9]"), F.filter(matches(free, PHONE), is_phone))
    return F.sort_array(
        F.concat(_of_kind("email", email), _of_kind("ip", ip), _of_kind("card", card), _of_kind("phone", phone))
    )


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with its base spans blanked out, at equal length."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(a: Column, s: Column) -> Column:
        begin = F.greatest(a["at"], s["start"])
        gap = F.substr(text, (a["at"] + 1).cast("int"), (begin - a["at"]).cast("int"))
        blank = F.repeat(F.lit(MARK), (s["end"] - begin).cast("int"))
        taken = F.struct(F.concat(a["out"], F.array(gap, blank)).alias("out"), s["end"].alias("at"))
        return F.when(s["end"] <= a["at"], a).otherwise(taken)

    return let(
        F.aggregate(spans, zero, step), lambda p: F.concat(F.array_join(p["out"], ""), F.substr(text, (p["at"] + 1).cast("int")))
    )


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _occurrences(text: Column) -> Column:
    """array<struct(term, start, end, context)> of every term of a text;
    the context is the ``CONTEXT_WORDS`` terms on either side."""

    def each(m: Column, words: Column) -> Column:
        return F.transform(
            m,
            lambda t, i: F.struct(
                F.get(words, i).alias("term"),
                t["start"].alias("start"),
                t["end"].alias("end"),
                F.xxhash64(
                    F.least(i, F.lit(CONTEXT_WORDS)),
                    F.slice(words, F.greatest(i - (CONTEXT_WORDS - 1), F.lit(1)), F.least(i, F.lit(CONTEXT_WORDS))),
                    F.slice(words, i + 2, F.lit(CONTEXT_WORDS)),
                ).alias("context"),
            ),
        )

    return let(matches(text, TERM), lambda m: let(F.transform(m, lambda t: F.lower(t["value"])), lambda w: each(m, w)))


def _candidates(classes: DataFrame, held: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, ratio) of the pairs that reach ``GENERALISE``, in
    ``MIN_CONTEXTS`` different texts at least. ``classes`` is (sha, masked,
    times), ``held`` (sha, entity, df_entity), ``docs`` (doc_id, text) the
    whole corpus."""
    n = docs.agg(F.count(F.lit(1)).cast("double").alias("n"))
    words = classes.join(held.select("sha").distinct(), "sha", "left_semi").select("sha", "times", F.explode(_terms(F.col("masked"))).alias("term"))
    words = written(words, "words")
    several = words.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= MIN_CONTEXTS).select("term")
    in_corpus = docs.where("doc_id is not null and text is not null")
    single = (
        in_corpus.select(F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("df_term")).join(several, "term", "left_semi")
    )
    single = written(single.join(F.broadcast(n)), "single")

    def ratio(df_both: Column) -> Column:
        pmi = F.log2(df_both * F.col("n") / (F.col("df_entity") * F.col("df_term")))
        own = F.log2(F.col("n") / F.col("df_entity"))
        return F.when(own > 0, pmi / own).otherwise(F.lit(0.0))

    # no pair is in more documents than its entity or its term, which
    # bounds the ratio before pairs are counted
    most = F.least("df_entity", "df_term")
    both = words.join(single, "term").join(held, "sha").where(ratio(most) >= GENERALISE)
    return (
        both.groupBy("entity", "term", "df_entity", "df_term", "n")
        .agg(F.sum("times").alias("df_both"), F.count(F.lit(1)).alias("texts"))
        .where((F.col("texts") >= MIN_CONTEXTS) & (ratio(F.col("df_both")) >= GENERALISE))
        .select("entity", "term", ratio(F.col("df_both")).alias("ratio"))
    )


def disclosures(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(sha, start, end, ratio) of every disclosing term in the texts that
    hold its entity. ``found`` is (doc_id, sha, text, spans) of the rows
    with base spans; ``docs`` (doc_id, text) is the whole corpus."""
    firsts = [F.first(c).alias(c) for c in ("text", "spans")]
    classes = found.groupBy("sha").agg(*firsts, F.count("doc_id").alias("times"))
    entities = F.array_distinct(F.transform("spans", lambda s: F.xxhash64(s["rank"], F.lower(s["value"]))))
    classes = written(classes.select("sha", "times", _masked(F.col("text"), F.col("spans")).alias("masked"), entities.alias("entities")), "classes")
    each = classes.select("sha", "times", F.explode("entities").alias("entity"))
    often = (
        each.where("times > 0").groupBy("entity").agg(F.sum("times").alias("df_entity"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= MIN_CONTEXTS).select("entity", "df_entity")
    )
    held = written(each.select("sha", "entity").join(often, "entity"), "entities")
    pairs = written(_candidates(classes.where("times > 0").select("sha", "masked", "times"), held, docs), "pairs")
    wanted = written(held.select("sha", "entity").join(pairs, "entity"), "wanted")
    places = classes.join(wanted.select("sha").distinct(), "sha", "left_semi").select("sha", "times", F.explode(_occurrences(F.col("masked"))).alias("t"))
    places = written(places.select("sha", "times", "t.*").join(wanted, ["sha", "term"]), "places")
    # equal contexts count once, and so do texts with the same contexts
    once = places.where("times > 0").select("entity", "term", "sha", "context").distinct()
    of_text = once.groupBy("entity", "term", "sha").agg(F.bit_xor(F.xxhash64("context")).alias("all"))
    texts = of_text.select("entity", "term", "all").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("texts"))
    contexts = once.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    enough = written(
        texts.join(contexts, ["entity", "term"]).where(F.least("texts", "contexts") >= MIN_CONTEXTS).select("entity", "term"), "enough"
    )
    return places.join(enough, ["entity", "term"], "left_semi").groupBy("sha", "start", "end").agg(F.max("ratio").alias("ratio"))


def find(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, base, spans) for every row, and ``text`` if asked for:
    arrays of struct(start, rank, end, value); ``spans`` adds the terms,
    with their ratio as value."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    spanned = rows.withColumn("base", base_spans(F.col("text")))
    # texts go on only where there is a base span
    hit = F.size("base") > 0
    sha = F.when(hit, F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    held = written(
        spanned.select("doc_id", "base", sha.alias("sha"), F.col("text") if with_text else F.when(hit, F.col("text")).alias("text")),
        "spans",
    )
    found = held.where(hit).select("doc_id", "sha", "text", F.col("base").alias("spans"))
    terms = (
        disclosures(found, docs.select("doc_id", "text"))
        .select(
            "sha",
            F.struct("start", F.lit(KINDS.index("term")).alias("rank"), "end", F.col("ratio").cast("string").alias("value")).alias("t"),
        )
        .groupBy("sha")
        .agg(F.collect_list("t").alias("terms"))  # at most the terms of one text
    )
    terms = written(terms, "terms")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")
    spans = F.sort_array(F.concat("base", F.coalesce("terms", none))).alias("spans")
    kept = ["doc_id", "base", *(["text"] if with_text else [])]
    marked = held.where(hit).join(terms, "sha", "left").select(*kept, spans)
    return marked.unionByName(held.where(~hit).select(*kept, F.sort_array("base").alias("spans")))


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with base spans replaced by their kind, disclosing
    terms generalised to ``[TERM]`` or removed. Of overlapping spans the
    first one decides."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(a: Column, s: Column) -> Column:
        gone = (s["rank"] == KINDS.index("term")) & (s["value"].try_cast("double") >= REMOVE)
        mark = F.when(gone, F.lit("")).otherwise(F.get(marks, s["rank"]))
        gap = F.substr(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        taken = F.struct(F.concat(a["out"], F.array(gap, mark)).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] < a["at"], a).otherwise(taken)

    parts = F.aggregate(F.col("spans"), zero, step)
    whole = let(parts, lambda p: F.concat(F.array_join(p["out"], ""), F.substr(F.col("text"), (p["at"] + 1).cast("int"))))
    return find(docs, with_text=True).select("doc_id", whole.alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns, for every row."""
    n = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return find(docs).select(
        "doc_id",
        *[n(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_term"),
    )
