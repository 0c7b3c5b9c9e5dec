"""Language ID by averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed byte n-grams (2 to 4
bytes, A-Z lower-cased, every run of white space, digits and ASCII marks
one blank), followed by a linear softmax. Embeddings and softmax are
trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled rows (``SAMPLE_ROWS`` per language, the smallest
hashes, none over ``SAMPLE_CHARS`` characters, of the ``LANGS`` most
frequent languages).

Rejection: the softmax has one class more, for texts in no learned
language. It is trained on negatives made from the sample by rule: its
texts with their letters shuffled, random Latin letters, and random
letters of other alphabets. One part of the sample is kept from training
to calibrate the temperature of the scores and the share of that class
above which a text is rejected, so that KEEP_SHARE of the rightly
predicted rows stay. A score is the softmax over the languages alone.

The model is linear behind the mean, so each n-gram's embedding times the
softmax matrix is one row of a (buckets, languages + 1) table. Its size is
fixed by parameters; it is shipped to the tasks and applied to whole texts
in windows of bounded size, also within one long text.

A null text or one without a letter gives ``und``, score 0, rejected. Rows
without a known language are predicted but not learned from. With nothing
to learn from, everything is ``und``. Repeated rows are predicted alike and
count once in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm.common import utf8

SAMPLE_ROWS = 600  # per language
LANGS = 200  # learned at most, the most frequent
SAMPLE_CHARS = 20_000
BUCKET_BITS = 15
DIM = 16
EPOCHS = 4
RATE = 0.5
GRAMS = (2, 3, 4)
KEEP_SHARE = 0.999  # of right calibration rows that must not be rejected
NEGATIVES = 0.5  # made for each training row
WINDOW_BYTES = 1 << 18  # scored at a time
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
# Ranges of letters of other alphabets, for negatives.
_ALPHABETS = [(0x3B1, 0x3C9), (0x430, 0x44F), (0x561, 0x586), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (buckets, languages + 1) float32; the last column is "none of them"
    bias: np.ndarray
    temperature: float
    reject_above: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _grams(raw: np.ndarray) -> list[np.ndarray]:
    """Hash bucket of the n-gram starting at each byte, per n."""
    folded = _FOLD[raw].astype(np.uint32)
    code = folded.copy()
    out = []
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint32(0x01000193) + folded[n - 1 :] if len(code) > 1 else code[:0]
        if n in GRAMS:
            h = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            h ^= h >> np.uint32(12)
            out.append((h * np.uint32(0x297A2D39)) >> np.uint32(32 - BUCKET_BITS))
    return out


def _counts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate(_grams(raw)) if len(raw) else np.zeros(0, np.uint32)
    return np.unique(grams, return_counts=True)


def negatives(texts: list[str], rng: np.random.Generator) -> list[str]:
    """Texts in no language: shuffled letters of the given ones, random
    Latin letters, random letters of other alphabets, in equal parts."""
    out = []
    for k, text in enumerate(texts):
        words = text.split()[: int(rng.integers(3, 200))]
        sizes = [len(w) for w in words]
        letters = np.array(list("".join(words)))
        if k % 3 == 0:
            letters = rng.permutation(letters)
        else:
            low, high = (97, 122) if k % 3 == 1 else _ALPHABETS[int(rng.integers(len(_ALPHABETS)))]
            letters = np.array([chr(c) for c in rng.integers(low, high + 1, len(letters))])
        ends = np.cumsum([0, *sizes])
        out.append(" ".join("".join(letters[a:b]) for a, b in zip(ends[:-1], ends[1:])))
    return out


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model | None:
    """SGD over documents, one at a time; a fifth calibrates."""
    langs = sorted(set(labels))
    none = len(langs)
    rng = np.random.default_rng(seed)
    counted = lambda t: _counts(np.frombuffer(t.encode(), np.uint8))
    rows = [(counted(t), langs.index(y)) for t, y in zip(texts, labels)]
    rows = [r for r in rows if len(r[0][0])]
    if not rows:
        return None
    picked = [texts[i] for i in rng.permutation(len(texts))[: int(NEGATIVES * len(texts)) + 1]]
    rows += [r for r in ((counted(t), none) for t in negatives(picked, rng)) if len(r[0][0])]
    order = rng.permutation(len(rows))
    calibration = [rows[i] for i in order[::5]] if len(rows) >= 20 else rows
    training = [rows[i] for k, i in enumerate(order) if k % 5] if len(rows) >= 20 else rows
    emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, none + 1)).astype(np.float32)
    bias = np.zeros(none + 1, np.float32)
    steps, done = EPOCHS * len(training), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(training)):
            (bucket, count), y = training[k]
            rate = RATE * (1 - done / steps)
            share = (count / count.sum()).astype(np.float32)
            hidden = share @ emb[bucket]
            z = hidden @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = soft @ p
            soft -= rate * np.outer(hidden, p)
            bias -= rate * p
            # sparse features: the mean's gradient, scaled up to the inputs
            emb[bucket] -= (rate * 20) * share[:, None] * back[None, :]
            done += 1
    table = emb @ soft
    z = np.array([(c / c.sum()) @ table[b] + bias for (b, c), _ in calibration])
    y = np.array([y for _, y in calibration])

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))

    temperature = float(min(np.geomspace(0.01, 10, 90), key=loss))
    p = _softmax(z / temperature)
    right = (y < none) & (p[:, :none].argmax(axis=1) == y)
    strange = np.sort(p[right, none]) if right.any() else np.zeros(1)
    # all right rows but a share stay, with room to the next
    worst = float(strange[min(len(strange) - 1, int(KEEP_SHARE * len(strange)))])
    return Model(langs, table.astype(np.float32), bias, temperature, max(0.5, (1 + worst) / 2))


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, rows_per_lang: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS, langs: int = LANGS) -> DataFrame:
    """Bounded training sample (text, lang): per language the rows of the
    smallest hashes of id and text, outside the held-out fold; one of
    repeated rows. At most rows_per_lang x langs rows."""
    pick = docs.where(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
        & (F.length("text") <= max_chars)
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    most = pick.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(langs)
    nth = F.dense_rank().over(Window.partitionBy("lang").orderBy("h"))
    first = pick.select("lang", "h").withColumn("nth", nth).where(F.col("nth") <= rows_per_lang)
    cuts = first.groupBy("lang").agg(F.max("h").alias("cut")).join(F.broadcast(most.select("lang")), "lang")
    chosen = pick.join(F.broadcast(cuts), "lang").where("h <= cut")  # at most ``langs`` rows are broadcast
    return chosen.groupBy("lang", "h").agg(F.first("text").alias("text")).select("text", "lang")


def fit(docs: DataFrame) -> Model | None:
    rows = sorted((r["lang"], r["text"]) for r in sample(docs).collect())
    return train([t for _, t in rows], [y for y, _ in rows])


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    """Mean table row of each text's n-grams, plus bias. The bytes of a
    batch are taken in windows; an n-gram belongs to the text in which it
    starts, and must end in it."""
    raw, offsets = utf8(column)
    n, classes = len(offsets) - 1, model.table.shape[1]
    total, grams = np.zeros((n, classes)), np.zeros(n)
    # one contiguous row per class; a last cell, 0, for what is no n-gram
    table = np.ascontiguousarray(np.vstack([model.table, np.zeros((1, classes), np.float32)]).T)
    nothing = table.shape[1] - 1
    for a in range(0, len(raw), WINDOW_BYTES):
        part = raw[a : a + WINDOW_BYTES + max(GRAMS) - 1]
        b = min(a + WINDOW_BYTES, len(raw))
        first, last = int(np.searchsorted(offsets, a, "right")) - 1, int(np.searchsorted(offsets, b, "left"))
        begins, ends = np.maximum(offsets[first:last], a), offsets[first + 1 : last + 1]
        some = np.flatnonzero(ends > begins)
        begins, ends, text = begins[some], ends[some], first + some
        for n_bytes, h in zip(GRAMS, _grams(part)):
            cells = np.full(b - a, nothing, np.int32)
            cells[: min(len(h), b - a)] = h[: b - a]
            for k in range(1, n_bytes):
                late = ends - k
                cells[late[(late >= begins) & (late < b)] - a] = nothing
            grams[text] += np.maximum(np.minimum(ends - n_bytes + 1, b) - begins, 0)
            for c in range(classes):
                total[text, c] += np.add.reduceat(table[c][cells], begins - a)
    return total / np.maximum(grams, 1)[:, None] + model.bias


def _label(model: Model | None, column: pa.Array) -> pa.StructArray:
    n = len(column)
    if model is None:
        names, score, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
    else:
        z = _scores(model, column) / model.temperature
        letter = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        of = _softmax(z[:, :-1]) if n else z[:, :-1]
        names = np.where(letter, np.array([*model.langs], object)[of.argmax(axis=1)] if n else [], UNKNOWN).tolist()
        score = np.where(letter, of.max(axis=1, initial=0.0), 0.0)
        rejected = ~letter | ((_softmax(z)[:, -1] if n else np.zeros(0)) > model.reject_above)
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
        names=["lang_pred", "score", "rejected"],
    )


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = _label(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *labels.flatten()],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with their own
    columns. Fits the model on ``docs`` unless one is given."""
    model = fit(docs) if model is None else model
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = _label(model, batch.column(at)).field("rejected")
            yield batch.filter(pc.invert(rejected))

    return docs.mapInArrow(run, docs.schema)
