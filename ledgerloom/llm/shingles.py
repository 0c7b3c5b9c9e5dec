"""Word shingle sets of texts as 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix64, utf8

CHUNK_BYTES = 2 << 20
# Ids and digests of wanted rows are broadcast up to this count.
BROADCAST_ROWS = 300_000

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _is_word(raw: np.ndarray) -> np.ndarray:
    return (raw != 32) & ~((raw >= 9) & (raw <= 13))


def _hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    word = _is_word(raw)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_BASE, n), dtype=np.uint64, out=sums[1:])
    return (sums[last] - sums[first]) * _powers(_BASE_INV, n)[first], first


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word, in order. Long texts are hashed in
    stretches that end between words, so memory follows CHUNK_BYTES."""
    hashes, starts, a, n = [], [], 0, len(raw)
    while a < n:
        b = min(n, a + 2 * CHUNK_BYTES)
        while b < n and _is_word(raw[b - 1 : b])[0]:
            gaps = np.flatnonzero(~_is_word(raw[a:b]))
            inner = offsets[(offsets > a) & (offsets <= b)]
            cut = max(a + int(gaps[-1]) + 1 if len(gaps) else a, int(inner[-1]) if len(inner) else a)
            if cut > a:
                b = cut
                break
            b = min(n, b + CHUNK_BYTES)  # one word, longer than the stretch
        inner = offsets[(offsets >= a) & (offsets <= b)] - a
        own, first = _hashes(raw[a:b], inner)
        hashes.append(own)
        starts.append(first + a)
        a = b
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(offsets, np.concatenate(starts), "right") - 1


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, text = word_hashes(raw, offsets)
    n = len(offsets) - 1
    per_text = np.bincount(text, minlength=n) if n else np.zeros(0, np.int64)
    at = np.concatenate(([0], np.cumsum(per_text)))
    full = max(0, len(words) - size + 1)
    mixed = np.zeros(full, np.uint64)
    for k in range(size):
        mixed += words[k : k + full] * _STEP[k]
    mixed = mix64(mixed)
    out = []
    for i in range(n):
        m = int(per_text[i])
        if m >= size:
            out.append(np.unique(mixed[at[i] : at[i] + m - size + 1]))
        elif m:
            short = (words[at[i] : at[i + 1]] * _STEP[:m]).sum(dtype=np.uint64) + np.uint64(m)
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_of(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    raw, offsets = utf8(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        yield from shingle_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
        a = b


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, n, shingles) for classes ``wanted`` (written: node, doc_id,
    digest): their texts are read again and the digest is checked. Few
    wanted rows are broadcast, so no text is shuffled; many are joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(sets_of(batch.column("text"), size))
            ends = np.concatenate(([0], np.cumsum([len(v) for v in found]))).astype(np.int32)
            values = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(v) for v in found], pa.binary()), pa.ListArray.from_arrays(ends, values)],
                names=["digest", "shingles"],
            )

    few = F.broadcast if wanted.count() <= BROADCAST_ROWS else lambda df: df
    ids = few(wanted.select(F.col("doc_id").alias("want")).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi").select("text")
    sets = texts.mapInArrow(run, "digest binary, shingles array<long>")
    # rows that share an id may share a digest: one of them is enough
    nodes = few(wanted.select("node", "digest"))
    sets = sets.join(nodes, "digest").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return sets.select("node", F.size("shingles").cast("long").alias("n"), "shingles")
