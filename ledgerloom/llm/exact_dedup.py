"""Exact dedup by a minimal perfect hash over historical digests.

The distinct digests of the history are dealt into shards. Each shard
gets a minimal perfect hash function: at every level a key hashes into a
bit table of twice the keys left; keys alone in their cell are placed
there, the others go on to the next level; the rank of a key's bit over
all levels is its slot. The slot holds the full 32-byte digest and the
locator (doc_id) of the winner. A lookup compares all digest bytes, so a
digest outside the history is never taken for a member; such digests are
grouped separately.

A table without a given history is its own: the rows of one half of the
ids (``historical``, a hash of doc_id) are the history, the other rows are
looked up in its index. A row whose digest is a member joins the winner
its slot names; the nonmembers are grouped among themselves.

Null texts count as empty. Rows with a null doc_id lose against any id.
Repeated rows (same id, same text) keep one row. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read by the decision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, mix64, pick_rows, written

SHARD_DIGESTS = 50_000  # digests of a shard on average: about 3 MB of slots
INDEX_SCHEMA = "shard long, levels binary, bits binary, digests binary, winners binary, no_id binary"
FOUND_SCHEMA = "digest binary, winner long, member boolean"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _cell(words: np.ndarray, level: int, cells: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(words[:, 0] ^ salt) ^ mix64(words[:, 1] + salt)) % np.uint64(cells)


def build_mphf(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells per level, all bit tables end to end, slot of each digest)
    for distinct digests given as an (n, 32) byte array."""
    words = np.ascontiguousarray(digests).view(np.uint64).reshape(len(digests), 4)
    left = np.arange(len(digests))
    sizes: list[int] = []
    tables: list[np.ndarray] = []
    at = np.zeros(len(digests), np.int64)
    base = 0
    while len(left):
        cells = max(64, 2 * len(left))
        cell = _cell(words[left], len(sizes), cells).astype(np.int64)
        alone = np.bincount(cell, minlength=cells) == 1
        placed = alone[cell]
        at[left[placed]] = base + cell[placed]
        sizes.append(cells)
        tables.append(alone)
        base += cells
        left = left[~placed]
    bits = np.concatenate(tables) if tables else np.zeros(0, bool)
    rank = np.cumsum(bits) - 1
    return np.array(sizes, np.int64), bits, rank[at] if len(at) else at


def lookup_mphf(sizes: np.ndarray, bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level has its bit set. A slot is
    only a claim: the caller compares the digest bytes."""
    words = np.ascontiguousarray(digests).view(np.uint64).reshape(len(digests), 4)
    rank = np.cumsum(bits) - 1
    slot = np.full(len(digests), -1, np.int64)
    left, base = np.arange(len(digests)), 0
    for level, cells in enumerate(sizes):
        if not len(left):
            break
        cell = base + _cell(words[left], level, int(cells)).astype(np.int64)
        hit = bits[cell]
        slot[left[hit]] = rank[cell[hit]]
        left = left[~hit]
        base += int(cells)
    return slot


def _matrix(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(len(digests), 32)


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(pdf["digest"])
    sizes, bits, slot = build_mphf(digests)
    order = np.argsort(slot)
    winner = pdf["winner"].to_numpy(dtype="float64", na_value=np.nan)
    ids = pdf["winner"].fillna(0).to_numpy(dtype=np.int64)
    return pd.DataFrame(
        {
            "shard": [int(pdf["shard"].iloc[0])],
            "levels": [sizes.tobytes()],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [digests[order].tobytes()],
            "winners": [ids[order].tobytes()],
            "no_id": [np.isnan(winner)[order].tobytes()],
        }
    )


def _lookup_shard(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(asked["digest"]) if len(asked) else np.zeros((0, 32), np.uint8)
    winner = np.zeros(len(asked), np.int64)
    none = np.ones(len(asked), bool)
    member = np.zeros(len(asked), bool)
    if len(index) and len(asked):
        row = index.iloc[0]
        sizes = np.frombuffer(row["levels"], np.int64)
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)[: int(sizes.sum())]
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        slot = lookup_mphf(sizes, bits, digests)
        safe = np.maximum(slot, 0)
        member = (slot >= 0) & (held[safe] == digests).all(axis=1)
        winner = np.frombuffer(row["winners"], np.int64)[safe]
        none = np.frombuffer(row["no_id"], bool)[safe] | ~member
    out = pd.DataFrame({"digest": asked["digest"], "winner": pd.array(winner, dtype="Int64"), "member": member})
    out.loc[none, "winner"] = pd.NA
    return out


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("long")


def build_index(history: DataFrame, asked: int = 0) -> tuple[DataFrame, int]:
    """Index table (one row per shard, written to the shared folder) over
    ``history`` (digest, winner), whose digests are distinct. The number
    of shards follows the exact number of digests, of the history or
    ``asked`` if those are more, so a shard's memory does not grow with
    the input."""
    shards = max(1, -(-max(history.count(), asked) // SHARD_DIGESTS))
    dealt = history.select(_shard(shards).alias("shard"), "digest", F.col("winner").cast("long").alias("winner"))
    return written(dealt.groupBy("shard").applyInPandas(_build_shard, INDEX_SCHEMA), "mphf"), shards


def lookup(asked: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(digest, winner, member) for distinct digests ``asked``."""
    dealt = asked.select(_shard(shards).alias("shard"), "digest")
    return dealt.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_lookup_shard, FOUND_SCHEMA)


def historical(doc_id: Column) -> Column:
    """Whether a row belongs to the half of a table that is its history."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("group_size"))


def decide(rows: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One verdict per distinct digest of ``rows`` (doc_id, digest):
    (digest, keep_id, group_size, member). ``history`` (digest, winner)
    holds earlier winners (of a repeated digest the smallest); members
    keep the historical winner, nonmembers are grouped separately and keep
    their smallest doc_id. Without ``history`` the ``historical`` rows are
    it; the smaller id of the winner and the members then stays."""
    old = historical(F.col("doc_id"))
    new = written(_sizes(rows if history is not None else rows.where(~old)), "digests")
    if history is None:
        past = written(_sizes(rows.where(old)), "history").withColumnRenamed("first_id", "winner")
    else:  # an index needs distinct digests
        past = history.where("digest is not null").groupBy("digest").agg(F.min("winner").alias("winner"))
    index, shards = build_index(past.select("digest", "winner"), new.count())
    found = written(lookup(new, index, shards), "lookups")
    members = new.join(found.where("member").select("digest", "winner"), "digest")
    others = new.join(found.where("not member").select("digest"), "digest").select(
        "digest", F.col("first_id").alias("keep_id"), "group_size", F.lit(False).alias("member")
    )
    if history is None:
        joining = members.select("digest", "first_id", F.col("group_size").alias("more"))
        known = past.join(joining, "digest", "left").select(
            "digest",
            F.least("winner", "first_id").alias("keep_id"),  # a null loses
            (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size"),
            F.lit(True).alias("member"),
        )
    else:
        known = members.select("digest", F.col("winner").alias("keep_id"), "group_size", F.lit(True).alias("member"))
    return known.unionByName(others)


def group_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.
    Row positions are written once, so that of repeated rows exactly one
    is kept."""
    rows = written(
        docs.select("doc_id", digest_of(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")),
        "rows",
    )
    firsts = rows.groupBy("digest", "doc_id").agg(F.min("row").alias("first_row"))
    verdicts = decide(rows)
    stays = (
        verdicts.alias("v")
        .join(firsts.alias("f"), F.expr("v.digest = f.digest and v.keep_id <=> f.doc_id"))
        .select("v.digest", "v.keep_id", "v.group_size", "f.first_row")
    )
    return rows.join(stays, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("first_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the first
    row of each group of equal texts, and none whose digest is in
    ``history`` (digest, winner; distinct digests)."""
    digest = digest_of(F.col("text"))
    verdicts = decide(docs.select("doc_id", digest.alias("digest")), history)
    if history is not None:
        verdicts = verdicts.where("not member")
    # the key holds digest and id, so a hot digest is dealt by its ids
    stays = verdicts.select(F.struct("digest", F.col("keep_id").alias("doc_id")).alias("key"))
    return pick_rows(docs, F.struct(digest.alias("digest"), F.col("doc_id").alias("doc_id")), stays)
