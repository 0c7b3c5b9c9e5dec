"""Suffix dedup by merging Burrows-Wheeler transforms.

Every byte covered by a ``WINDOW``-byte string that also starts in a
document with a smaller doc_id is removed. Suffixes that agree on WINDOW
bytes form the repeated intervals of a merged Burrows-Wheeler transform.

1. Each window picks its leftmost smallest ``GRAM``-byte hash as anchor.
   Equal windows pick equal anchors at equal offsets, so only documents
   with a common anchor can share a window, and all windows of an anchor
   meet in its bucket. Anchors of one block of documents only, seen in one
   of its documents, cannot repeat; the others are asked back per block.
2. The stretch of windows around a shared anchor is a segment. A bucket
   holds the distinct segments of its anchors, with the smallest doc_id of
   each; equal segments of a block are sent once.
3. In a bucket, segments are dealt into shards of bounded size. Each shard
   is sorted once (prefix doubling) and gives its transform. The shards
   are merged by interleave refinement: starting from the shards end to
   end, each round reads the merged transform in order and deals it stably
   by its characters, which orders the suffixes by one more character; no
   suffix is sorted again. Where neighbours of a round differ in the
   character or in the block of the round before, a common prefix ends; the
   blocks after WINDOW rounds are the repeated intervals.
4. A window whose interval holds a smaller doc_id is removed; runs go back
   to the documents' blocks, where texts are cut.

An anchor whose segments could fill half a block (a phrase that very many
documents share) is hot. Its windows are dealt one by one, by the hash of
all their bytes: equal windows still meet, others spread over the buckets.
A block sends each of them once, with its smallest doc_id, and is told the
smallest of all blocks; it finds the other places itself. So no bucket
holds an entry for each document of a hot window, only one for each block.

Blocks and buckets hold about ``BLOCK_BYTES`` of text each; their number
follows the input. Null texts are empty. A null doc_id is larger than any
other. Rows with the same doc_id do not remove each other's text. Empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix64, utf8, written

WINDOW = 50
GRAM = 18
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 256 << 10
STRETCH = 1 << 20
PIECE = 1 << 16  # bytes hashed at once: the arrays fit a core's cache
SHARDS = 4  # merged at once
NO_ID = np.iinfo(np.int64).max
BLOB = "target long, origin long, data binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, as far as they last."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    one = raw.astype(np.uint64)
    two = one[:-1] | one[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    return mix64(
        eight[:n] * np.uint64(0x9E3779B97F4A7C15)
        ^ mix64(eight[8 : 8 + n] + two[16 : 16 + n] * np.uint64(0xC2B2AE3D27D4EB4F))
    )


def _runs(raw: np.ndarray, at: int, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``anchor_runs`` of the windows in ``raw``, which starts at ``at``. A
    window's anchor is the leftmost of its smallest hashes, so the next
    window has another one if its smallest hash differs or the window
    itself starts with its anchor."""
    h = gram_hashes(raw)
    span = WINDOW - GRAM + 1
    least, width = h, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    n = len(least)
    low, high = np.searchsorted(offsets, [at, at + n - 1], "right") - 1
    size = np.diff(np.clip(offsets[low : high + 2], at, at + n))
    text = np.repeat(np.arange(low, high + 1), size)
    valid = np.repeat(offsets[low + 1 : high + 2] - at - WINDOW, size) >= np.arange(n)
    new = ~valid
    new[0] = True
    new[1:] |= ~valid[:-1] | (least[1:] != least[:-1]) | (h[: n - 1] == least[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], n) - 1
    begin, last = begin[valid[begin]], last[valid[begin]]
    return least[begin], at + begin, at + last, text[begin]


def anchor_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, last window, text) of every run of
    windows that share an anchor, worked off in pieces of bounded size
    (a run cut in two is two runs of one anchor)."""
    found = [_runs(raw[a : a + PIECE + WINDOW - 1], a, offsets) for a in range(0, len(raw) - WINDOW + 1, PIECE)]
    if not found:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    return tuple(np.concatenate(part) for part in zip(*found))


def _blob(target: list[int], origin: list[int], data: list[bytes]) -> pa.Table:
    return pa.table(
        {"target": pa.array(target, pa.int64()), "origin": pa.array(origin, pa.int64()), "data": pa.array(data, pa.binary())}
    )


def _by(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices) for the buckets of hashes ``keys``."""
    bucket = (keys >> np.uint64(11)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=np.uint64(buckets)))
    begin = 0
    for end in ends + 1 if len(order) else []:
        yield int(bucket[order[begin]]), order[begin:end]
        begin = end


def _sorted_block(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A block's rows in the order of (doc_id, text hash), and the ids."""
    table = table.combine_chunks()
    table = table.take(pa.compute.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("mark", "ascending")]))
    return table, table.column("doc_id").fill_null(NO_ID).to_numpy()


# docs: the documents of the block with the anchor, as a power of two
_ASKED = np.dtype([("anchor", "<u8"), ("block", "<u4"), ("docs", "u1")])
PLAIN, HOT = 0, 1  # origin of what a block is told


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors, those in two documents, sent to the blocks
    that have them, hot ones apart."""
    asked = np.concatenate([np.frombuffer(d.as_buffer(), _ASKED) for d in table.column("data")])
    hashes, origin = asked["anchor"], asked["block"].astype(np.int64)
    _, where = np.unique(hashes, return_inverse=True)
    docs = np.bincount(where, np.exp2(asked["docs"]))[where]
    hot = docs * (2 * WINDOW - GRAM) >= BLOCK_BYTES / 2
    targets, kinds, data = [], [], []
    for kind, chosen in ((PLAIN, (docs > 1) & ~hot), (HOT, hot & (docs > 1))):
        own, of = hashes[chosen], origin[chosen]
        order = np.argsort(of, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            if len(part):
                targets.append(int(of[part[0]]))
                kinds.append(kind)
                data.append(own[part].tobytes())
    return _blob(targets, kinds, data)


# A hot window as a block sends it (its smallest id, one of its places),
# and as the block is told about it.
_HOT = np.dtype([("key", "<u8"), ("id", "<i8"), ("text", "<u4"), ("at", "<u4"), ("body", f"V{WINDOW}")])
_TOLD = np.dtype([("text", "<u4"), ("at", "<u4"), ("id", "<i8")])


def window_keys(raw: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes from each position, as far as they last."""
    h, n = gram_hashes(raw), len(raw) - WINDOW + 1
    key, step = h[: max(0, n)], GRAM
    while step < WINDOW:
        at = min(step, WINDOW - GRAM)  # the last gram ends with the window
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) ^ h[at : at + len(key)])
        step += GRAM
    return key


def bodies(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The WINDOW bytes from each of ``starts``, as rows."""
    return np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[starts] if len(starts) else np.zeros((0, WINDOW), np.uint8)


def same_bodies(raw: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the windows from ``left`` and ``right`` are equal, in parts
    of bounded size."""
    step = STRETCH // 16
    parts = [(bodies(raw, left[a : a + step]) == bodies(raw, right[a : a + step])).all(1) for a in range(0, len(left), step)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def hot_windows(raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray, first: np.ndarray, last: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The distinct windows of a block's runs, each with its smallest id (a
    window whose hash another one shares may come more than once)."""
    run = np.repeat(np.arange(len(first)), last - first + 1)
    starts = _ranges(first, last + 1)
    key, of = window_keys(raw)[starts], text[run]
    order = np.lexsort((ids[of], key))
    key, starts, of = key[order], starts[order], of[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    lead = starts[new][np.cumsum(new) - 1]
    chosen = np.flatnonzero(new | ~same_bodies(raw, starts, lead))
    out = np.zeros(len(chosen), _HOT)
    out["key"], out["id"], out["text"] = key[chosen], ids[of[chosen]], of[chosen]
    out["at"] = starts[chosen] - offsets[of[chosen]]
    out["body"] = bodies(raw, starts[chosen]).view(f"V{WINDOW}").reshape(-1)
    return out


def hot_places(raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Positions of the block's windows that equal a told one and lie in a
    document with a larger id."""
    keys = window_keys(raw)
    lead = offsets[told["text"]] + told["at"]
    order = np.argsort(keys[lead], kind="stable")
    lead, low, known = lead[order], told["id"][order], keys[lead[order]]
    spot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    starts = np.flatnonzero(known[spot] == keys)
    spot = spot[starts]
    same = same_bodies(raw, starts, lead[spot])
    least = low[spot]
    if len(np.unique(known)) < len(known) or not same.all():  # shared hashes: by their bytes
        by_body: dict[bytes, int] = {}
        for body, i in zip(bodies(raw, lead), low.tolist()):
            by_body[body.tobytes()] = min(i, by_body.get(body.tobytes(), NO_ID))
        least = np.array([by_body.get(raw[a : a + WINDOW].tobytes(), NO_ID) for a in starts.tolist()], np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    return starts[(starts + WINDOW <= offsets[text + 1]) & (least < ids[text])]


# A segment's record: anchor, segment index in its block's list, document,
# window position; the list: smallest id, length, then the bytes.
_SEEN = np.dtype([("segment", "<u4"), ("text", "<u4"), ("at", "<u4"), ("id", "<i8")])
_SEGMENT = np.dtype([("anchor", "<u8"), ("size", "<u2"), ("id", "<i8")])


def _pack(seen: np.ndarray, segments: np.ndarray, raw: bytes) -> bytes:
    head = np.array([len(seen), len(segments)], np.int64).tobytes()
    return head + seen.tobytes() + segments.tobytes() + raw


def _unpack(data: memoryview) -> tuple[np.ndarray, np.ndarray, memoryview]:
    n, m = np.frombuffer(data, np.int64, 2)
    a = 16 + int(n) * _SEEN.itemsize
    b = a + int(m) * _SEGMENT.itemsize
    return np.frombuffer(data[16:a], _SEEN), np.frombuffer(data[a:b], _SEGMENT), data[b:]


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a shard by at least their first WINDOW
    characters, by prefix doubling. Ties stay in any order: the merge
    looks at WINDOW characters, so ties share a block of every round."""
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(7, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    width = 7
    while True:
        order = np.argsort(key)
        if width >= WINDOW:
            return order
        dealt = key[order]
        rank = np.zeros(n, np.int64)
        rank[order[1:]] = np.cumsum(dealt[1:] != dealt[:-1])
        if n and rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + after
        width *= 2


def runs_before(codes: list[np.ndarray], orders: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Per shard the transform of ``length`` characters: along its suffix
    order, the rank of the characters that precede each suffix."""
    base = 1 + max(int(c.max(initial=0)) for c in codes)
    whole = []
    for code, order in zip(codes, orders):
        key = np.zeros(len(order), np.int64)
        for k in range(length, 0, -1):
            key = key * base + code[order - k]  # a segment's first follows an end
        whole.append(key)
    ranks = np.unique(np.concatenate(whole))
    return [np.searchsorted(ranks, key) for key in whole] if length == 1 or len(ranks) <= 1 << 16 else []


def merge_transforms(codes: list[np.ndarray], orders: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, block) along the merged order after interleave refinement to
    ``depth`` characters: the i-th entry of a shard is its i-th suffix, and
    a block holds the suffixes that agree on ``depth`` characters. A round
    refines by as many characters as have ranks of 16 bits, which sort in
    linear time; the last rounds by fewer."""
    size = [len(o) for o in orders]
    shard = np.repeat(np.arange(len(orders), dtype=np.uint8), size)
    block = np.zeros(len(shard), np.int32)
    char = np.empty(len(shard), np.uint16)
    step, left = min(4, depth), depth
    while not (transforms := runs_before(codes, orders, step)):
        step -= 1
    while left:
        if left < step:
            step, transforms = left, runs_before(codes, orders, left)
        for k, t in enumerate(transforms):
            char[shard == k] = t
        order = np.argsort(char, kind="stable")
        dealt, before = char[order], block[order]
        shard = shard[order]
        starts = np.zeros(len(order), bool)
        starts[1:] = (dealt[1:] != dealt[:-1]) | (before[1:] != before[:-1])
        block = np.cumsum(starts, dtype=np.int32)
        left -= step
    return shard, block


def smallest_ids(segments: list[bytes], ids: np.ndarray) -> np.ndarray:
    """For each window of each segment, one after the other, the smallest
    id of a segment that has the same window."""
    codes, orders, owners, inside = [], [], [], []
    per_shard = max(1, -(-len(segments) // SHARDS))
    for a in range(0, len(segments), per_shard):
        part = segments[a : a + per_shard]
        size = np.array([len(s) for s in part], np.int64)
        ends = np.cumsum(size + 1)
        code = np.zeros(int(ends[-1]), np.int64)  # 0 ends a segment
        body = np.ones(len(code), bool)
        body[ends - 1] = False
        code[body] = np.frombuffer(b"".join(part), np.uint8).astype(np.int64) + 1
        order = suffix_order(code)
        orders.append(order)
        owners.append(a + np.repeat(np.arange(len(part)), size + 1))
        inside.append(np.arange(len(code)) - np.repeat(ends - size - 1, size + 1))
        codes.append(code)
    used = np.unique(np.concatenate([np.unique(c) for c in codes]))
    codes = [np.searchsorted(used, c) for c in codes]
    shard, block = merge_transforms(codes, orders, WINDOW)
    low = np.full(int(block[-1]) + 1, NO_ID)
    spots, lengths = [], np.array([len(s) for s in segments], np.int64)
    for k, order in enumerate(orders):
        of = np.empty(len(order), np.int64)
        of[order] = block[shard == k]
        window = inside[k] + WINDOW <= lengths[owners[k]]
        np.minimum.at(low, of[window], ids[owners[k][window]])
        spots.append(of[window])
    return low[np.concatenate(spots)]


def _ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each of ``begins`` up to its end, one after the other."""
    size = ends - begins
    return np.repeat(begins - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _judge(table: pa.Table) -> pa.Table:
    """A bucket: merges its segments and tells each block what to remove."""
    requests = []
    where: dict[tuple[int, bytes], int] = {}
    segments: list[bytes] = []
    anchors: list[int] = []
    ids: list[int] = []
    for origin, data in zip(table.column("origin").to_pylist(), table.column("data")):
        if origin < 0:  # hot windows, see hot_windows
            seen = np.frombuffer(data.as_buffer(), _HOT)
            listed = np.zeros(len(seen), _SEGMENT)
            listed["anchor"], listed["size"], listed["id"] = seen["key"], WINDOW, seen["id"]
            raw = np.ascontiguousarray(seen["body"]).tobytes()
        else:
            seen, listed, raw = _unpack(memoryview(data.as_buffer()))
        own = np.zeros(len(listed), np.int64)
        at = 0
        for k, (anchor, size, low) in enumerate(listed.tolist()):
            body = bytes(raw[at : at + size])
            at += size
            index = where.setdefault((anchor, body), len(segments))
            if index == len(segments):
                segments.append(body)
                anchors.append(anchor)
                ids.append(low)
            elif low < ids[index]:
                ids[index] = low
            own[k] = index
        requests.append((origin, seen, own))
    where.clear()
    size = np.array([len(s) for s in segments], np.int64)
    low_ids, of = np.array(ids, np.int64), np.array(anchors, np.uint64)
    # each segment's windows in one array: the smallest id of each
    ends = np.cumsum(size - WINDOW + 1)
    begins = ends - (size - WINDOW + 1)
    # the only segment of its anchor holds the smallest ids of its windows
    found = np.repeat(low_ids, ends - begins)
    order = np.argsort(of, kind="stable")
    twin = of[order][1:] == of[order][:-1]
    meets = np.append(twin, False)
    meets[1:] |= twin
    order = order[meets]
    first = np.flatnonzero(np.append(True, np.diff(of[order]) != 0)) if len(order) else order
    filled = np.cumsum(size[order] + 1)
    a = 0
    while a < len(order):  # runs of whole anchors, of about SHARDS shards
        full = np.searchsorted(filled, (filled[a - 1] if a else 0) + SHARDS * SHARD_BYTES) + 1
        later = np.searchsorted(first, full)
        b = int(first[later]) if later < len(first) else len(order)
        some = order[a:b]
        windows = smallest_ids([segments[i] for i in some.tolist()], low_ids[some])
        found[_ranges(begins[some], ends[some])] = windows
        a = b
    least = np.minimum.reduceat(found, begins) if len(found) else found
    most = np.maximum.reduceat(found, begins) if len(found) else found
    targets, kinds, data = [], [], []
    for origin, seen, own in requests:
        if origin < 0:
            told = np.zeros(len(seen), _TOLD)
            told["text"], told["at"], told["id"] = seen["text"], seen["at"], least[own]
            targets.append(-1 - origin)
            kinds.append(HOT)
            data.append(told.tobytes())
            continue
        index = own[seen["segment"]]
        whole = most[index] < seen["id"]
        out = [np.stack([seen["text"][whole], seen["at"][whole], seen["at"][whole] + size[index[whole]]], 1)]
        partly = np.flatnonzero(~whole & (least[index] < seen["id"]))
        begin, end = begins[index[partly]], ends[index[partly]]
        place = _ranges(begin, end)
        part = np.repeat(np.arange(len(partly)), end - begin)
        hit = np.flatnonzero(found[place] < seen["id"][partly][part])
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (np.diff(part[hit]) != 0)
        head = hit[new]
        tail = hit[np.append(new[1:], True)] if len(hit) else hit
        at = seen["at"][partly][part[head]].astype(np.int64)
        base = begin[part[head]]
        out.append(np.stack([seen["text"][partly][part[head]], at + place[head] - base, at + place[tail] - base + WINDOW], 1))
        spans = np.concatenate(out).astype(np.uint32)
        if len(spans):
            targets.append(origin)
            kinds.append(PLAIN)
            data.append(spans.tobytes())
    return _blob(targets, kinds, data)


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every
    row; ``kept`` holds the remaining bytes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = rows.withColumn("mark", F.xxhash64("text")).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(blocks))
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column("text"))
            hashes, _, _, text = anchor_runs(raw, offsets)
            # once per document, then once per block, with its documents
            order = np.lexsort((text, hashes))
            own, at = hashes[order], text[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1])
            own, of = own[new], batch.column("block").to_numpy()[at[new]]
            order = np.lexsort((of, own))
            own, of = own[order], of[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (of[1:] != of[:-1])
            first = np.flatnonzero(new)
            asked = np.zeros(len(first), _ASKED)
            asked["anchor"], asked["block"] = own[first], of[first]
            asked["docs"] = np.log2(np.diff(first, append=len(own)))
            out = [(k, asked[i].tobytes()) for k, i in _by(asked["anchor"], blocks)]
            yield from _blob([k for k, _ in out], [0] * len(out), [d for _, d in out]).to_batches()

    def send(texts: pa.Table, shared: pa.Table) -> pa.Table:
        if not texts.num_rows or not shared.num_rows:
            return _blob([], [], [])
        block = texts.column("block")[0].as_py()
        texts, ids = _sorted_block(texts)
        raw, offsets = utf8(texts.column("text"))
        hashes, first, last, text = anchor_runs(raw, offsets)

        def of_kind(kind: int) -> np.ndarray:
            lists = shared.filter(pa.compute.equal(shared.column("origin"), kind)).column("data")
            return np.flatnonzero(np.isin(hashes, np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(d.as_buffer(), np.uint64) for d in lists)])))

        hit, hot = of_kind(PLAIN), of_kind(HOT)
        body = raw.tobytes()
        targets, origins, data = [], [], []
        if len(hot):
            windows = hot_windows(raw, offsets, ids, first[hot], last[hot], text[hot])
            for bucket, at in _by(windows["key"], blocks):
                targets.append(bucket)
                origins.append(-1 - block)
                data.append(windows[at].tobytes())
        for bucket, at in _by(hashes[hit], blocks):
            listed: dict[tuple[int, bytes], int] = {}
            low: list[int] = []
            own = hit[at]
            seen = np.zeros(len(at), _SEEN)
            seen["text"], seen["at"], seen["id"] = text[own], first[own] - offsets[text[own]], ids[text[own]]
            index_of = []
            for h, a, z, i in zip(hashes[own].tolist(), first[own].tolist(), last[own].tolist(), seen["id"].tolist()):
                index = listed.setdefault((h, body[a : z + WINDOW]), len(low))
                if index == len(low):
                    low.append(i)
                elif i < low[index]:
                    low[index] = i
                index_of.append(index)
            seen["segment"] = index_of
            segments = np.array([(h, len(s), i) for (h, s), i in zip(listed, low)], _SEGMENT)
            targets.append(bucket)
            origins.append(block)
            data.append(_pack(seen, segments, b"".join(s for _, s in listed)))
        return _blob(targets, origins, data)

    def cut(texts: pa.Table, removed: pa.Table) -> pa.Table:
        texts, ids = _sorted_block(texts)
        raw, offsets = utf8(texts.column("text"))
        edge = np.zeros(len(raw) + 1, np.int32)
        kinds = removed.column("origin").to_pylist()
        told = [d.as_buffer() for d, kind in zip(removed.column("data"), kinds) if kind == PLAIN]
        if told:
            spans = np.concatenate([np.frombuffer(d, np.uint32) for d in told]).reshape(-1, 3).astype(np.int64)
            np.add.at(edge, offsets[spans[:, 0]] + spans[:, 1], 1)
            np.add.at(edge, offsets[spans[:, 0]] + spans[:, 2], -1)
        told = [d.as_buffer() for d, kind in zip(removed.column("data"), kinds) if kind == HOT]
        if told:
            starts = hot_places(raw, offsets, ids, np.concatenate([np.frombuffer(d, _TOLD) for d in told]))
            edge[starts] += 1
            edge[starts + WINDOW] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        out: list[tuple] = []
        for k in range(len(ids)):
            mask = gone[offsets[k] : offsets[k + 1]]
            kept = raw[offsets[k] : offsets[k + 1]][~mask].tobytes()
            runs = int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum())
            out.append((len(mask), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table({"doc_id": texts.column("doc_id")} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    asked = rows.select("text", "block").mapInArrow(ask, BLOB)
    shared = written(asked.groupBy("target").applyInArrow(_shared, BLOB), "anchors")
    texts = rows.groupBy("block")
    segments = texts.cogroup(shared.groupBy(F.col("target"))).applyInArrow(send, BLOB)
    removed = written(segments.groupBy("target").applyInArrow(_judge, BLOB), "removed")
    return texts.cogroup(removed.groupBy("target")).applyInArrow(cut, RESULT)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
