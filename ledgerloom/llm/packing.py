"""Vector bin packing of tokenised documents.

A document's ids (with the end id) are cut into full sequences; only the
tail, shorter than a sequence, is packed. A tail is a vector of tokens,
segments (1) and loss-bearing tokens, and a sequence has a limit on each
sum. Sequences are filled one at a time: of all tails that fit, the next
one has the largest dot product of its vector with the sequence's free
share of each limit. When none fits, the largest tail is cut to fill the
gap (if the gap is worth a segment), so little padding is left.

Tails of equal (tokens, loss) form a class, so a choice looks at classes,
not at tails. A block of tails is bounded (``BLOCK_TAILS``); the rest of a
block goes on to the next one, so nothing is dropped or capped. Packing
runs within the input partitions: no shuffle, no driver work.

Null texts are empty: they consist of the end id. Every row is packed,
repeated rows and null ids too. Sequences do not depend on other
partitions; ``sequence_id`` holds the partition in its upper bits.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE_TOKENS = 2048
MAX_SEGMENTS = 64
END_ID = 1
BLOCK_TAILS = 4096
MIN_CUT = 16  # tokens: a smaller gap is padded
ENCODE_BYTES = 4 << 20
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long"
VOCABULARY = "byte_bpe_50k"


def tokenizer(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """Encoder of a public byte-level vocabulary, read from its files: the
    ids equal those of ``tokenizers`` on the vocabulary's JSON file
    without special tokens added. Added tokens of that file that stand in
    a text are matched whole, as there."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    ranks = {token: rank for token, rank in ranks.items() if rank not in added.values()}
    encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: encoding.encode(text, allowed_special="all")


class Packer:
    """Open tails by class, and the greedy dot-product choice."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.classes: dict[tuple[int, int], list[int]] = {}
        self.count = 0
        self.vectors = np.zeros((0, 3))
        self.stale = True

    def add(self, item: int, tokens: int, loss: int) -> None:
        kept = self.classes.setdefault((tokens, loss), [])
        self.stale |= not kept
        kept.append(item)
        self.count += 1

    def _take(self, key: tuple[int, int]) -> int:
        kept = self.classes[key]
        item = kept.pop()
        if not kept:
            del self.classes[key]
            self.stale = True
        self.count -= 1
        return item

    def _refresh(self) -> None:
        if self.stale:
            self.keys = sorted(self.classes)
            self.vectors = np.array([(t, 1, q) for t, q in self.keys], np.float64).reshape(-1, 3)
            self.stale = False

    def fill(self, cut: Callable[[int, int], tuple[int, int, tuple[int, int, int] | None]]) -> list[int]:
        """One sequence: the items placed, in order. ``cut(item, tokens)``
        splits an item and gives (first part, its loss, remainder)."""
        free = self.limits.copy()
        placed: list[int] = []
        while self.count:
            self._refresh()
            fits = (self.vectors <= free).all(axis=1)
            if fits.any():
                # dot product of demand and free share, both in limits
                score = (self.vectors / self.limits) @ (free / self.limits)
                key = self.keys[int(np.argmax(np.where(fits, score, -1.0)))]
                placed.append(self._take(key))
                free -= (key[0], 1, key[1])
                continue
            if free[0] < MIN_CUT or free[1] < 1 or free[2] < MIN_CUT:
                break
            key = self.keys[-1]
            room = int(min(free[0], free[2]))
            if key[0] <= room:  # held back by another limit
                break
            item = self._take(key)
            first, _, remainder = cut(item, room)
            placed.append(first)
            if remainder:
                self.add(*remainder)
            break
        return placed


def pack(
    docs: DataFrame,
    sequence_tokens: int = SEQUENCE_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    loss_from: int = 0,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text): doc_id, start, length,
    ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset,
    loss_tokens. Ids from position ``loss_from`` on of a document bear
    loss (0: all; for instruction data, the prompt's length)."""
    max_loss = sequence_tokens if max_loss is None else max_loss

    def loss_of(start: int, length: int) -> int:
        return max(0, start + length - max(start, loss_from))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        whole = min(sequence_tokens, max_loss)
        packer = Packer(sequence_tokens, max_segments, max_loss)
        items: dict[int, tuple[int | None, int, np.ndarray, int]] = {}
        next_item = 0
        out: list[tuple] = []
        held = 0

        def emit(doc_id, start, ids, total, offset):
            nonlocal held
            out.append((doc_id, start, len(ids), ids.tobytes(), total, sequence, offset, loss_of(start, len(ids))))
            held += 4 * len(ids)

        def flush():
            nonlocal held
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out.clear()
            held = 0
            return batch

        def hold(doc_id, start, ids, total):
            nonlocal next_item
            items[next_item] = (doc_id, start, ids, total)
            next_item += 1
            return next_item - 1, len(ids), loss_of(start, len(ids))

        def cut(item, tokens):
            doc_id, start, ids, total = items.pop(item)
            first, _, loss = hold(doc_id, start, ids[:tokens], total)
            return first, loss, hold(doc_id, start + tokens, ids[tokens:], total)

        def place(least: int):
            nonlocal sequence
            while packer.count > least:
                offset = 0
                for item in packer.fill(cut):
                    doc_id, start, ids, total = items.pop(item)
                    emit(doc_id, start, ids, total, offset)
                    offset += len(ids)
                sequence += 1

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array(encode(text.as_py() or "") + [end_id], np.uint32)
                full = len(ids) // whole * whole
                for start in range(0, full, whole):
                    emit(doc_id, start, ids[start : start + whole], len(ids), 0)
                    sequence += 1
                if full < len(ids):
                    packer.add(*hold(doc_id, full, ids[full:].copy(), len(ids)))
                if packer.count >= BLOCK_TAILS:
                    place(BLOCK_TAILS // 2)
                if held >= ENCODE_BYTES:
                    yield flush()
        place(0)
        if out:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """The contract's columns of the pieces."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens"
    )
