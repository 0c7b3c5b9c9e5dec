"""N-gram Jaccard join with set-relation skipping: components of all links.

A document's set holds its distinct word shingles (A-Z lower-cased) as
64-bit hashes. Documents with equal sets form a class, and one per class
goes on. Two passes find every link:

1. Narrowing, exact. In the order of the hashes, a set's prefix is long
   enough to hold at least ``l`` shingles in common with any set it can
   link with (a tenth of the smallest such set). Tasks send their distinct
   prefix shingles, packed, to blocks by hash; a shingle that two classes
   hold is answered to those that asked. A set with fewer than ``l``
   shared prefix shingles has no link. A task answers itself what several
   of its own classes hold, and sends one entry per shingle, so a common
   passage adds one entry per task. Answers travel packed as well, and are
   added up per class.
2. Joining, by ``set_links``: lists of the remaining sets' prefixes by
   rarity, with blocks by position that are skipped whole, and answers
   derived from those of a highly similar set.

Components follow from the links; links within a component that is known
are not formed, all others are.

Null and blank texts have an empty set and are linked with nothing. A
text with fewer words than a shingle has its whole sequence as one. A null
doc_id loses against any other. Repeated rows are one class. Empty tables
give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix64, spread, written
from ledgerloom.llm.set_links import labelled, link
from ledgerloom.llm.shingles import digest, full_sets, sets_of

BLOCK_SHINGLES = 4_000_000  # shingles of all documents per block of the narrowing
SHARE = 10  # a prefix holds a tenth of the partner's size in common

_PACKED = "target long, kind int, data binary"


def classes_of(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, digest, mark) of every row; ``mark`` is the head of the
    digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, marks = [], [], []
            for values in sets_of(batch.column("text"), size):
                own = digest(values) if len(values) else None
                n.append(len(values))
                digests.append(own)
                marks.append(own and int.from_bytes(own[:8], "little", signed=True))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(marks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "digest", "mark"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, digest binary, mark long")


def _dealt(kind: int, target: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(target, kind, its rows of ``data`` as bytes), one per target."""
    order = np.argsort(target, kind="stable")
    target, data = target[order], data[order]
    starts = np.flatnonzero(np.diff(target, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(target)]):
        yield int(target[a]), kind, data[a:b].tobytes()


def _table(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [(), (), ()]
    types = (pa.int64(), pa.int32(), pa.binary())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("target", "kind", "data"), columns, types)})


def _of(mark: np.ndarray, blocks: int) -> np.ndarray:
    return (mix64(mark.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def shared_counts(docs: DataFrame, size: int, percent: int, blocks: int) -> DataFrame:
    """(mark, shared): per class, the shingles of its prefix by hash that
    another class's prefix holds; at least as many, never fewer."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, marks, known = [np.zeros(0, np.uint64)], [], set()
            for values in sets_of(batch.column("text"), size):
                n = len(values)
                mark = int.from_bytes(digest(values)[:8], "little", signed=True) if n else None
                if n and mark not in known:
                    known.add(mark)
                    marks.append(mark)
                    heads.append(values[: n - (percent * n + 99) // 100 + max(1, n // SHARE)])
            owner = np.repeat(np.array(marks, np.int64), [len(h) for h in heads[1:]])
            shingle = np.concatenate(heads)
            order = np.argsort(shingle, kind="stable")
            shingle, owner = shingle[order], owner[order]
            first = np.flatnonzero(np.diff(shingle, prepend=~shingle[:1]))
            many = np.diff(first, append=len(shingle))
            here, times = np.unique(owner[np.repeat(many > 1, many)], return_counts=True)
            # the lowest bit asks for an answer
            entry = np.stack([(shingle[first] & ~np.uint64(1)) | (many == 1), owner[first].view(np.uint64)], 1)
            out = [*_dealt(0, _of(shingle[first] >> np.uint64(1), blocks), entry)]
            out += _dealt(1, _of(here, blocks), np.stack([here, times], 1))
            yield from _table(out).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        data = [np.frombuffer(d.as_buffer(), np.uint64).reshape(-1, 2) for d in table.column("data")]
        entries = np.concatenate([np.zeros((0, 2), np.uint64), *[d for d, k in zip(data, kinds) if k == 0]])
        local = np.concatenate([np.zeros((0, 2), np.uint64), *[d for d, k in zip(data, kinds) if k == 1]]).view(np.int64)
        del data
        asks = entries[:, 0] & np.uint64(1) == 1
        # a hash of one bit less: rare false answers only keep a set
        order = np.lexsort((entries[:, 1], entries[:, 0] >> np.uint64(1)))
        shingle, owner, asks = entries[order, 0] >> np.uint64(1), entries[order, 1], asks[order]
        fresh = np.ones(len(shingle), bool)
        fresh[1:] = shingle[1:] != shingle[:-1]
        other = fresh.copy()
        other[1:] |= owner[1:] != owner[:-1]
        run = np.cumsum(fresh) - 1
        # a shingle that only one task's several classes hold needs no answer
        shared = np.bincount(run[other]) > 1 if len(run) else np.zeros(0, bool)
        told = np.flatnonzero(asks & shared[run]) if len(run) else np.zeros(0, np.int64)
        once = np.ones(len(told), bool)
        once[1:] = (run[told[1:]] != run[told[:-1]]) | (owner[told[1:]] != owner[told[:-1]])
        mark, times = np.unique(owner[told[once]].view(np.int64), return_counts=True)
        told = np.concatenate([np.stack([mark, times], 1), local])
        return _table(_dealt(1, _of(told[:, 0], blocks), told))

    def add(table: pa.Table) -> pa.Table:
        told = np.concatenate([np.frombuffer(d.as_buffer(), np.int64).reshape(-1, 2) for d in table.column("data")])
        mark, of = np.unique(told[:, 0], return_inverse=True)
        total = np.zeros(len(mark), np.int64)
        np.add.at(total, of, told[:, 1])
        return pa.table({"mark": mark, "shared": total})

    packed = docs.select("text").mapInArrow(ask, _PACKED)
    answers = packed.groupBy("target").applyInArrow(answer, _PACKED)
    return answers.groupBy("target").applyInArrow(add, "mark long, shared long")


def group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component's id
    is the smallest doc_id reachable."""
    rows = written(classes_of(docs, size), "sets")
    total = rows.agg(F.sum("n")).first()[0] or 0
    of_class = rows.where("n > 0").groupBy("digest", "mark", "n").agg(F.min("doc_id").alias("doc_id"))
    classes = written(of_class.withColumn("node", F.monotonically_increasing_id()), "classes")
    counts = shared_counts(docs, size, percent, max(1, -(-total // BLOCK_SHINGLES)))
    partner = F.expr(f"({percent} * n + 99) div 100")  # the smallest set to link with
    least = F.greatest(F.lit(1), F.floor(partner / SHARE))
    wanted = classes.join(counts, "mark").where(F.col("shared") >= least).select("node", "doc_id", "digest")
    wanted = written(wanted, "wanted")
    sets = written(full_sets(docs, wanted, size), "full")
    labels = link(sets, percent)
    placed = labelled(classes.select("node", "digest", "doc_id"), labels)
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("many"))
    facts, dim = spread(placed, smallest, "label", ["node"], smallest.select("label", "many"), classes.count())
    of = written(facts.join(dim, ["label", "salt"]).select("digest", "component_id"), "components")
    sized = rows.where("n > 0")
    copies = sized.groupBy("digest").agg(F.count(F.lit(1)).alias("many"))
    facts, dim = spread(sized.select("doc_id", "n", "digest"), of, "digest", ["doc_id"], copies, rows.count())
    linked = facts.join(dim, ["digest", "salt"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
