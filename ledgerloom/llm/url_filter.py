"""URL filters by a bit-parallel wildcard automaton.

Glob rules (``*`` any run, ``?`` any one byte) are packed into multiword
Shift-And masks: every rule owns one start bit and one bit per literal.
One step per byte moves all rules of all URLs of a batch at once:

    state' = ((state << 1) & mask[byte]) | (state & loop)

where ``loop`` keeps the bits that a ``*`` follows. Bits are carried from
word to word, so any number of rules is simulated together. A rule fits
if its last bit is set at the end of the URL.

The canonical URL is ``.host``, a blank, the path, and the query after a
``?``. A host rule (host, path) is the glob ``*.host path*``: it fits the
host and its subdomains if the path starts with the rule's. The longest
fitting host rule decides; a URL without one is judged by the general
globs (any fitting block glob blocks), else allowed.

A null URL, or one without ``://``, has an empty host and path, fits no
rule and is allowed. Bytes are those of the UTF-8 text; A-Z of the host
are lower-cased, nothing else is changed. Empty tables give empty results;
repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import utf8

# The contract's host rules: (verdict, host, path).
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# General block globs over ".host path?query", for URLs without a host rule.
BLOCK_GLOBS = (
    "*.ads.*",
    "*/login*",
    "*/cart/*",
    "*/download/*.exe",
    "*\\?*sessionid=*",
)
URL_BATCH = 2048  # URLs simulated together, sorted by length


class GlobSet:
    """Rules packed into (words) uint64 masks."""

    def __init__(self, globs: Sequence[str]):
        literals: list[list[tuple[int | None, bool]]] = []
        for glob in globs:
            states: list[list] = [[None, False]]
            raw = glob.encode()
            i = 0
            while i < len(raw):
                if raw[i] == ord("*"):
                    states[-1][1] = True
                elif raw[i] == ord("\\") and i + 1 < len(raw):
                    i += 1
                    states.append([raw[i], False])
                else:
                    states.append([-1 if raw[i] == ord("?") else raw[i], False])
                i += 1
            literals.append([tuple(s) for s in states])
        bits = sum(map(len, literals))
        self.words = max(1, -(-bits // 64))
        self.mask = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros(self.words, np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.last: list[tuple[int, np.uint64]] = []
        at = 0
        for states in literals:
            for k, (byte, star) in enumerate(states):
                word, bit = divmod(at, 64)
                one = np.uint64(1 << bit)
                if k == 0:
                    self.start[word] |= one
                elif byte == -1:
                    self.mask[:, word] |= one
                else:
                    self.mask[byte, word] |= one
                if star:
                    self.loop[word] |= one
                at += 1
            self.last.append((word, one))

    def match(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(urls, rules) booleans: which rule fits which whole URL."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.last)), bool)
        lengths = np.diff(offsets)
        longest_first = np.argsort(-lengths, kind="stable")
        for a in range(0, n, URL_BATCH):
            rows = longest_first[a : a + URL_BATCH]
            size, begin = lengths[rows], offsets[rows]
            state = np.tile(self.start, (len(rows), 1))
            active = len(rows)
            for j in range(int(size[0]) if len(rows) else 0):
                while active and size[active - 1] <= j:
                    active -= 1  # sorted: URLs that ended keep their state
                s = state[:active]
                moved = s << np.uint64(1)
                if self.words > 1:
                    moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
                state[:active] = (moved & self.mask[raw[begin[:active] + j]]) | (s & self.loop)
            for k, (word, one) in enumerate(self.last):
                out[rows, k] = (state[:, word] & one) != 0
        return out


def escape(literal: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in literal)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge(
    pages: DataFrame,
    host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``;
    only ``page_id`` and ``url`` are read."""
    globs = [f"*.{escape(h)} {escape(p)}*" for _, h, p in host_rules] + list(block_globs)
    names = [h + p for _, h, p in host_rules]
    verdicts = [v for v, _, _ in host_rules]
    rank = sorted(range(len(names)), key=lambda k: (len(names[k]), names[k]))
    host, path = host_and_path(F.col("url"))
    query = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?s)^[^?#]*(\?[^#]*)?", 1)
    # one blank alone ends the host: "*" of a host rule cannot run past it
    plain = lambda c: F.translate(c, " ", "\x01")
    parsed = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"), query.alias("query")).select(
        "page_id", "host", "path", F.concat(F.lit("."), plain("host"), F.lit(" "), plain("path"), plain("query")).alias("url")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = GlobSet(globs)
        for batch in batches:
            raw, offsets = utf8(batch.column("url"))
            fits = rules.match(raw, offsets)
            best = np.full(batch.num_rows, -1)
            for k in rank:  # shortest first, so the longest is set last
                best[fits[:, k]] = k
            blocked = fits[:, len(names) :].any(axis=1)
            rule = [names[k] if k >= 0 else None for k in best]
            verdict = [verdicts[k] if k >= 0 else ("block" if b else "allow") for k, b in zip(best, blocked)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    batch.column("host").cast(pa.string()),
                    batch.column("path").cast(pa.string()),
                    pa.array(rule, pa.string()),
                    pa.array(verdict, pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return parsed.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
