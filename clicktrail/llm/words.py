"""Words and word hashes of whole batches of texts, without a Python loop over words.

A word is a run of bytes other than space and \\x09-\\x0D; in UTF-8 these bytes are
never part of another character.  A word's hash is a polynomial over random byte
values, taken from running sums of the batch, so its cost does not depend on the
number of words.  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # text hashed at a time; a longer text is a chunk of its own

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... of at least n terms."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = known
    return known[:n]


def polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of values[start + j] * BASE**j of every range, from one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    return (total[ends] - total[starts]) * powers(_BACK, len(values) + 1)[starts]


@dataclass
class Words:
    """The words of some texts: byte ranges in ``data``, hashes, and each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of text i and, at the end, the number of words

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """How many words of its text start at or after each word."""
        return np.repeat(self.first[1:], self.count()) - np.arange(len(self.start))

    def grams(self, n: int) -> np.ndarray:
        """A hash of the n words from each word on; those that run out of their text are 0."""
        out = np.zeros(len(self.hash), np.uint64)
        if len(out) >= n:
            at = np.flatnonzero(self.left() >= n)
            out[at] = mix(polynomial(self.hash, at, at + n) + np.uint64(n))
        return out

    def text(self, i: int, keep: np.ndarray | None = None) -> bytes:
        """The words of text i, or those kept, joined by one space."""
        a, b = self.first[i], self.first[i + 1]
        raw = self.data
        at = range(a, b) if keep is None else (np.flatnonzero(keep) + a)
        return b" ".join([raw[self.start[j] : self.end[j]].tobytes() for j in at])


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of an Arrow array of strings; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    before = np.concatenate(([False], word[:-1])) if len(data) else word
    after = np.concatenate((word[1:], [False])) if len(data) else word
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    hashes = mix(polynomial(_BYTE[data], start, end)) if len(start) else np.zeros(0, np.uint64)
    return Words(data, start, end, hashes, np.searchsorted(start, ends))


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``limit`` bytes at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def longs(x: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's long."""
    return pa.array(x.view(np.int64))
