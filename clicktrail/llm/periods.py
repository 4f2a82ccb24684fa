"""Stretches of text that repeat themselves with a period, by internal pattern matching.

A text is cut into blocks of every power of two.  A run of period q that is four periods long contains such a block,
about as long as q, and the block again q words later.  So each block asks where it occurs in the window that its
size allows; occurrences in so short a window form one arithmetic progression.  The questions go to a wavelet tree over
the suffix array, whose range successor gives the first, second and last occurrence.  A progression names few
candidate periods, and each is extended to the left and right by comparing ranks of prefixes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.passages import Bits
from clicktrail.llm.words import chunks

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK_WORDS_BYTES = 1 << 20  # of texts searched together


class Successor:
    """A wavelet tree over numbers below ``limit``: how many of a range are below a value, and its k-th smallest."""

    def __init__(self, numbers: np.ndarray, limit: int):
        self.depth = max(1, int(limit - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        row = numbers
        for k in range(self.depth - 1, -1, -1):
            one = ((row >> k) & 1).astype(bool)
            self.levels.append((Bits(one), len(row) - int(one.sum())))
            row = np.concatenate((row[~one], row[one]))

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        count = np.zeros(len(low), np.int64)
        for k, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            a, b = bits.ones(low), bits.ones(high)
            one = (value >> k) & 1 == 1
            count += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return np.where(value >> self.depth > 0, count + high - low, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest, from 0."""
        out = np.zeros(len(low), np.int64)
        for level, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            a, b = bits.ones(low), bits.ones(high)
            none = (high - b) - (low - a)
            one = k >= none
            out |= one.astype(np.int64) << level
            k = np.where(one, k - none, k)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return out


class Ranks:
    """For each power of two, how many suffixes have a smaller prefix of so many words; the words' texts must end in unique symbols."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank, size = np.zeros(n, np.int64), np.ones(n, np.int64)
        self._renumber(order, symbols[order], np.zeros(n, np.int64), rank, size)
        self.levels, self.sizes = [rank], [size]
        length = 1
        while len(live := np.flatnonzero(size > 1)):
            # Only prefixes that are not alone are sorted on; one that reaches beyond its text is alone.
            old = rank[live]
            both = old * (n + 1) + rank[np.minimum(live + length, n - 1)]
            order = np.argsort(both, kind="stable")
            rank, size = rank.copy(), size.copy()
            self._renumber(live[order], both[order], old[order], rank, size)
            self.levels.append(rank)
            self.sizes.append(size)
            length *= 2

    @staticmethod
    def _renumber(place: np.ndarray, key: np.ndarray, old: np.ndarray, rank: np.ndarray, size: np.ndarray) -> None:
        """Places in order of their keys; those of one old rank are numbered on from it."""
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        group = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
        count = np.diff(np.concatenate((head, [len(key)])))
        start = old[head] + head - group[np.searchsorted(group, head, side="right") - 1]
        rank[place], size[place] = np.repeat(start, count), np.repeat(count, count)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and j on are equal."""
        n, out = len(self.levels[0]), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i + out, j + out
            fits = (a < n) & (b < n)
            rank = self.levels[k]
            out += np.where(fits & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]), 1 << k, 0)
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and j are equal."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i - out - (1 << k), j - out - (1 << k)
            fits = (a >= 0) & (b >= 0)
            rank = self.levels[k]
            out += np.where(fits & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)]), 1 << k, 0)
        return out


def _stretches(ranks: Ranks, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the longest stretch of the period around words that are equal to those a period on."""
    return at - ranks.backward(at, at + period), at + period + ranks.forward(at, at + period)


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of texts whose words are numbered and that each end in a symbol of their own."""
    none = np.zeros(0, np.int64)
    ranks = Ranks(symbols)
    n = len(symbols)
    if len(ranks.levels) < 2:
        return none, none, none
    suffixes = np.zeros(n, np.int64)
    suffixes[ranks.levels[-1]] = np.arange(n)
    # Prefixes of two words that are not alone are all that is ever asked for.
    asked = ranks.sizes[1][suffixes] > 1
    place = np.concatenate(([0], np.cumsum(asked)))
    tree = Successor(suffixes[asked], n)
    found = []
    for level in range(1, len(ranks.levels)):
        block = 1 << level
        near, far = (2 * block + 2) // 3, (4 * block - 1) // 3
        if level == 1:
            near = 1
        at = np.arange(0, n - block, block)
        rank, size = ranks.levels[level], ranks.sizes[level]
        at = at[size[at] >= (3 if level == 1 else 2)]
        if not len(at):
            continue
        low, high = place[rank[at]], place[rank[at] + size[at]]
        before, upto = tree.below(low, high, at + near), tree.below(low, high, at + far + 1)
        some = np.flatnonzero(upto > before)
        if not len(some):
            continue
        at, low, high, before, upto = (x[some] for x in (at, low, high, before, upto))
        first, last = tree.smallest(low, high, before), tree.smallest(low, high, upto - 1)
        few = upto - before <= 2
        candidates = [(at[few], first[few] - at[few]), (at[few], last[few] - at[few])]
        many = ~few
        if many.any():
            # The block has a smaller period itself.  Another run through it leaves the stretch of that period, and
            # then the ends, or the beginnings, of two such stretches lie a period of the run apart.
            p, one = at[many], first[many]
            step = tree.smallest(low[many], high[many], before[many] + 1) - one
            begin, end = _stretches(ranks, p, step)
            begin_next, end_next = _stretches(ranks, one, step)
            apart = begin != begin_next
            candidates += [(p[apart], (end_next - end)[apart]), (p[apart], (begin_next - begin)[apart])]
        p, q = (np.concatenate(x) for x in zip(*candidates, strict=True))
        good = (q > 0) & (p + q < n)
        p, q = p[good], q[good]
        start, end = _stretches(ranks, p, q)
        good = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append((start[good], end[good], q[good]))
    if not found:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # A stretch has multiples of its period too; the smallest comes first.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1]))) if len(start) else np.zeros(0, bool)
    return start[new], (end - start)[new], period[new]


def repeated_tail(doc_id: int, n: int) -> np.ndarray | None:
    """Which word stands at each place of a text that the query makes periodic; None for the others."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


def _texts(batch: pa.RecordBatch, tail: bool) -> list[list[bytes]]:
    out = []
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        words = (text or "").encode().split()  # of bytes: at ASCII white space only
        moved = repeated_tail(doc_id, len(words)) if tail and doc_id is not None else None
        out.append(words if moved is None else [words[k] for k in moved.tolist()])
    return out


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers that no two texts share, each text ended by a number of its own; and where the texts begin."""
    rows = []
    size = np.array([len(w) + 1 for w in texts])
    base = len(texts)
    for k, words in enumerate(texts):
        known: dict[bytes, int] = {}
        rows.append(np.fromiter((known.setdefault(w, base + len(known)) for w in words), np.int64, len(words)))
        rows.append(np.array([k], np.int64))
        base += len(known)
    return np.concatenate(rows), np.cumsum(size) - size


def _find(tail: bool, keep_text: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK_WORDS_BYTES):
            texts = _texts(batch, tail)
            symbols, first = _numbered(texts)
            start, length, period = runs(symbols)
            ends = np.searchsorted(start, np.concatenate((first, [len(symbols)])))
            cover = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            stays = np.cumsum(cover)[:-1] == 0
            rows = []
            for k, words in enumerate(texts):
                mine = slice(ends[k], ends[k + 1])
                s, n, q = (x[mine].tolist() for x in (start - first[k], length, period))
                each = sorted(zip(s, n, q, strict=True), key=lambda r: (r[0], r[2]))
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in each)
                if each:
                    kept = [words[i] for i in np.flatnonzero(stays[first[k] : first[k] + len(words)]).tolist()]
                else:
                    kept = words
                collapsed = b" ".join(kept)
                best = min(each, key=lambda r: (-r[1], r[0], r[2])) if each else (None, None, None)
                rows.append(
                    (
                        len(each),
                        *best,
                        best[1] * 1000 // best[2] if each else None,
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(collapsed).hexdigest(),
                        [{"start": a, "length": b, "period": c} for a, b, c in each],
                        collapsed.decode() if keep_text else None,
                    )
                )
            runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            types = [*[pa.int64()] * 5, pa.string(), pa.string(), runs_type, pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *NAMES])

    return find


NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed")
_TYPES = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, tail: bool = False, keep_text: bool = True) -> DataFrame:
    """doc_id, the number of runs, the longest one, digests, all ``runs`` and the ``collapsed`` text of every row of ``docs``.

    A run is a stretch of words of smallest period q that is at least LEAST_PERIODS periods and LEAST_WORDS words long and
    that no word beside it prolongs.  The collapsed text has of each run its first period only.  Null and empty texts
    have no words and no runs.  Rows are judged each on its own, so repeated rows have equal results.  With ``tail`` the end of every
    tenth text is first replaced by repetitions, as its doc_id says; a null doc_id changes nothing.  Other columns are not read.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_TYPES}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    found = docs.select("doc_id", "text").mapInArrow(_find(tail, keep_text), schema)
    return found if keep_text else found.drop("collapsed")
