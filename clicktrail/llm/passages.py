"""Long passages that repeat earlier documents, by compressed full-text indexes of shards.

Every window of words is named by the least hash of the word grams in it; windows in a row with the same least
gram form a segment, and equal windows of different documents lie in segments of the same gram.  So the
segments are sharded by gram, and a gram met once is left out.  A shard's distinct segments are the text of
an FM-index: the Burrows-Wheeler transform in a wavelet tree of packed bits.  Each segment is streamed
backwards through it; where the match reaches the window's length, the interval of the suffix array tells the
smallest document that has the window.

Grams of passages that very many documents share rank last, whichever their hash: a window that reaches
beyond such a passage is then named by a rarer gram, and what remains of the passage is the same
segment everywhere, which is counted before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.store import BROADCAST_ROWS, join_small, staged
from clicktrail.llm.words import Words, chunks, find_words, longs, mix, polynomial

WINDOW = 50
GRAM = 8
#: Grams in more than one of so many documents rank last; a text has few hundred grams, so they are a bounded list.
COMMON = 200
COUNTED_BYTES = 4 << 20  # of text in which grams are counted together
INDEX_WORDS = 1 << 20  # of an index, unless one gram has more

_LAST = np.uint64(1 << 63)


def gram_keys(words: Words, common: np.ndarray) -> np.ndarray:
    """The rank of the gram at each word: by its hash, common ones after all others."""
    keys = words.grams(GRAM) >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        keys = np.where(common[at] == keys, keys | _LAST, keys)
    return keys


def segments(words: Words, common: np.ndarray, window: int = WINDOW):
    """First word, number of windows, least gram and content hash of every segment."""
    n = len(words.hash)
    if n < window:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    keys = gram_keys(words, common)
    span = window - GRAM + 1
    best, size = np.arange(n), 1
    while size < span:  # the leftmost least gram of twice as many places, until the window is full
        step = min(size, span - size)
        there = best[step:]
        best = np.where(keys[best[: len(there)]] <= keys[there], best[: len(there)], there)
        size += step
    at = np.flatnonzero(words.left()[: len(best)] >= window)
    if not len(at):
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    least = best[at]
    first = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1))))
    count = np.diff(np.concatenate((first, [len(at)])))
    start = at[first]
    content = mix(polynomial(words.hash, start, start + count + window - 1) + count.astype(np.uint64))
    return start, count, keys[least[first]], content


class Bits:
    """Packed bits with the number of ones before each block of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    def ones(self, i: np.ndarray) -> np.ndarray:
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[block] + np.bitwise_count(self.words[block] & ((np.uint64(1) << bit) - np.uint64(1)))


class Wavelet:
    """A wavelet tree, level by level: how often a symbol is among the first i."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.depth = max(1, int(kinds - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        row = symbols
        for k in range(self.depth - 1, -1, -1):
            bit = (row >> k) & 1
            zeros = int(len(row) - bit.sum())
            self.levels.append((Bits(bit.astype(np.uint8)), zeros))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        self.first = np.searchsorted(row, np.arange(kinds)) if (np.diff(row) >= 0).all() else self._first(row, kinds)

    @staticmethod
    def _first(row: np.ndarray, kinds: int) -> np.ndarray:
        out = np.zeros(kinds, np.int64)
        change = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        out[row[change]] = change
        return out

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            ones = bits.ones(i)
            i = np.where((symbol >> k) & 1 == 1, zeros + ones, i - ones)
        return i - self.first[symbol]


class Index:
    """An FM-index of texts of words, with the smallest owner of every window of the given length."""

    def __init__(self, texts: list[np.ndarray], owners: np.ndarray, window: int):
        if window > 64:
            raise ValueError("windows of up to 64 words")
        size = np.array([len(t) for t in texts])
        self.vocabulary, ids = np.unique(np.concatenate(texts), return_inverse=True)
        ends = np.cumsum(size + 1) - 1
        text = np.zeros(ends[-1] + 1, np.int64)  # 0 ends a text, words count from 1
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = ids + 1
        # Suffixes in order, comparing twice as many words each time; the ends differ from each other, so none compares beyond its text.
        rank = np.where(inside, text + len(texts), 0)
        rank[ends] = np.arange(len(texts))
        length, longest, at_32 = 1, int(size.max()) + 1, None
        order = np.argsort(rank, kind="stable")
        while True:
            if length == 32:
                at_32 = rank
            if length >= max(64, longest):
                break
            far = np.zeros(len(rank), np.int64)
            if length < len(rank):
                far[:-length] = rank[length:] + 1
            both = rank * (int(rank.max()) + 2) + far
            order = np.argsort(both, kind="stable")
            steps = both[order]
            rank = np.empty(len(order), np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(steps[1:] != steps[:-1])))
            length *= 2
        kinds = len(self.vocabulary) + 1
        self.tree = Wavelet(text[order - 1], kinds)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=kinds))))[:kinds]
        self.size = len(text)
        # Neighbouring suffixes with a window in common make a group; its smallest owner is what a window asks for.
        if window >= 32:
            near, far = at_32[order], at_32[np.minimum(order + window - 32, len(order) - 1)]
            same = (near[1:] == near[:-1]) & (far[1:] == far[:-1])
        else:
            same = self._common(text, order, ends, window)
        head = np.flatnonzero(np.concatenate(([True], ~same)))
        self.group = np.cumsum(np.concatenate(([0], ~same)))
        owner = np.repeat(owners, size + 1)[order]
        self.smallest = np.minimum.reduceat(owner, head)

    @staticmethod
    def _common(text: np.ndarray, order: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
        """For short windows: whether neighbouring suffixes have their first ``window`` words in common."""
        room = ends[np.searchsorted(ends, order)] - order >= window
        out = room[1:] & room[:-1]
        for k in range(window):
            at = np.minimum(order + k, len(text) - 1)
            out &= text[at[1:]] == text[at[:-1]]
        return out

    def owners_of_windows(self, texts: list[np.ndarray], window: int) -> list[np.ndarray]:
        """For every window of each text, the smallest owner of a text of the index that has it; -1 if none was matched.

        All texts step backwards together.  A match that cannot be extended starts again, so windows are found
        whole for texts of the index, whose matches never end.
        """
        size = np.array([len(t) for t in texts])
        flat = np.concatenate(texts)
        ids = np.searchsorted(self.vocabulary, flat)
        known = self.vocabulary[np.minimum(ids, len(self.vocabulary) - 1)] == flat
        ids = np.where(known, ids + 1, 0)
        base = np.cumsum(size) - size
        low, high, length = np.zeros(len(texts), np.int64), np.full(len(texts), self.size), np.zeros(len(texts), np.int64)
        out = np.full(len(flat), -1, np.int64)
        for back in range(1, int(size.max(initial=0)) + 1):
            live = np.flatnonzero(size >= back)
            at = base[live] + size[live] - back
            word = ids[at]
            lo = self.first[word] + self.tree.rank(word, low[live])
            hi = self.first[word] + self.tree.rank(word, high[live])
            fits = (hi > lo) & (word > 0)
            low[live], high[live] = np.where(fits, lo, 0), np.where(fits, hi, self.size)
            length[live] = np.where(fits, length[live] + 1, 0)
            full = length[live] >= window
            out[at[full]] = self.smallest[self.group[low[live][full]]]
        return [out[b : b + max(0, s - window + 1)] for b, s in zip(base.tolist(), size.tolist(), strict=True)]


def _common_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams in several documents of a chunk of text, and in how many."""
    for batch in chunks(batches, "text", COUNTED_BYTES):
        words = find_words(batch.column("text"))
        keys, left = words.grams(GRAM) >> np.uint64(1), words.left()
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), words.count())
        keys, doc = keys[left >= GRAM], doc[left >= GRAM]
        grams, n = np.unique(keys, return_counts=True)
        least = max(6, batch.num_rows // (2 * COMMON))
        often = grams[n >= least]
        if len(often):
            # Of these, how many documents: a gram repeated within one counts once.
            at = np.minimum(np.searchsorted(often, keys), len(often) - 1)
            hit = often[at] == keys
            pairs = np.unique(at[hit].astype(np.uint64) * np.uint64(batch.num_rows) + doc[hit])
            n = np.bincount((pairs // np.uint64(batch.num_rows)).astype(np.int64), minlength=len(often))
            often, n = often[n >= least], n[n >= least]
        else:
            n = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([longs(often), pa.array(n, pa.int64())], names=["gram", "n"])


def common_grams(docs: DataFrame) -> np.ndarray:
    """Sorted ranks of the grams in more than a COMMON-th of the documents; which they are changes no result."""
    counted = docs.select("text").mapInArrow(_common_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") * COMMON >= docs.count())
    return np.sort(np.array([r.gram for r in often.select("gram").collect()], np.int64)).view(np.uint64)


def _list_segments(common: np.ndarray, window: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = find_words(batch.column("text"))
            start, count, gram, content = segments(words, common, window)
            ends = pa.array(np.searchsorted(start, words.first).astype(np.int32))
            doc = np.searchsorted(words.first, start, side="right") - 1
            columns = [pa.array(start - words.first[doc]), pa.array(count), longs(gram), longs(content)]
            lists = [pa.ListArray.from_arrays(ends, c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *lists], names=["doc_id", "key", "start", "count", "gram", "content"]
            )

    return found


def _words_of_segments(common: np.ndarray, window: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = find_words(batch.column("text"))
            start, count, gram, content = segments(words, common, window)
            doc = np.searchsorted(words.first, start, side="right") - 1
            ids, wanted = batch.column("doc_id").to_pylist(), [{(w["gram"], w["content"]) for w in x} for x in batch.column("wanted").to_pylist()]
            names = list(zip(gram.view(np.int64).tolist(), content.view(np.int64).tolist(), strict=True))
            pick = [k for k, name in enumerate(names) if name in wanted[doc[k]]]
            rows = [[names[k][0] for k in pick], [names[k][1] for k in pick], [ids[doc[k]] for k in pick]]
            raw = [words.hash[start[k] : start[k] + count[k] + window - 1].tobytes() for k in pick]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in rows), pa.array(raw, pa.binary())], names=["gram", "content", "owner", "words"]
            )

    return texts


def _search_shard(window: int):
    out = pa.list_(pa.int64())

    def answers(names: list[tuple[int, int]], owners: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
        index = Index(texts, np.array(owners, np.int64), window)
        at, size, earliest = [], [], []
        for owner in index.owners_of_windows(texts, window):
            head = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            at.append(head)
            size.append(np.diff(np.concatenate((head, [len(owner)]))))
            earliest.append(owner[head])
        return pa.RecordBatch.from_arrays(
            [pa.array([g for g, _ in names], pa.int64()), pa.array([c for _, c in names], pa.int64()), *(pa.array(x, out) for x in (at, size, earliest))],
            names=["gram", "content", "at", "size", "earliest"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram and content; an index ends with a gram."""
        names, owners, texts, held = [], [], [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("gram", "content", "owner", "words"))
            for gram, content, owner, raw in zip(*columns, strict=True):
                if held >= INDEX_WORDS and gram != names[-1][0]:
                    yield answers(names, owners, texts)
                    names, owners, texts, held = [], [], [], 0
                if names and names[-1] == (gram, content):
                    owners[-1] = min(owners[-1], owner)
                    continue
                names.append((gram, content))
                owners.append(owner)
                texts.append(np.frombuffer(raw, np.uint64))
                held += len(texts[-1])
        if names:
            yield answers(names, owners, texts)

    return search


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, key (of the text) and ``cuts``: word ranges (first, end) whose windows start in a document with a smaller doc_id."""
    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    common = common_grams(docs)
    lists = "start array<long>, count array<long>, gram array<long>, content array<long>"
    listed = staged(rows.mapInArrow(_list_segments(common, window), f"doc_id long, key long, {lists}"), "segments")
    each = listed.select("doc_id", "key", F.explode(F.arrays_zip("start", "count", "gram", "content")).alias("s")).select("doc_id", "key", "s.*")

    distinct = each.groupBy("gram", "content").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    met = F.sum("n").over(Window.partitionBy("gram"))
    wanted = staged(distinct.withColumn("met", met).where("met > 1").drop("met"), "wanted")
    by_doc = wanted.groupBy("first").agg(F.collect_list(F.struct("gram", "content")).alias("wanted"))
    some = join_small(rows.select("doc_id", "text"), staged(wanted.select(F.col("first").alias("doc_id")).distinct(), "sources"), "doc_id", "left_semi")
    words = some.join(by_doc, F.col("doc_id") == F.col("first")).select("doc_id", "text", "wanted")
    texts = words.mapInArrow(_words_of_segments(common, window), "gram long, content long, owner long, words binary")
    dealt = texts.repartition("gram").sortWithinPartitions("gram", "content")
    runs = "at array<long>, size array<long>, earliest array<long>"
    found = staged(dealt.mapInArrow(_search_shard(window), f"gram long, content long, {runs}"), "found")

    hits = each.join(found, ["gram", "content"]).where(F.exists("earliest", lambda x: x < F.col("doc_id")))
    hits = hits.select("doc_id", "key", "start", F.explode(F.arrays_zip("at", "size", "earliest")).alias("r")).where("r.earliest < doc_id")
    cut = F.struct((F.col("start") + F.col("r.at")).alias("first"), (F.col("start") + F.col("r.at") + F.col("r.size") + window - 1).alias("end"))
    # A set, since rows that repeat a doc_id and text bring the same ranges each.
    return staged(hits.groupBy("doc_id", "key").agg(F.collect_set(cut).alias("cuts")), "cuts")


def _cut(keep_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            n, removed, digest, kept = [], [], [], []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist(), strict=True):
                words = (text or "").encode().split()  # of bytes: at ASCII white space only
                n.append(len(words))
                if cuts:
                    stay = np.ones(len(words), bool)
                    for c in cuts:
                        stay[c["first"] : c["end"]] = False
                    words = [words[k] for k in np.flatnonzero(stay).tolist()]
                removed.append(n[-1] - len(words))
                rest = b" ".join(words)
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words that stay) of every row of ``docs``.

    A word goes if a window of words over it also starts in a document with a smaller doc_id; windows are judged on
    the input.  Null and empty texts have no words.  Rows that repeat a doc_id take nothing from each other, and a
    null doc_id neither takes nor loses words.  Other columns are not read.
    """
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    cuts = repeated_intervals(docs, window).withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    on = (F.col("doc_id") == F.col("_doc")) & (F.col("key") == F.col("_key"))
    if cuts.count() <= BROADCAST_ROWS:
        # Only the texts that lose words are shuffled.
        names = F.broadcast(cuts.select("_doc", "_key"))
        whole = rows.join(names, on, "left_anti").select("doc_id", "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"))
        parts = rows.join(names, on, "left_semi").join(cuts, on).select("doc_id", "text", "cuts").union(whole)
    else:
        parts = rows.join(cuts, on, "left").select("doc_id", "text", "cuts")
    return parts.mapInArrow(_cut(keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
      lambda x: x <> '') AS w FROM documents),
v AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE doc_id IS NOT NULL)),
f AS (SELECT s, min(doc_id) AS first FROM v GROUP BY s),
c AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM v JOIN f USING (s) WHERE first < doc_id) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (r)
"""
