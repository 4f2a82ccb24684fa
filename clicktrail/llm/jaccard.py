"""Documents whose sets of word shingles are similar, by trees of signatures.

Sets that can be similar differ in few shingles.  If the space of shingle hashes is cut into more segments than
that, two similar sets agree in several whole segments.  A set therefore leaves out as many of its most common ones
as this allows, so that a passage which unlike texts share does not join them.  Equal segments among the others put
sets into cells, and all links lie within cells.  In a cell, a tree is built over the sets: its nodes hold the bitmaps
of their shingles combined by OR and their range of sizes, and a dual traversal leaves out the pairs of nodes whose
largest possible overlap is too small, or that are connected already.  What is left is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.components import components
from clicktrail.llm.store import carrying, join_small, staged, unpacked
from clicktrail.llm.words import chunks, find_words, longs, mix

WORDS = 5
PERCENT = 80
BAND = 1.5  # ratio of the largest and the smallest set whose segments are cut alike
SPARE = 4  # a set can leave out one segment for so many that links need
BITS = 4096
LEAF = 8
FANOUT = 4
BLOCK_SHINGLES = 1 << 22  # of a cell, in one side of a comparison

_KEY_A, _KEY_B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def sets_of(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; fewer words make one shingle together."""
    found = find_words(texts, lower=True)
    grams = found.grams(words)
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            rest = find_words(pa.array([found.data[found.start[a] : found.end[b - 1]].tobytes().decode()]))
            yield rest.grams(b - a)[:1]
        else:
            yield grams[:0]


@lru_cache(maxsize=64)
def bands(upto: int) -> np.ndarray:
    """The smallest size of each band, as far as ``upto`` needs them."""
    low = [1]
    while low[-1] <= upto:
        low.append(max(low[-1] + 1, int(low[-1] * BAND)))
    return np.array(low)


@lru_cache(maxsize=4096)
def _edges(segments: int) -> np.ndarray:
    return np.array([-(-(k << 64) // segments) for k in range(1, segments)], np.uint64)


def segment_keys(shingles: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """(part, keys): a key for each segment of a set, in its band and, if it can be similar to a set of it, the band below.

    For a link the sets differ in at most d = n * (100 - percent) / percent shingles, n being the size of the
    smaller, which lies in the band that names the keys.  Of d + 1 + spare segments more than ``spare`` are equal,
    so a set can leave out the first ``spare`` of its segments in any order that all sets share: the last of the equal
    ones stays in both.  First in the order are segments that hold hardly anything, if they are no more than ``spare``; the
    others go by how common they are (``_rare``).  A part is twice the number that the set can still leave out, and the
    band's lowest bit, which tells the set's two bands apart.
    """
    n = len(shingles)
    if not n:
        return []
    low = bands(1 << max(10, int(n).bit_length()))
    band = int(np.searchsorted(low, n, side="right")) - 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(shingles ^ _KEY_A), out=sums[1:])
    out = []
    for b in (band, band - 1):
        if b < 0 or (b < band and percent * n > 100 * (int(low[b + 1]) - 1)):
            continue
        segments = (int(low[b + 1]) - 1) * (100 - percent) // percent + 1
        spare = segments // SPARE + 1
        segments += spare
        at = np.concatenate(([0], np.searchsorted(shingles, _edges(segments)), [n]))
        content = sums[at[1:]] - sums[at[:-1]]
        place = np.arange(segments, dtype=np.uint64) + np.uint64((b << 40) + 1)
        keys = mix(content ^ mix(place * _KEY_B))
        filled = np.diff(at) >= max(1, 100 // (100 - percent) // 3)
        left = spare - (segments - int(filled.sum()))
        out.append((2 * max(left, 0) + b % 2, keys[filled] if left >= 0 else keys))
    return out


def bitmap(shingles: np.ndarray) -> bytes:
    row = np.zeros(BITS, bool)
    row[(shingles >> np.uint64(20)) % np.uint64(BITS)] = True
    return np.packbits(row).tobytes()


class Tree:
    """Sets in leaves and nodes above them, as arrays by level, the leaves first.

    Of a set it needs the id, the size and the bitmap; its shingles are there if links are to be exact.
    """

    def __init__(self, sets: list[tuple[int, int, bytes, np.ndarray | None]]):
        sets = sorted(sets, key=lambda x: (x[1], x[0]))
        self.ids = [x[0] for x in sets]
        self.shingles = [x[3] for x in sets]
        size = np.array([x[1] for x in sets])
        bits = np.frombuffer(b"".join(x[2] for x in sets), np.uint64).reshape(len(sets), -1)
        # Shingles beyond the first on the same bit: the bits miss that much of an overlap at most.
        extra = size - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.sets = (bits, size, size, extra)
        at = np.arange(0, len(sets), LEAF)
        bits, low, high, extra = self.sets
        self.levels = []
        while True:
            bits, low, high, extra = (
                np.bitwise_or.reduceat(bits, at),
                np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at),
                np.maximum.reduceat(extra, at),
            )
            self.levels.append((bits, low, high, extra))
            if len(low) == 1:
                break
            at = np.arange(0, len(low), FANOUT)


class Connected:
    """Union-find over the sets of a comparison."""

    def __init__(self, ids: list[int]):
        self.number = {x: x for x in ids}

    def find(self, x: int) -> int:
        up = self.number
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.number[max(x, y)] = min(x, y)


def _possible(a, i: int, b, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the nodes j can hold a set similar to one of node i, by sizes and the largest overlap."""
    (bits_a, low_a, high_a, extra_a), (bits_b, low_b, high_b, extra_b) = a, b
    fine = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i])
    most = np.bitwise_count(bits_a[i] & bits_b[j]).sum(1, dtype=np.int64) + np.minimum(extra_a[i], extra_b[j])
    return fine & ((100 + percent) * most >= percent * (low_a[i] + low_b[j]))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_trees(left: list, right: list | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect all that the links between ``left`` and ``right`` (or within ``left``) connect.

    Sets without their shingles link if their bitmaps and sizes allow it.
    """
    a = Tree(left)
    b = a if right is None else Tree(right)
    connected = Connected(a.ids + b.ids)
    links: list[tuple[int, int]] = []
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        if la == lb == 0:
            rows = range(j * LEAF, min(len(b.ids), (j + 1) * LEAF))
            for p in range(i * LEAF, min(len(a.ids), (i + 1) * LEAF)):
                mine = a.ids[p]
                near = [q for q in rows if (right is not None or q > p) and connected.find(mine) != connected.find(b.ids[q])]
                if not near:
                    continue
                near = np.array(near)
                for q in near[_possible(a.sets, p, b.sets, near, percent)].tolist():
                    there = b.ids[q]
                    if connected.find(mine) == connected.find(there):
                        continue
                    if a.shingles[p] is None or similar(a.shingles[p], b.shingles[q], percent):
                        connected.join(mine, there)
                        links.append((mine, there))
            continue
        # The higher node is opened; of equals both sides of the pair are.
        if la >= lb:
            kids = np.arange(i * FANOUT, min(len(a.levels[la - 1][1]), (i + 1) * FANOUT))
            fine = _possible(b.levels[lb], j, a.levels[la - 1], kids, percent)
            todo += [(la - 1, k, lb, j) for k in kids[fine].tolist()]
        else:
            kids = np.arange(j * FANOUT, min(len(b.levels[lb - 1][1]), (j + 1) * FANOUT))
            if right is None:  # a pair of nodes of one tree is visited from one side
                kids = kids[(kids + 1) * FANOUT ** (lb - 1) > i * FANOUT**la]
            fine = _possible(a.levels[la], i, b.levels[lb - 1], kids, percent)
            todo += [(la, i, lb - 1, k) for k in kids[fine].tolist()]
    return links


def _summaries(words: int):
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            n, key = [], []
            for s in sets_of(batch.column("text"), words):
                n.append(len(s))
                sums = [int(mix(s ^ k).sum(dtype=np.uint64)) for k in (_KEY_A, _KEY_B)]
                key.append(b"".join(x.to_bytes(8) for x in sums))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(key, pa.binary())],
                names=["doc_id", "text_key", "n", "key"],
            )

    return summaries


def _segments(words: int, percent: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            nodes = batch.column("doc_id").to_pylist()
            found = [(node, *x) for node, s in zip(nodes, sets_of(batch.column("text"), words), strict=True) for x in segment_keys(s, percent)]
            ends = np.concatenate(([0], np.cumsum([len(k) for *_, k in found]))).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *(k for *_, k in found)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node for node, *_ in found], pa.int64()),
                    pa.array([part for _, part, _ in found], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), longs(flat)),
                ],
                names=["node", "part", "segments"],
            )

    return segments


def _rare(keys: DataFrame) -> DataFrame:
    """segment, node: the keys (segment, node, part) that several nodes have, without the most common ones that a part can leave out.

    How many rows have a segment, then its key, is the order that all sets share.  Texts of one doc_id leave out no more
    than one of them could.
    """
    equal = Window.partitionBy("segment")
    counted = keys.withColumns({"n": F.count("*").over(equal), "least": F.min("node").over(equal), "most": F.max("node").over(equal)})
    # Rows that repeat a document combine before they are shuffled.
    shared = counted.where("least != most").select("segment", "node", "part", "n").distinct()
    place = F.row_number().over(Window.partitionBy("node", "part").orderBy(F.desc("n"), "segment"))
    return shared.withColumn("place", place).where("place > shiftright(part, 1)").select("segment", "node")


def _sets(words: int, exact: bool):
    """Bitmaps of the members of cells, and their shingles where links are to be exact."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = list(sets_of(batch.column("text"), words))
            columns = [
                pa.array([len(s) for s in found], pa.int64()),
                pa.array([bitmap(s) for s in found], pa.binary()),
                pa.array([s.tobytes() if exact else None for s in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cell"), batch.column("doc_id"), *columns], names=["cell", "doc_id", "n", "bits", "shingles"]
            )

    return sets


def _compare(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by comparison; each is done when the next begins."""
        task, sides = None, ([], [])

        def links() -> pa.RecordBatch:
            same = task is None or task[1] == task[2]
            found = join_trees(sides[0], None if same else sides[1], percent) if sides[0] and (same or sides[1]) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("cell", "i", "j", "side", "doc_id", "n", "bits", "shingles"))
            for cell, i, j, side, doc, n, bits, raw in zip(*columns, strict=True):
                if (cell, i, j) != task:
                    if task is not None:
                        yield links()
                    task, sides = (cell, i, j), ([], [])
                sides[side].append((doc, n, bits, None if raw is None else np.frombuffer(raw, np.uint64)))
        yield links()

    return compare


def _deal(sets: DataFrame, percent: int) -> DataFrame:
    """cell, i, j, side and the set: each set in every comparison of its block with a block of its cell.

    A cell that fits is one block.  A larger one has blocks by bands of size, in which links join neighbours at
    most, and by a hash within a band.
    """
    width = math.log(100 / percent * 1.01)
    total = sets.groupBy("cell").agg((F.sum("n") > BLOCK_SHINGLES).alias("large"))
    rows = join_small(sets, staged(total, "large"), "cell", "inner")
    rows = rows.withColumn("band", F.when(F.col("large"), F.floor(F.ln("n") / width)).otherwise(0).cast("long"))
    blocks = staged(rows.groupBy("cell", "band").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks")), "blocks")
    beside = [blocks.select("cell", (F.col("band") + d).alias("band"), F.col("blocks").alias(name)) for d, name in ((1, "below"), (-1, "above"))]
    blocks = staged(blocks.join(beside[0], ["cell", "band"], "left").join(beside[1], ["cell", "band"], "left").na.fill(0), "sides")
    rows = join_small(rows, blocks, ["cell", "band"], "inner").withColumn("block", F.pmod(F.xxhash64("doc_id", "n"), "blocks"))
    name = lambda band, block: f"({band}) * 1048576 + {block}"
    parts = (
        ("blocks", name("band", "least(block, x)"), name("band", "greatest(block, x)"), "cast(block > x as int)"),
        ("below", name("band - 1", "x"), name("band", "block"), "1"),
        ("above", name("band", "block"), name("band + 1", "x"), "0"),
    )
    lists = [
        f"transform(filter(sequence(0, {n}), x -> x < {n}), x -> named_struct('i', {i}, 'j', {j}, 'side', {side}))" for n, i, j, side in parts
    ]
    return rows.withColumn("t", F.explode(F.expr(f"concat({', '.join(lists)})"))).select("cell", "t.i", "t.j", "t.side", "doc_id", "n", "bits", "shingles")


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_key, n, key, node, n_equal, component of every row; and the table of equal sets."""
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    summary = staged(texts.mapInArrow(_summaries(words), "doc_id long, text_key long, n long, key binary"), "summary")
    nodes = summary.where("n > 0 and doc_id is not null").groupBy("key", "n")
    nodes = staged(nodes.agg(F.min("doc_id").alias("node"), F.count("*").alias("n_equal")), "nodes")

    # Of equal sets one goes on.
    copies = summary.join(nodes, ["key", "n"]).where("doc_id != node").select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    known = texts.where("doc_id is not null")
    single = join_small(known, staged(copies.distinct(), "copies"), (F.col("doc_id") == F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left_anti")
    keys = single.select("doc_id", "text").mapInArrow(_segments(words, percent), "node long, part int, segments array<long>")
    rare = _rare(keys.select(F.explode("segments").alias("segment"), "node", "part"))
    first = F.min("node").over(Window.partitionBy("segment"))
    cells = components(rare.withColumn("first", first).where("first != node").select("first", "node").distinct(), "first", "node")

    for exact in (False, True):
        cells = staged(cells.select(F.col("node").alias("_node"), F.col("component").alias("cell")), "cells")
        members = join_small(known, cells, F.col("doc_id") == F.col("_node"), "inner").select("cell", "doc_id", "text")
        sets = members.mapInArrow(_sets(words, exact), "cell long, doc_id long, n long, bits binary, shingles binary").where("n > 0")
        dealt = _deal(staged(sets, "sets"), percent).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        # Written before they are united, so that one Python worker runs in a task.
        cells = components(staged(dealt.mapInArrow(_compare(percent), "a long, b long"), "similar"))
    joined = summary.join(nodes.select("key", "n", "node", "n_equal"), ["key", "n"], "left")
    return joined.join(cells.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").drop("_node"), nodes


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_equal of every row of ``docs``; rows link at a Jaccard similarity of ``percent`` or more.

    Null and empty texts and texts without words have no shingles, link with nothing and are their own
    component.  Equal sets are one node, whatever their number (``n_equal``), so copies are compared once.  Rows that
    repeat a doc_id follow their own text.  A null doc_id links with nothing and has a null component.
    Other columns are not read.
    """
    has_id = F.col("doc_id").isNotNull()
    return _classes(docs, words, percent)[0].select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(has_id, F.coalesce("component", "node", "doc_id")).alias("component_id"),
        F.when(has_id, F.coalesce("n_equal", F.lit(1))).alias("n_equal"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component: of the smallest doc_id, and of equal rows of it any one.

    Rows without words link with nothing; only repeats of a doc_id and text go.  A null doc_id stands behind all others:
    its row goes where another row has the same set, and of the rest one row of each set stays, also of the empty one.
    Rows of one doc_id with different texts follow their own text each.
    """
    classes, nodes = _classes(docs, words, percent)
    classes = staged(classes.select("doc_id", "text_key", "n", "key", F.coalesce("component", "node", "doc_id").alias("component")), "classes")
    pair = ["doc_id", "text_key"]
    names = {"doc_id": "_doc", "text_key": "_key"}
    gone = staged(classes.where("doc_id != component").select(*pair).distinct().withColumnsRenamed(names), "gone")
    counts = classes.where("doc_id = component").groupBy(*pair).count()
    repeats = staged(counts.where("count > 1").select(*pair).withColumnsRenamed(names), "repeats")
    alone = classes.where("doc_id is null").groupBy("key", "n").agg(F.min("text_key").alias("_key"))
    alone = staged(alone.join(nodes.select("key", "n"), ["key", "n"], "left_anti").select("_key"), "alone")

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    on = (F.col("doc_id") == F.col("_doc")) & (key == F.col("_key"))
    rows = carrying(docs, "doc_id", "text")
    known = join_small(rows.where("doc_id is not null"), gone, on, "left_anti")
    some = join_small(rows.where("doc_id is null"), alone, key == F.col("_key"), "left_semi")
    if repeats.isEmpty():
        kept = known
    else:
        kept = join_small(known, repeats, on, "left_anti")
        some = some.union(join_small(known, repeats, on, "left_semi"))
    # Equal rows combine before they are shuffled.
    once = some.groupBy("doc_id", key.alias("_key")).agg(F.first(F.struct("text", "carried")).alias("row"))
    kept = kept.union(once.select("doc_id", "row.text", "row.carried"))
    return kept.select(*unpacked(docs.columns, "doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (gram) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""
