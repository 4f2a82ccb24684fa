"""Near duplicates of embeddings by small-world graphs.

The vectors of a label are dealt into shards.  A task builds the hierarchical graph of one shard and
answers a block of the label's vectors: a beam walks the graph, and is widened for the whole shard until an
audit against brute force passes, and for one query while all it holds are links.  A shard whose audit never passes is answered by
brute force.  Equal vectors of a label are one node with their number.  Links are verified by cosine in double precision; connected
links become components.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.components import components, forest
from clicktrail.llm.store import join_small, staged

COSINE = 0.98
SHARD_ROWS = 4096
BLOCK_ROWS = 65_536  # queries that one task answers
NEIGHBOURS = 12
BEAM = 48
AUDIT_ROWS = 64
AUDIT_RECALL = 0.99
FLUSH_ROWS = 100_000  # linked rows a task holds before it hands its links on


class Graph:
    """A hierarchical navigable small world of unit vectors."""

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BEAM):
        self.v = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        self.m = neighbours
        self.seen = np.zeros(n, np.int64)
        self.walk = 0
        draws = np.random.default_rng(n).random(n)
        self.level = np.floor(-np.log1p(-draws) / math.log(neighbours)).astype(int).tolist()
        self.links: list[list[np.ndarray]] = [[np.zeros(0, np.int32)] * (k + 1) for k in self.level]
        self.entry = 0
        for i in range(1, n):
            self._insert(i, beam)

    def _beam(self, q: np.ndarray, starts: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The best found, best first, walking one layer with a beam."""
        self.walk += 1
        tick, seen, v, links = self.walk, self.seen, self.v, self.links
        at = np.array(starts)
        seen[at] = tick
        best = list(zip((v[at] @ q).tolist(), starts, strict=True))
        heapq.heapify(best)
        todo = [(-s, i) for s, i in best]
        heapq.heapify(todo)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            s, i = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            near = links[i][layer]
            near = near[seen[near] != tick]
            if not len(near):
                continue
            seen[near] = tick
            for s, j in zip((v[near] @ q).tolist(), near.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (s, j))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, j))
                else:
                    continue
                heapq.heappush(todo, (-s, j))
        best.sort(reverse=True)
        return best

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions first: one that is nearer to a chosen one than to the node comes last."""
        ids = np.array([i for _, i in found])
        v = self.v[ids]
        between = v @ v.T
        chosen: list[int] = []
        rest: list[int] = []
        for k, (s, _) in enumerate(found):
            if len(chosen) >= most:
                break
            (rest if chosen and between[k, chosen].max() > s else chosen).append(k)
        return ids[(chosen + rest)[:most]].tolist()

    def _insert(self, i: int, beam: int) -> None:
        q, top = self.v[i], self.level[self.entry]
        at = [self.entry]
        for layer in range(top, self.level[i], -1):
            at = [self._beam(q, at, 1, layer)[0][1]]
        for layer in range(min(top, self.level[i]), -1, -1):
            found = self._beam(q, at, beam, layer)
            near = self._spread(found, self.m)
            self.links[i][layer] = np.array(near, np.int32)
            for j in near:
                mine = np.append(self.links[j][layer], np.int32(i))
                if len(mine) > 3 * self.m:
                    order = sorted(zip((self.v[mine] @ self.v[j]).tolist(), mine.tolist(), strict=True), reverse=True)
                    mine = np.array(self._spread(order, 2 * self.m), np.int32)
                self.links[j][layer] = mine
            at = [j for _, j in found]
        if self.level[i] > top:
            self.entry = i

    def within(self, q: np.ndarray, least: float, width: int) -> np.ndarray:
        """Nodes found whose cosine is about ``least`` or more; the beam doubles while it holds nothing else."""
        at = [self.entry]
        for layer in range(self.level[self.entry], 0, -1):
            at = [self._beam(q, at, 1, layer)[0][1]]
        while True:
            found = self._beam(q, at, width, 0)
            if found[-1][0] < least or len(found) < width or width >= len(self.v):
                return np.array([i for s, i in found if s >= least - 1e-4], np.int64)
            width *= 2


class Shard:
    """A graph with the beam that its audit asks for; brute force if no beam passes."""

    def __init__(self, units: np.ndarray, beam: int = BEAM):
        self.units = units
        self.graph = Graph(units)
        self.beam = beam
        self.exact = False
        while not self.exact and not self._passes():
            self.exact = self.beam >= len(units)
            self.beam *= 2

    def _passes(self) -> bool:
        """Vectors moved to just inside the limit must lead back to all that brute force finds near them.

        Each vector counts alike, so that one with very many links does not hide others without theirs.
        """
        rng = np.random.default_rng(7)
        rows = np.unique(np.linspace(0, len(self.units) - 1, AUDIT_ROWS).astype(int))
        noise = rng.normal(size=(len(rows), self.units.shape[1]))
        base = self.units[rows]
        noise -= (noise * base).sum(1, keepdims=True) * base
        size = np.linalg.norm(noise, axis=1, keepdims=True)
        angle = math.acos(COSINE) * 0.95
        moved = math.cos(angle) * base + math.sin(angle) * np.where(size > 0, noise / np.where(size > 0, size, 1), base)
        there = moved @ self.units.T >= COSINE
        found = [there[k, self.graph.within(q.astype(np.float32), COSINE, self.beam)].sum() for k, q in enumerate(moved)]
        return (found / np.maximum(1, there.sum(1)))[there.any(1)].sum() >= AUDIT_RECALL * there.any(1).sum()

    def links(self, q: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.flatnonzero(self.units @ q >= COSINE)
        found = self.graph.within(q.astype(np.float32), COSINE, self.beam)
        return found[self.units[found] @ q >= COSINE]


_LINKED = "row long, n long, a long, b long"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task, a shard's own rows before the queries.

    Gives (row, n) for every query that finds something, n being how many vectors equal the nodes found, and (a, b) for links that
    connect what is found.
    """
    task, rows, ids, equal, units, shard = None, [], [], [], [], None
    counts: list[tuple[int, int]] = []
    pairs: list[tuple[int, int]] = []

    def flush() -> pa.RecordBatch:
        tree = forest(*zip(*pairs, strict=True)) if pairs else []
        n = [None] * len(counts)
        m = [None] * len(tree)
        out = [[r for r, _ in counts] + m, [c for _, c in counts] + m, n + [a for a, _ in tree], n + [b for _, b in tree]]
        counts.clear()
        pairs.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["row", "n", "a", "b"])

    for batch in batches:
        # Tasks of other lengths may share the batch.
        flat, ends = batch.column("unit").values.to_numpy(), batch.column("unit").offsets.to_numpy()
        columns = (batch.column(c).to_pylist() for c in ("task", "query", "row", "vec_id", "n_equal"))
        for k, (t, query, row, vec, n_equal) in enumerate(zip(*columns, strict=True)):
            unit = flat[ends[k] : ends[k + 1]]
            if t != task:
                task, rows, ids, equal, units, shard = t, [], [], [], [], None
            if not query:
                rows.append(row)
                ids.append(vec)
                equal.append(n_equal)
                units.append(unit.copy())
                continue
            if shard is None:
                shard = Shard(np.stack(units))
            found = [j for j in shard.links(unit).tolist() if rows[j] != row]
            if found:
                counts.append((row, sum(equal[j] for j in found)))
                # A row that leads to its smallest link, and that to the others, connects as all of them would.
                low = min(ids[j] for j in found)
                pairs.append((vec, low))
                pairs.extend((ids[j], low) for j in found if ids[j] != low)
            if len(pairs) >= FLUSH_ROWS:
                yield flush()
    yield flush()


def near_vectors(embeddings: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings``.

    Null labels or ids and vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    as do vectors of different lengths.  Rows that repeat a vec_id are vectors of their own that share its
    component.  A null id has a null component and is not kept.  Other columns are not read.
    """
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", "label", v.alias("v"), F.monotonically_increasing_id().alias("row"))
    usable = F.expr("v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x != 0)")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.withColumn("fine", F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable, F.lit(False)))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    top = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("v", F.when(F.col("fine"), F.transform("v", lambda x: x / top)))
    unit = F.when(F.col("fine"), F.transform("v", lambda x: x / norm))
    rows = rows.select("vec_id", "label", "row", unit.alias("unit"), F.size("v").alias("d"))
    keys = {"key_a": F.when(F.col("unit").isNotNull(), F.xxhash64("unit")), "key_b": F.when(F.col("unit").isNotNull(), F.xxhash64(F.lit(1), "unit"))}
    vectors = staged(rows.withColumns(keys), "vectors")
    same = ["label", "d", *keys]
    good = vectors.where("unit is not null").groupBy(*same)
    good = good.agg(F.min("row").alias("row"), F.min("vec_id").alias("vec_id"), F.count("*").alias("n_equal"), F.first("unit").alias("unit"))
    good = staged(good, "nodes")

    sizes = good.groupBy("label", "d").count()
    sizes = sizes.withColumns(
        {"shards": F.ceil(F.col("count") / shard_rows).cast("int"), "blocks": F.ceil(F.col("count") / BLOCK_ROWS).cast("int")}
    )
    first = F.sum(F.col("shards") * F.col("blocks")).over(Window.orderBy("label", "d").rowsBetween(Window.unboundedPreceding, -1))
    sizes = staged(sizes.withColumn("first", F.coalesce(first, F.lit(0)).cast("long")), "sizes").drop("count")
    tasks = sizes.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 0
    placed = join_small(good, sizes, ["label", "d"], "inner").withColumns(
        {"shard": F.pmod(F.xxhash64("row"), "shards"), "block": F.pmod(F.xxhash64("row", F.lit(1)), "blocks")}
    )
    columns = ["row", "vec_id", "n_equal", "unit"]
    number = F.col("first") + F.col("shard") * F.col("blocks") + F.col("block")
    index = placed.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(number.alias("task"), F.lit(False).alias("query"), *columns)
    asked = placed.withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)"))).select(number.alias("task"), F.lit(True).alias("query"), *columns)
    dealt = index.union(asked).repartition(max(1, min(3 * tasks, 20_000)), "task").sortWithinPartitions("task", "query")
    found = staged(dealt.mapInArrow(_search, _LINKED), "found")

    counts = found.where("row is not null").groupBy("row").agg(F.sum("n").alias("n"))
    # A row has the links of its node, and its equals; it is connected with the smallest id of these.
    nodes = good.join(counts, "row", "left").select(*same, F.col("vec_id").alias("first"), (F.coalesce("n", F.lit(0)) + F.col("n_equal") - 1).alias("n"))
    out = staged(join_small(vectors.drop("unit"), staged(nodes, "counts"), same).select("vec_id", "first", "n"), "rows")
    links = found.where("a is not null").select("a", "b").union(out.where("first != vec_id").select("vec_id", "first"))
    groups = components(links)
    out = out.join(groups, out["vec_id"] == groups["node"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
fine AS (SELECT * FROM v WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y USING (label)
      WHERE x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
