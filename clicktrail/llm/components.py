"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.store import join_small, staged

ONE_TASK = 200_000  # links that a task may hold


def forest(a, b) -> list[tuple[int, int]]:
    """(node, smallest node reachable) of every node of the links given, but for the smallest themselves."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for x, y in zip(a, b, strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in root if find(x) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what the links of a partition connect, ONE_TASK of them at a time at most."""
    x: list[int] = []
    y: list[int] = []

    def tree() -> pa.RecordBatch:
        found = forest(x, y)
        x.clear()
        y.clear()
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["x", "y"])

    for batch in batches:
        for k in range(0, batch.num_rows, ONE_TASK):
            if len(x) + min(ONE_TASK, batch.num_rows - k) > ONE_TASK:
                yield tree()
            x += batch.column("x").slice(k, ONE_TASK).to_pylist()
            y += batch.column("y").slice(k, ONE_TASK).to_pylist()
    yield tree()


def _round(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours, then all its neighbours, below the smallest node next to it.

    The smallest neighbours are written tables, so that the joins with them can be split where a node
    has very many links.
    """
    both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    low = both.groupBy("x").agg(F.min("y").alias("low"))
    low = staged(low.select("x", F.least("x", "low").alias("low")), "low")
    large = join_small(both.where("y > x"), low, "x", "inner").select(F.col("y").alias("x"), F.col("low").alias("y")).distinct()
    large = staged(large, "large")
    low = staged(large.groupBy("x").agg(F.min("y").alias("low")), "low")
    small = join_small(large, low, "x", "inner")
    small = small.where("y != low").select(F.col("y").alias("x"), F.col("low").alias("y")).union(low.select("x", F.col("low").alias("y")))
    return staged(small.where("x != y").distinct(), "small")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node and the smallest node that it reaches.

    Partitions first reduce their own links to trees.  Then rounds of joins shorten all paths, in a number that
    grows with the logarithm of the longest one; each round is a written table.  Once the links are counted
    to be few enough for a task, one task finishes.  Nulls link nothing; no links give no rows.
    """
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = edges.select(F.greatest(a, b).cast("long").alias("x"), F.least(a, b).cast("long").alias("y"))
    edges = staged(edges.mapInArrow(_contract, "x long, y long"), "links")
    seen = None
    while True:
        n, state = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if n <= ONE_TASK:
            edges = staged(edges.coalesce(1).mapInArrow(_contract, "x long, y long"), "trees")
            break
        if (n, state) == seen:
            break
        seen = (n, state)
        edges = _round(edges)
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).union(roots)
