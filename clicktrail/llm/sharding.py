"""Contiguous shards of near equal bytes.

Documents are put in the order of ``doc_id`` by ranges; every partition adds up its
own sizes, and the totals of the partitions give each its start.  A document goes to
the shard in which the middle of its bytes lies, so a shard misses its target by at most one
document at either end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.store import carrying, staged, unpacked


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = total + np.cumsum(size)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(len(size), part, np.int32)),
                pa.array(ends - size),
                pa.array(np.arange(rows, rows + len(size))),
            ],
            names=[*batch.schema.names, "part", "before", "row"],
        )
        rows, total = rows + len(size), int(ends[-1]) if len(size) else total


def assign_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``.

    Size is the UTF-8 bytes of the text plus 1, so empty and null texts take room too.  Rows
    with a null ``doc_id`` come first; rows that share one follow the order of the scan, and each is a
    row of the result.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = sized.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = staged(
        ranged.mapInArrow(_running, "doc_id long, size long, text_crc32 long, part int, before long, row long"), "shards"
    )
    # One row for each partition: as few as the cluster has partitions.
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("part_bytes"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("part_rows"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    placed = rows.join(F.broadcast(starts), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr(f"(2 * (part_bytes + before) + size) * {int(shards)} div (2 * all_bytes)").alias("cut"),
        (F.col("part_rows") + F.col("row")).alias("at"),
    )
    placed = placed.withColumn("shard", F.least(F.col("cut"), F.lit(shards - 1)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))  # at most one row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write ``docs`` as one folder for each shard, its rows in slot order within files.

    ``doc_id`` must be unique here, since texts are joined with their places by it.
    """
    places = assign_shards(docs, shards).select(F.col("doc_id").alias("_doc"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    out = carrying(docs, "doc_id").join(staged(places, "places"), F.col("doc_id").eqNullSafe(F.col("_doc")))
    out = out.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    out.select(*unpacked(docs.columns, "doc_id"), F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)


# The checksum byte by byte, from a table that its polynomial makes.
ORACLE = r"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, doc_id, strlen(coalesce(text, '')) + 1 AS size,
      hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT r, doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 1),
        lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
      FROM d, t),
s AS (SELECT *, (2 * (sum(size) OVER (ORDER BY r) - size) + size) * 16 // (2 * sum(size) OVER ()) AS cut FROM b)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, least(cut, 15)::INTEGER AS shard,
       row_number() OVER (PARTITION BY least(cut, 15) ORDER BY r) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s
"""
