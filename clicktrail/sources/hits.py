"""Reading hit files."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.text import without_cr
from clicktrail.rules import Rules


def reader(spark: SparkSession, delimiter: str, encoding: str = "UTF-8") -> DataFrameReader:
    return (
        spark.read.option("sep", delimiter)
        .option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
    )


def read_hits(
    spark: SparkSession, paths: str | Sequence[str], rules: Rules = Rules(), delimiter: str = "\t"
) -> DataFrame:
    """Hit files as text columns, plus ``pos`` (arrival order) and ``source_file``.

    Columns go by the header of the first file.  Every file's header is then
    checked against it, so a file with another column order fails instead of
    filling the wrong columns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = reader(spark, delimiter, rules.file_encoding).csv(paths).schema
    raw = reader(spark, delimiter, rules.file_encoding).schema(schema).option("enforceSchema", False).csv(paths)
    return positioned(raw, rules)


def has_stored_positions(hits: DataFrame) -> bool:
    """Whether a second scan gives every row the position that the first one gave it.

    Row numbers follow from how a scan of text files is split, which may differ between two scans.
    """
    return hits._jdf.queryExecution().analyzed().deterministic()


def with_stored_positions(hits: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hits whose positions hold for every later scan: text files are parsed once and staged with them."""
    return hits if has_stored_positions(hits) else stage(hits)


def plain_path(encoded: Column) -> Column:
    """A path as listings show it, from the percent-encoded form of file metadata."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path for a reader that takes globs, with nothing left to expand."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def positioned(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Clean text columns of a file scan and record where each row came from.

    Within a file rows are ordered by block and row; files go by name, which
    for names with a timestamp is the order of delivery.  Everything but the
    row number is constant per block, so it costs no work per row and
    compresses away in shuffles.  The row number belongs to this scan; plans
    that compare positions of two scans stage the hits first.
    """
    path = F.col("_metadata.file_path")
    position = F.struct(
        F.col("_metadata.file_name").alias("file_name"),
        F.xxhash64(path).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    columns = [without_cr(F.col(f"`{c}`")).alias(c) if rules.strip_crlf else F.col(f"`{c}`") for c in raw.columns]
    return raw.select(*columns, position.alias("pos"), plain_path(path).alias("source_file"))
