"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.session import new_path, written


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared storage and read it back, so that a lost executor costs no earlier step."""
    return written(df, new_path(df.sparkSession, f"llm-{name}"))


BROADCAST_ROWS = 200_000  # of a few numbers each: some MB


def join_small(df: DataFrame, side: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a written table that is usually small: broadcast it if its counted rows allow, else let Spark shuffle.

    Only the physical plan depends on the count; adaptive execution splits hot keys of the shuffled join.
    """
    return df.join(side.hint("broadcast") if side.count() <= BROADCAST_ROWS else side, on, how)


def carrying(docs: DataFrame, *names: str) -> DataFrame:
    """The columns named, and all others in one, so that nothing a plan adds can clash with them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, (F.struct(*rest) if rest else F.struct(F.lit(0).alias("nothing"))).alias("carried"))


def unpacked(columns: list[str], *names: str) -> list[Column]:
    """The columns of the table that :func:`carrying` was given, in their order."""
    return [F.col(c) if c in names else F.col("carried")[c].alias(c) for c in columns]


def with_length(out: DataFrame, docs: DataFrame) -> DataFrame:
    """``n_chars`` of changed texts, where ``docs`` has the column."""
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
