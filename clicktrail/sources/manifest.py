"""Delivered files and which of them to take in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.paths import file_name, has_name_timestamp, is_hit_file, phase_label
from clicktrail.rules import Rules

# Reasons recorded for files that are turned away.
DUPLICATE = "duplicate"
BAD_NAME = "missing_timestamp_in_filename"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of all files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )


def relative_key(path: Column, root: str) -> Column:
    """The path below ``root``, so that words in the root cannot be taken for a phase."""
    bare = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    after = F.substring_index(path, bare.rstrip("/") + "/", -1)
    return F.ltrim(after, F.lit("/"))


def delivery_facts(files: DataFrame, root: str = "") -> DataFrame:
    """Hit files only, with key, file name and phase."""
    key = relative_key(F.col("path"), root) if root else F.col("path")
    return (
        files.where(is_hit_file(F.col("path")))
        .withColumn("key", key)
        .withColumn("file_name", file_name(F.col("key")))
        .withColumn("phase", phase_label(F.col("key")))
    )


def already_processed(deliveries: DataFrame, registry: DataFrame) -> DataFrame:
    """Deliveries whose phase and file name were processed before."""
    return deliveries.join(registry.select("phase", "file_name"), ["phase", "file_name"], "left_semi")


def not_yet_processed(deliveries: DataFrame, registry: DataFrame) -> DataFrame:
    return deliveries.join(registry.select("phase", "file_name"), ["phase", "file_name"], "left_anti")


def judged(deliveries: DataFrame, registry: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All deliveries with the reason to reject them, NULL for those to take in.

    A name that breaks the contract is reported before a repeated delivery.
    The same name twice in one batch is taken once, lowest key first.
    """
    good_name = has_name_timestamp(F.col("file_name")) | F.lit(not rules.enforce_filename_date)
    # Decide per name, then mark files by their unique key: no join sees repeated keys.
    first_keys = deliveries.where(good_name).groupBy("phase", "file_name").agg(F.min("key").alias("key"))
    accepted = not_yet_processed(first_keys, registry).select("key", F.lit(True).alias("_accepted"))
    return (
        deliveries.join(accepted, "key", "left")
        .withColumn(
            "reason",
            F.when(~good_name, F.lit(BAD_NAME)).when(F.col("_accepted").isNull(), F.lit(DUPLICATE)),
        )
        .drop("_accepted")
    )
