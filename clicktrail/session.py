"""Session settings and shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(name: str = "clicktrail", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; sizes are left to the cluster's own settings."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true")
    # Recording the Python call site of every column makes building a plan several times slower.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster.

    Only a local session, where driver and executors are one machine, may
    fall back to a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="clicktrail-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/clicktrail/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: later steps restart from files, not from the raw input."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """A folder of intermediate tables in shared storage; call it to stage a table.

    Plans that read an intermediate result several times use it so that the
    steps before run once and survive lost executors.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.folder = new_path(spark, name)
        self.tables = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return written(df, f"{self.folder}/{self.tables}")


def unstaged(df: DataFrame) -> DataFrame:
    """The default instead of a :class:`Staging`: leave the plan in one piece."""
    return df
