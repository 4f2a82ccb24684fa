"""Which files an intake has processed, looked up by the names that arrive.

Every micro-batch records its files in a table of its own.  From time to time the latest of these are folded into
a run: their keys, in buckets by the date in the file name.  A run that has enough neighbours of its size is merged
with them, so there are few runs however many batches there were, and a lookup reads the buckets of the
arriving names only.  A manifest that is replaced in one step names the runs; what it does not name does not count.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.sinks import files

KEY_SCHEMA = "phase string, file_name string, batch_id long"
#: Batches in a run, and runs of equal size that become one.
FOLD_EVERY = 16
MERGE = 8
PLAIN_BUCKETS = 256  # of names without a date


def bucket(name: Column) -> Column:
    """The date in a file name, or for names without one a number from their hash."""
    day = F.regexp_extract(name, r"(\d{8})", 1)
    return F.when(day != "", day).otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64(name), F.lit(PLAIN_BUCKETS)).cast("string")))


class Registry:
    def __init__(self, spark: SparkSession, batches: str, index: str, fold_every: int | None = None, merge: int | None = None):
        self.spark, self.batches, self.index = spark, batches.rstrip("/"), index.rstrip("/")
        self.fold_every, self.merge = fold_every or FOLD_EVERY, merge or MERGE

    def _runs(self) -> list[list[int]]:
        """First and last batch of each run, in order; they have no gaps."""
        path = f"{self.index}/_MANIFEST"
        return json.loads(files.read_text(self.spark, path))["runs"] if files.exists(self.spark, path) else []

    def _folder(self, run: Sequence[int]) -> str:
        return f"{self.index}/run={run[0]}-{run[1]}"

    def _batch_keys(self, first: int, last: int) -> DataFrame | None:
        """Processed files of a range of batches; the folders are asked for by name, so no other is listed."""
        paths = [p for b in range(first, last + 1) if files.exists(self.spark, p := f"{self.batches}/batch_id={b}")]
        if not paths:
            return None
        table = self.spark.read.schema(f"phase string, file_name string, outcome string, {KEY_SCHEMA.rsplit(', ', 1)[1]}")
        table = table.option("basePath", self.batches).parquet(*paths)
        return table.where("outcome = 'processed'").select("phase", "file_name", "batch_id")

    def processed(self, names: DataFrame, before: int) -> DataFrame:
        """phase, file_name, batch_id of the files processed before a batch, of all whose bucket ``names`` (file_name) has."""
        runs = self._runs()
        found = self._batch_keys(runs[-1][1] + 1 if runs else 0, before - 1)
        buckets = [r[0] for r in names.select(bucket(F.col("file_name"))).distinct().collect()] if runs else []  # <= names of a batch
        paths = [p for run in runs for b in buckets if files.exists(self.spark, p := f"{self._folder(run)}/bucket={b}")]
        if paths:
            old = self.spark.read.schema(KEY_SCHEMA).parquet(*paths).where(F.col("batch_id") < before)
            found = old if found is None else found.union(old)
        return self.spark.createDataFrame([], KEY_SCHEMA) if found is None else found

    def _write(self, keys: DataFrame, run: Sequence[int]) -> None:
        table = keys.withColumn("bucket", bucket(F.col("file_name"))).repartition("bucket")
        table.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(run))

    def fold(self, last: int) -> None:
        """Once enough batches were recorded, up to ``last``, they become a run; safe to repeat."""
        runs = self._runs()
        first = runs[-1][1] + 1 if runs else 0
        if last - first + 1 < self.fold_every:
            return
        keys = self._batch_keys(first, last)
        new = [first, last]
        self._write(self.spark.createDataFrame([], KEY_SCHEMA) if keys is None else keys, new)
        gone = []
        runs.append(new)
        size = lambda r: r[1] - r[0] + 1
        while len(runs) >= self.merge and len({size(r) for r in runs[-self.merge :]}) == 1:
            parts = runs[-self.merge :]
            whole = [parts[0][0], parts[-1][1]]
            folders = [self._folder(r) for r in parts]
            self._write(self.spark.read.schema(KEY_SCHEMA).option("recursiveFileLookup", True).parquet(*folders), whole)
            gone += folders
            runs[-self.merge :] = [whole]
        files.replace_text(self.spark, f"{self.index}/_MANIFEST", json.dumps({"runs": runs}))
        for folder in gone:
            files.delete(self.spark, folder)
