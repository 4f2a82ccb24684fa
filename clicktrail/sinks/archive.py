"""Moving input files away so that none is ever lost or replaced.

All moves of a run are first written down as a table: every source with a target of its own.  Then the files are
renamed, never over another file.  A run that dies between two renames leaves its plan behind, and whoever comes
next finishes it; a plan that is carried out stays as the record of what went where.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clicktrail.sinks import files

PLAN_SCHEMA = "source string, target string, length long, modified long"


def _plans(archive: str, state: str) -> str:
    return f"{archive.rstrip('/')}/_moves/{state}"


def below_common_folder(paths: Sequence[str]) -> list[str]:
    """Each path below the deepest folder that holds them all."""
    folders = [p.split("/")[:-1] for p in paths]
    depth = 0
    for names in zip(*folders):
        if len(set(names)) > 1:
            break
        depth += 1
    return ["/".join(p.split("/")[depth:]) for p in paths]


def write_plan(spark: SparkSession, sources: Sequence[str], archive: str, name: str) -> str:
    """The moves of ``sources``, kept below their common folder; a target that is taken gets a digest of the file in its name."""
    if files.exists(spark, f"{_plans(archive, 'done')}/{name}"):  # a run that goes by the name of an earlier one
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    path, rows, taken = f"{_plans(archive, 'pending')}/{name}", [], set()
    for source, key in zip(sources, below_common_folder(sources)):
        length, modified = files.facts(spark, source)
        target = f"{archive.rstrip('/')}/{key}"
        if target in taken or files.exists(spark, target):
            digest = hashlib.sha256(f"{source}\n{length}\n{modified}".encode()).hexdigest()[:12]
            stem, ending = posixpath.splitext(target)
            target = f"{stem}.{digest}{ending}"
        taken.add(target)
        rows.append((source, target, length, modified))
    spark.createDataFrame(rows, PLAN_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def carry_out(spark: SparkSession, plan: str) -> None:
    """Rename what has not been renamed yet; safe to repeat at any point."""
    for r in spark.read.schema(PLAN_SCHEMA).parquet(plan).collect():  # as many as files were read
        here, there = files.exists(spark, r["source"]), files.exists(spark, r["target"])
        if here and not there:
            files.move_new(spark, r["source"], r["target"])
        elif here and files.facts(spark, r["source"]) == (r["length"], r["modified"]):
            raise FileExistsError(f"{r['target']} is taken, {r['source']} stays where it is")
        elif not there:
            raise FileNotFoundError(f"neither {r['source']} nor {r['target']} is there")
        # Else the file was moved before; another one that has its name by now was not read by this run.
    files.move_new(spark, plan, plan.replace("/_moves/pending/", "/_moves/done/"))


def resume(spark: SparkSession, archive: str) -> int:
    """Finish the plans that earlier runs left; returns how many."""
    plans = files.children(spark, _plans(archive, "pending"))
    for plan in plans:
        if files.exists(spark, f"{plan}/_SUCCESS"):
            carry_out(spark, plan)
        else:  # died while writing it, so nothing has moved
            files.delete(spark, plan)
    return len(plans)


def archive_files(spark: SparkSession, sources: Sequence[str], archive: str, name: str) -> None:
    if sources:
        carry_out(spark, write_plan(spark, sources, archive, name))


def archived(spark: SparkSession, archive: str) -> DataFrame:
    """Every move ever planned."""
    found = [f"{_plans(archive, s)}" for s in ("done", "pending") if files.exists(spark, _plans(archive, s))]
    if not found:
        return spark.createDataFrame([], PLAN_SCHEMA)
    return spark.read.schema(PLAN_SCHEMA).option("recursiveFileLookup", True).parquet(*found)
