"""One run over a set of hits: check, clean, attribute, publish, record.

Text files are parsed once, into a staged table that stores each row's
position; the quality profile is taken while it is written.  That table is
read by one pass that deduplicates, notes which keys are repeated and stages
the few columns attribution needs, by a count over two columns (shared session
keys), and - only when there is something to reject - by the pass that finds
and writes all rejects.

Counts come from aggregates, from the written tables and from what was observed
in the write of the staged table, whose tasks count once each however often
they run; never from accumulators on shuffle stages.
"""

from __future__ import annotations

import hashlib
import logging
import os
import posixpath
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clicktrail.operators.activity import parsed, relevant
from clicktrail.operators.dedup import dedup_key, first_of_each
from clicktrail.operators.quality import (
    NullValidationError,
    SchemaValidationError,
    check_schema,
    data_columns,
    error_rows,
    is_valid,
    missing_columns,
    profile,
    profile_counts,
    row_rejects,
    schema_rejects,
)
from clicktrail.plans.reports import report_of, sem_insights, shared_session_count
from clicktrail.rules import Rules
from clicktrail.session import Staging
from clicktrail.sinks import archive as archives
from clicktrail.sinks import files, outputs
from clicktrail.sources.hits import has_stored_positions

log = logging.getLogger(__name__)


@contextmanager
def not_fatal(what: str) -> Iterator[None]:
    """A run goes on when evidence about it cannot be stored."""
    try:
        yield
    except Exception as exc:  # noqa: BLE001
        log.warning("could not store the %s: %s", what, str(exc).split("\n", 1)[0])


def commit_id() -> str:
    """Which version of the code runs, as the deployment says."""
    return os.environ.get("GIT_COMMIT", "local")


@dataclass(frozen=True)
class Run:
    """What identifies a run; fixed up front so that a repeat writes the same places."""

    input_name: str = ""
    phase: str = "other"
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    when: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def stem(self) -> str:
        return self.input_name.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0] or "hits"

    @property
    def source(self) -> str:
        """The stem and a digest of the whole input name, so that equal names of two folders differ; the same for every run."""
        name = self.input_name.removeprefix("file://").removeprefix("file:")
        scheme, sep, path = name.rpartition("://")
        canonical = f"{scheme}{sep}{posixpath.normpath(path)}" if path else ""
        return f"{self.stem}-{hashlib.sha256(canonical.encode()).hexdigest()[:8]}"


def with_missing(hits: DataFrame, rules: Rules) -> DataFrame:
    """Absent required columns as all NULL, for rules that let such files pass the schema check."""
    missing = missing_columns(hits, rules)
    return hits.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else hits


def clean_activity(hits: DataFrame, rules: Rules, scope: Sequence[str] = ()) -> DataFrame:
    """Parsed first copies of all valid hits, one row per key, and what makes the key a repeated one.

    Parsing happens before the shuffle, so only keys and parsed values move.
    The scope is part of the key: files attributed on their own are also
    deduplicated on their own.
    """
    valid = hits.where(is_valid(rules, hits.columns))
    keys = dedup_key(valid, rules)
    names = [f"_key_{c}" for c in rules.dedup_key_columns if c in hits.columns]
    carried = [*scope, *names]
    rows = parsed(valid.withColumns(dict(zip(names, keys))), rules, carried)
    return first_of_each(rows, carried, scope)


def staged_activity(hits: DataFrame, rules: Rules, path: str, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Write clean hits once; return their activity and a table to count them by.

    Hits that are neither touch nor purchase only matter as a number.  They are
    written as rows of NULLs in a partition of their own: next to nothing on
    disk, never read for reports, and exact to count however tasks were retried.
    """
    clean = clean_activity(hits, rules, scope)
    # Materialise the decision first: the columns it depends on are blanked by it.
    tagged = clean.withColumn("_relevant", F.coalesce(F.col("domain").isNotNull() | F.col("is_purchase"), F.lit(False)))
    kept = tagged.select(
        *scope,
        *[F.when(F.col("_relevant"), F.col(c)).alias(c) for c in clean.columns if c not in (*scope, "_repeated")],
        "_repeated",
        "_relevant",
    )
    kept.write.partitionBy("_relevant").parquet(path)
    table = hits.sparkSession.read.schema(kept.schema).parquet(path)
    return relevant(table.where("_relevant").drop("_relevant", "_repeated")), table


def repeated_in(staged: DataFrame) -> DataFrame:
    """The repeated keys that :func:`staged_activity` noted."""
    return staged.where(F.col("_repeated").isNotNull()).select("_repeated.*")


def staged_hits(hits: DataFrame, rules: Rules, stage: Staging) -> tuple[DataFrame, dict | None]:
    """Hits whose positions hold for every later scan, and their profile if it could be taken on the way.

    It cannot for hits that need no staging or lack columns.
    """
    if has_stored_positions(hits):
        return hits, None
    if missing_columns(hits, rules):
        return stage(hits), None
    seen = Observation("profile")
    staged = stage(hits.observe(seen, *profile_counts(hits, rules)))
    return staged, seen.get


def run_batch(
    spark: SparkSession,
    hits: DataFrame,
    out: str,
    rules: Rules = Rules(),
    run: Run | None = None,
    layout: str = "single",
    archive: str | None = None,
) -> dict:
    """Run the keyword report over ``hits`` and write everything below ``out``.

    Returns the run summary.  A failed check raises after its evidence (rejects,
    quality report, lineage) is stored.  With ``archive``, exactly the files that
    were read move there once the report is out, below their common folder and never over
    another file.  Callers finish what an earlier run left (``sinks.archive.resume``) before they list the files.
    """
    run = run or Run()
    out = out.rstrip("/")
    started = time.monotonic()
    lineage = {
        "run_id": run.run_id,
        "execution_date": run.when.isoformat(),
        "input_file": run.input_name,
        "input_rows": 0,
        "output_file": "",
        "output_rows": 0,
        "engine_used": "pyspark",
        "dq_passed": False,
        "git_commit": commit_id(),
        "attribution_model": rules.attribution_model,
    }
    stage = Staging(spark, "run")
    try:
        read = hits.inputFiles() if archive else []
        staged, facts = staged_hits(hits, rules, stage)
        summary = _checked_run(spark, staged, facts, out, rules, run, stage, lineage, layout)
        if archive:
            archives.archive_files(spark, [unquote(path) for path in read], archive, run.run_id)
        lineage["status"] = "SUCCESS"
        return summary | {"duration_seconds": lineage.setdefault("duration_seconds", round(time.monotonic() - started, 2))}
    except Exception as exc:
        lineage |= {"status": "FAILED", "error": str(exc).split("\n", 1)[0]}
        raise
    finally:
        lineage.setdefault("duration_seconds", round(time.monotonic() - started, 2))
        # Last of all, so the record tells what really happened; a run stands without it.
        with not_fatal("lineage"):
            outputs.write_lineage(spark, lineage, f"{out}/lineage")
        with not_fatal("removal of staging tables"):
            files.delete(spark, stage.folder)


def _checked_run(
    spark: SparkSession,
    hits: DataFrame,
    facts: dict | None,
    out: str,
    rules: Rules,
    run: Run,
    stage: Staging,
    lineage: dict,
    layout: str,
) -> dict:
    report = {
        "run_id": run.run_id,
        "execution_date": run.when.isoformat(),
        "input_file": run.input_name,
        "overall_passed": False,
        "rows_in": 0,
        "rows_out": 0,
        "error_count": 0,
        "checks": [],
    }

    def store_quality() -> None:
        report["overall_passed"] = all(c["passed"] for c in report["checks"])
        lineage["dq_passed"] = report["overall_passed"]
        with not_fatal("quality report"):
            outputs.write_quality_report(spark, report, f"{out}/dq-reports", run.when, run.stem)

    def store_errors(errors: DataFrame) -> None:
        with not_fatal("rejected rows"):
            outputs.write_errors(errors, f"{out}/dq-errors", run.when, run.stem, run.run_id, rules)

    schema = check_schema(hits, rules)
    report["checks"].append(schema)
    if not schema["passed"] and rules.fail_on_schema_error:
        rows = hits.count()
        report |= {"rows_in": rows, "error_count": rows}
        lineage["input_rows"] = rows
        store_errors(schema_rejects(hits, rules))
        store_quality()
        raise SchemaValidationError(f"missing columns {schema['missing']}")

    hits = with_missing(hits, rules)
    facts = facts or profile(hits, rules).first().asDict()
    rows_in, failed = facts["rows_in"], facts["rows_failed"]
    lineage["input_rows"] = rows_in
    rates = {
        c: round(facts[f"blank_{c}"] * 100 / rows_in, 2)
        for c in data_columns(hits)
        if rows_in and c not in rules.critical_columns
    }
    report["rows_in"] = rows_in
    report["checks"].append(
        {
            "check": "null_validation",
            "passed": facts["null_failed"] == 0,
            "critical_failures": facts["null_failed"],
            "total_rows": rows_in,
            "warnings": {c: pct for c, pct in rates.items() if pct > rules.null_warning_threshold_pct},
        }
    )
    for c, pct in report["checks"][-1]["warnings"].items():
        log.warning("column %s is blank in %s%% of %d rows", c, pct, rows_in)
    reasons = sum(facts.get(f"blank_{c}", 0) for c in rules.critical_columns)
    if rules.reject_type_errors:
        report["checks"].append(
            {
                "check": "type_validation",
                "passed": facts["type_failed"] == 0,
                "type_failures": facts["type_failed"],
                "total_rows": rows_in,
            }
        )
        reasons += facts["type_errors"]
    if facts["null_failed"] and rules.fail_on_null_critical:
        report["error_count"] = reasons
        store_errors(row_rejects(hits, rules))
        store_quality()
        raise NullValidationError(
            f"{facts['null_failed']} row(s) have no value in critical columns {list(rules.critical_columns)}"
        )

    act, clean = staged_activity(hits, rules, f"{stage.folder}/activity")
    rows_out = clean.count()
    before = rows_in - failed
    duplicates = before - rows_out
    report["checks"].append(
        {"check": "duplicate_check", "passed": True, "duplicate_count": duplicates, "rows_before": before, "rows_after": rows_out}
    )
    report |= {"rows_out": rows_out, "error_count": reasons + duplicates}
    if failed or duplicates:
        store_errors(error_rows(hits, rules, stage=stage, repeated=repeated_in(clean)))

    with not_fatal("warning of shared session keys"):
        for shared in shared_session_count(hits.where(is_valid(rules, hits.columns)), rules).collect():  # one row
            if shared["count"]:
                log.warning("%d session keys are used with several user agents", shared["count"])
    # Runs of one day over different inputs keep their own reports.
    target = f"{outputs.day_folder(f'{out}/processed', run.when, run.phase)}/source={run.source}"
    output_file, output_rows = outputs.write_keyword_report(report_of(act, rules, stage=stage), target, run.when, rules, layout)
    store_quality()
    lineage |= {"output_file": output_file, "output_rows": output_rows}
    return {
        "run_id": run.run_id,
        "status": "SUCCESS",
        "input_file": run.input_name,
        "output_file": output_file,
        "input_rows": rows_in,
        "clean_rows": rows_out,
        "output_rows": output_rows,
        "dq_passed": report["overall_passed"],
        "engine": "pyspark",
    }


def run_sem(
    spark: SparkSession, hits: DataFrame, out: str, rules: Rules = Rules(), run: Run | None = None, layout: str = "single"
) -> dict:
    """Write the keyword funnel of raw hits (no checks, no deduplication)."""
    run = run or Run()
    report = sem_insights(hits, rules, f"{run.when:%Y-%m-%d %H:%M:%S} UTC", run.run_id)
    path, rows = outputs.write_sem_report(report, f"{out.rstrip('/')}/processed", run.when, layout)
    return {"run_id": run.run_id, "status": "SUCCESS", "output_file": path, "output_rows": rows}
