"""Incremental intake: every delivered hit file is processed exactly once.

Each file is checked, deduplicated and attributed on its own, and dated by its
own delivery, so no result depends on which files met in a micro-batch.

The stream is a stream of *files*, not of rows: a micro-batch lists the newly
arrived files (contents unread), decides which to take, and runs one batch
plan over all of those, attributing each file on its own.  Everything a batch
writes is addressed by its batch id or by the files in it, so a batch that is
repeated after a failure replaces what it wrote before.
"""

from __future__ import annotations

import hashlib
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktrail.functions.paths import file_name, phase_label
from clicktrail.functions.text import is_blank
from clicktrail.operators.quality import data_columns, error_rows, has_null_critical, is_valid, masked_errors
from clicktrail.plans.batch import commit_id, not_fatal, repeated_in, staged_activity
from clicktrail.plans.models import credit, keyword_revenue
from clicktrail.plans.reports import named_report, report_as_text, shared_session_count
from clicktrail.rules import Rules
from clicktrail.session import Staging
from clicktrail.sinks import files, outputs
from clicktrail.sources.hits import literal_path, positioned, reader, with_stored_positions
from clicktrail.sources.manifest import delivery_facts, judged, relative_key
from clicktrail.streaming.registry import Registry

log = logging.getLogger(__name__)

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ENTRY_COLUMNS = ("path", "key", "file_name", "phase", "delivered", "outcome", "reason")
ENTRY_SCHEMA = "path string, key string, file_name string, phase string, delivered long, outcome string, reason string"
FILE_KEY = ("phase", "file_name")
DAY = ("year", "month", "day")
# A micro-batch never holds more files than this, which bounds every per-file
# list the driver handles.  It bounds work only; results are per file.
MAX_FILES = 1000


def delivered_at(entry: dict) -> datetime:
    return datetime.fromtimestamp(entry["delivered"], timezone.utc)


class Intake:
    """Settings of one intake: where files land, where results go, and the rules."""

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        out: str,
        rules: Rules = Rules(),
        *,
        move_files: bool = True,
        max_files: int = MAX_FILES,
        delimiter: str = "\t",
    ):
        self.spark, self.rules, self.delimiter = spark, rules, delimiter
        self.landing, self.out = landing.rstrip("/"), out.rstrip("/")
        self.move_files, self.max_files = move_files, max_files
        self.known = Registry(spark, f"{self.out}/registry", f"{self.out}/registry_index")

    def start(self, checkpoint: str, **trigger) -> StreamingQuery:
        """Start the stream; by default it takes in what is there and stops."""
        arrived = (
            self.spark.readStream.format("binaryFile")
            .schema(FILE_SCHEMA)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.[tT][aA][bB]")
            .option("maxFilesPerTrigger", self.max_files)
            .load(self.landing)
            .select("path", F.unix_timestamp("modificationTime").alias("delivered"))
        )
        return (
            arrived.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def process(self, arrived: DataFrame, batch_id: int) -> None:
        """One micro-batch: report, record, move, and the lineage last; a recorded batch is only moved again."""
        entries = self._recorded(batch_id)
        facts: dict = {}
        if entries is None:
            entries = self._judge(arrived, batch_id)
            facts = self._report(entries, batch_id)
            self._record(entries, batch_id)
        if self.move_files:
            self._move(entries, batch_id)
        if facts:
            with not_fatal("lineage"):
                self._write_lineage(entries, facts, batch_id)

    # -- what was taken in before --------------------------------------------

    def registry(self) -> DataFrame:
        """Every file ever judged, with its outcome and batch."""
        path = f"{self.out}/registry"
        schema = f"{ENTRY_SCHEMA}, batch_id long"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _recorded(self, batch_id: int) -> list[dict] | None:
        path = f"{self.out}/registry/batch_id={batch_id}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return [r.asDict() for r in self.spark.read.schema(ENTRY_SCHEMA).parquet(path).collect()]  # <= max_files

    def _record(self, entries: list[dict], batch_id: int) -> None:
        rows = [tuple(e[c] for c in ENTRY_COLUMNS) for e in entries]
        table = self.spark.createDataFrame(rows, ENTRY_SCHEMA).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.out}/registry/batch_id={batch_id}")
        with not_fatal("index of the registry"):
            self.known.fold(batch_id)

    # -- which files to take ---------------------------------------------------

    def _judge(self, arrived: DataFrame, batch_id: int) -> list[dict]:
        deliveries = delivery_facts(arrived, self.landing)
        verdicts = judged(deliveries, self.known.processed(deliveries, batch_id), self.rules)
        entries = [r.asDict() for r in verdicts.select("path", "key", "file_name", "phase", "delivered", "reason").collect()]
        for e in entries:  # <= max_files
            e["outcome"] = "rejected" if e["reason"] else "processed"
        return sorted(entries, key=lambda e: e["key"])

    def _header(self, path: str) -> tuple[str, ...]:
        return files.header_names(self.spark, path, self.delimiter, self.rules.file_encoding)

    def _unusable(self, header: tuple[str, ...]) -> str | None:
        """Why no table can be read under a header, whatever the rules allow."""
        lowered = [name.strip().lower() for name in header]
        if not all(lowered):
            return "schema_error: header with an empty column name"
        if len(set(lowered)) < len(lowered):
            return "schema_error: header repeats a column name"
        missing = sorted(set(self.rules.required_columns) - set(header))
        if missing and self.rules.fail_on_schema_error:
            return f"schema_error: missing columns {missing}"
        return None

    def _open(self, entries: list[dict]) -> DataFrame | None:
        """Hits of all files to process.  Files with the same header share a scan; files whose
        header is of no use are failed here."""
        by_header: dict[tuple[str, ...], list[str]] = {}
        for e in entries:
            if e["outcome"] != "processed":
                continue
            header = self._header(e["path"])
            reason = self._unusable(header)
            if reason:
                e |= {"outcome": "failed", "reason": reason}
            else:
                by_header.setdefault(header, []).append(literal_path(e["path"]))
        hits = None
        for header, paths in by_header.items():
            quoted = [name.replace("`", "``") for name in header]
            schema = ", ".join(f"`{name}` string" for name in quoted)
            raw = reader(self.spark, self.delimiter, self.rules.file_encoding).schema(schema)
            part = positioned(raw.option("enforceSchema", False).csv(paths), self.rules)
            absent = set(self.rules.required_columns) - set(header)
            part = part.withColumns({c: F.lit(None).cast("string") for c in sorted(absent)}) if absent else part
            hits = part if hits is None else hits.unionByName(part, allowMissingColumns=True)
        if hits is None:
            return None
        key = relative_key(F.col("source_file"), self.landing)
        return hits.withColumns({"phase": phase_label(key), "file_name": file_name(key)})

    # -- what a batch writes ---------------------------------------------------

    def _profile(self, hits: DataFrame) -> dict[tuple[str, str], dict]:
        """Counts of every file; one row each."""
        rules = self.rules
        columns = [c for c in data_columns(hits) if c not in FILE_KEY]
        profile = hits.groupBy(*FILE_KEY).agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(has_null_critical(rules, hits.columns)).alias("null_failed"),
            F.count_if(~is_valid(rules, hits.columns)).alias("rows_failed"),
            F.array(*[F.count_if(is_blank(F.col(f"`{c}`"))) for c in columns]).alias("blanks"),
        )
        return {(r["phase"], r["file_name"]): r.asDict() | {"columns": columns} for r in profile.collect()}

    def _report(self, entries: list[dict], batch_id: int) -> dict[tuple[str, str], dict]:
        """Everything but registry, lineage and moves; returns the facts of every file that was opened."""
        hits = self._open(entries)
        if hits is None:
            facts: dict = {}
        else:
            stage = Staging(self.spark, "intake")
            try:
                hits = with_stored_positions(hits, stage)
                facts = self._report_hits(hits, entries, stage, batch_id)
            finally:
                files.delete(self.spark, stage.folder)
        opened = [e for e in entries if e["outcome"] != "rejected"]
        for e in opened:
            facts.setdefault((e["phase"], e["file_name"]), {"rows_in": 0, "null_failed": 0, "rows_failed": 0, "blanks": [], "columns": []})
        with not_fatal("quality reports"):
            self._write_quality(opened, facts, batch_id)
        return facts

    def _report_hits(self, hits: DataFrame, entries: list[dict], stage: Staging, batch_id: int) -> dict:
        rules, scope = self.rules, list(FILE_KEY)
        facts = self._profile(hits)
        for e in entries:
            if e["outcome"] != "processed":
                continue
            seen = facts.get((e["phase"], e["file_name"]))
            if seen is None and files.has_data(self.spark, e["path"], rules.file_encoding):
                e |= {"outcome": "failed", "reason": "rows_not_found"}
            elif seen and seen["null_failed"] and rules.fail_on_null_critical:
                e |= {"outcome": "failed", "reason": "null_critical_column"}
        taken = {(e["phase"], e["file_name"]) for e in entries if e["outcome"] == "processed"}
        names = [f"{phase}/{name}" for phase, name in sorted(taken)]
        good = hits.where(F.concat_ws("/", *FILE_KEY).isin(names))

        act, clean = staged_activity(good, rules, f"{stage.folder}/activity", scope)
        for r in self._write_revenue(act, stage, entries):
            facts[r["phase"], r["file_name"]]["rows_reported"] = r["count"]
        for r in clean.groupBy(*scope).count().collect():  # one row per file
            facts[r["phase"], r["file_name"]]["rows_out"] = r["count"]
        expected = sum(facts[k]["rows_in"] - facts[k]["rows_failed"] for k in taken if k in facts)
        kept = sum(facts[k].get("rows_out", 0) for k in taken if k in facts)
        if expected != kept or any(f["rows_failed"] for f in facts.values()):
            with not_fatal("rejected rows"):
                self._write_errors(hits, repeated_in(clean), stage, entries, batch_id)
        with not_fatal("warning of shared session keys"):
            for r in shared_session_count(good, rules, scope).collect():  # one row per file
                log.warning("%s/%s: %d session keys with several user agents", r["phase"], r["file_name"], r["count"])
        return facts

    def _dated(self, df: DataFrame, entries: list[dict]) -> DataFrame:
        """Each file's own delivery day, as partition columns."""
        rows = [(e["phase"], e["file_name"], *f"{delivered_at(e):%Y-%m-%d}".split("-")) for e in entries if e["outcome"] != "rejected"]
        days = self.spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*FILE_KEY, *DAY)))  # <= max_files
        return df.join(F.broadcast(days), list(FILE_KEY))

    def _write_revenue(self, act: DataFrame, stage: Staging, entries: list[dict]) -> list:
        """Write each file's revenue as a table and as the ranked report people read; returns rows per file."""
        rules, scope = self.rules, list(FILE_KEY)
        revenue = stage(self._dated(keyword_revenue(credit(act, rules, scope, stage=stage), rules, scope), entries))
        partitions = ["phase", *DAY, "file_name"]
        rank = [F.col("revenue").asc() if rules.sort_ascending else F.col("revenue").desc(), "domain", "keyword"]
        ranked = revenue.repartition(*partitions).sortWithinPartitions(*partitions, *rank)
        table = ranked.withColumn("revenue", F.col("revenue").cast("double"))
        outputs.write_partitioned(table, f"{self.out}/processed", partitions)
        counts = revenue.groupBy(*scope, *DAY).count().collect()  # one row per file
        if counts:
            text = report_as_text(named_report(ranked, rules, partitions, ordered=False), rules)
            options = {"sep": rules.output_delimiter, "encoding": rules.output_encoding, "header": True, "emptyValue": ""}
            outputs.write_partitioned(text, f"{self.out}/reports", partitions, "csv", **options)
            self._name_reports(counts)
        return counts

    def _name_reports(self, counts: list) -> None:
        """A file's report has one part, since its rows were brought together; it gets the configured name."""
        for r in counts:
            day = datetime(*(int(r[c]) for c in DAY))
            folder = outputs.partition_path(f"{self.out}/reports", {c: r[c] for c in ("phase", *DAY, "file_name")})
            for part in files.part_files(self.spark, folder):
                files.move(self.spark, part, f"{folder}/{outputs.report_file_name(self.rules, day)}")

    def _write_errors(self, hits: DataFrame, repeated: DataFrame, stage: Staging, entries: list[dict], batch_id: int) -> None:
        """Rejects of all files; keys hold the file, so only files that were taken have repeated ones."""
        errors = error_rows(hits, self.rules, FILE_KEY, stage, repeated)
        flat = masked_errors(errors, self.rules).drop("pos", "source_file")
        dated = self._dated(flat, entries).withColumn("batch_id", F.lit(batch_id))
        outputs.write_partitioned(dated, f"{self.out}/dq-errors", [*DAY, "batch_id"], "csv", header=True)

    def _write_quality(self, opened: list[dict], facts: dict, batch_id: int) -> None:
        """One quality report per file."""
        rules, reports = self.rules, []
        for e in opened:
            seen = facts[e["phase"], e["file_name"]]
            rows_in, failed = seen["rows_in"], seen["rows_failed"]
            schema_ok = not (e["reason"] or "").startswith("schema_error")
            rates = {c: round(n * 100 / rows_in, 2) for c, n in zip(seen["columns"], seen["blanks"]) if rows_in}
            limit = rules.null_warning_threshold_pct
            warnings = {c: pct for c, pct in rates.items() if pct > limit and c not in rules.critical_columns}
            for c, pct in warnings.items():
                log.warning("%s/%s: column %s is blank in %s%% of %d rows", e["phase"], e["file_name"], c, pct, rows_in)
            checks = [{"check": "schema_validation", "passed": schema_ok, "actual_columns": seen["columns"]}]
            if schema_ok:
                nulls = seen["null_failed"]
                checks.append(
                    {"check": "null_validation", "passed": not nulls, "critical_failures": nulls, "total_rows": rows_in, "warnings": warnings}
                )
            done = e["outcome"] == "processed"
            if done:
                before, after = rows_in - failed, seen.get("rows_out", 0)
                checks.append(
                    {"check": "duplicate_check", "passed": True, "duplicate_count": before - after, "rows_before": before, "rows_after": after}
                )
            reports.append(
                {
                    "run_id": self._run_id(e, batch_id),
                    "execution_date": delivered_at(e).isoformat(),
                    "input_file": e["path"],
                    "overall_passed": done and not failed and all(c["passed"] for c in checks),
                    "rows_in": rows_in,
                    "rows_out": seen.get("rows_out", 0) if done else 0,
                    "error_count": failed + (rows_in - failed - seen.get("rows_out", 0) if done else 0),
                    "checks": checks,
                }
            )
        self._write_records(reports, outputs.QUALITY_SCHEMA, "dq-reports", batch_id)

    def _write_records(self, records: list[dict], schema, folder: str, batch_id: int) -> None:
        """JSON records of this batch's files, by each record's day."""
        rows = [tuple(r.get(c) for c in schema.names) for r in records]
        table = self.spark.createDataFrame(rows, schema).coalesce(1)
        dated = table.withColumns({"date": F.substring("execution_date", 1, 10), "batch_id": F.lit(batch_id)})
        outputs.write_partitioned(dated, f"{self.out}/{folder}", ["date", "batch_id"], "json")

    @staticmethod
    def _run_id(e: dict, batch_id: int) -> str:
        return f"{batch_id}-{e['phase']}-{e['file_name']}"

    def _write_lineage(self, entries: list[dict], facts: dict, batch_id: int) -> None:
        """One record per file, after everything else has happened."""
        records = []
        for e in entries:
            if e["outcome"] == "rejected":
                continue
            seen = facts[e["phase"], e["file_name"]]
            done = e["outcome"] == "processed"
            records.append(
                {
                    "run_id": self._run_id(e, batch_id),
                    "execution_date": delivered_at(e).isoformat(),
                    "input_file": e["path"],
                    "input_rows": seen["rows_in"],
                    "output_file": f"{self.out}/processed" if done else "",
                    "output_rows": seen.get("rows_reported", 0) if done else 0,
                    "engine_used": "pyspark",
                    "dq_passed": bool(done and not seen["rows_failed"]),
                    "git_commit": commit_id(),
                    "attribution_model": self.rules.attribution_model,
                    "status": "SUCCESS" if done else "FAILED",
                    "error": e["reason"],
                }
            )
        self._write_records(records, outputs.LINEAGE_SCHEMA, "lineage", batch_id)

    def _move(self, entries: list[dict], batch_id: int) -> None:
        """Archive what was processed, set aside what was rejected with the reason, leave failures where they are."""
        for e in entries:
            if e["outcome"] == "processed":
                files.move(self.spark, e["path"], f"{self.out}/archive/{e['phase']}/{e['file_name']}")
            elif e["outcome"] == "rejected":
                # Repeated deliveries share name, phase and often the day; their key tells them apart.
                own = f"{batch_id}-{hashlib.sha256(e['key'].encode()).hexdigest()[:12]}"
                folder = f"{outputs.day_folder(f'{self.out}/rejected', delivered_at(e), e['phase'])}/{own}"
                files.move(self.spark, e["path"], f"{folder}/{e['file_name']}")
                files.write_text(self.spark, f"{folder}/reason.txt", f"{e['reason']}\n")
