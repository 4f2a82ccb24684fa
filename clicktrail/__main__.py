"""Command line: ``report``, ``sem`` and ``intake``."""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import replace

from pyspark.sql import functions as F

from clicktrail.functions.paths import phase_label
from clicktrail.plans.batch import Run, run_batch, run_sem
from clicktrail.rules import Rules
from clicktrail.session import build_session
from clicktrail.sinks import archive, outputs
from clicktrail.sources.hits import read_hits
from clicktrail.streaming.intake import Intake


log = logging.getLogger(__name__)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clicktrail", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, text in (
        ("report", "revenue by search keyword, with quality checks"),
        ("sem", "keyword funnel of raw hits"),
        ("intake", "process newly delivered files exactly once"),
    ):
        # The option names are those users' jobs already pass.
        job = jobs.add_parser(name, help=text)
        job.add_argument("--input", required=True, help="where the hits are: one file, a folder, a glob; for intake the landing folder")
        job.add_argument("--output", required=True, help="folder below which everything is written")
        job.add_argument("--config-json", default=None, help="settings that differ from the defaults, as one JSON object")
        job.add_argument("--delimiter", default="\t", help="what separates the columns of a hit file")
        job.add_argument("--local", action="store_true", help="use the cores of this machine as the cluster")
        if name != "intake":
            job.add_argument("--layout", choices=outputs.LAYOUTS, default="single", help="deliver one file, or a folder of sorted parts")
        if name == "report":
            job.add_argument("--phase", default=None, help="phase part of the output path; by default read off the input path")
            job.add_argument("--archive-input", default=None, help="folder that takes the files read, once the report is out")
        if name == "sem":
            job.add_argument("--run-id", default=None, help="fixed id for the run_id column instead of a random one")
        if name == "intake":
            job.add_argument("--checkpoint", required=True, help="stream checkpoint folder")
            job.add_argument("--keep-files", action="store_true", help="do not archive or set aside input files")
    args = parser.parse_args(argv)

    spark = build_session(master="local[*]" if args.local else None)
    rules = Rules.from_json(args.config_json)
    if args.job == "intake":
        intake = Intake(spark, args.input, args.output, rules, move_files=not args.keep_files, delimiter=args.delimiter)
        intake.start(args.checkpoint).awaitTermination()
        return 0
    run = Run(args.input)
    try:
        if args.job == "report" and args.archive_input:
            archive.resume(spark, args.archive_input)  # what an earlier run has reported must not be read again
        hits = read_hits(spark, args.input, rules, args.delimiter)
        if args.job == "report":
            phase = args.phase or spark.range(1).select(phase_label(F.lit(args.input))).first()[0]
            run = replace(run, phase=phase)
            summary = run_batch(spark, hits, args.output, rules, run, args.layout, args.archive_input)
        else:
            run = replace(run, run_id=args.run_id) if args.run_id else run
            summary = run_sem(spark, hits, args.output, rules, run, args.layout)
    except Exception as exc:  # noqa: BLE001
        log.exception("the run failed")
        summary = {"run_id": run.run_id, "status": "FAILED", "input_file": args.input, "error": str(exc).split("\n", 1)[0]}
    print(json.dumps(summary))
    return int(summary["status"] != "SUCCESS")


if __name__ == "__main__":
    raise SystemExit(main())
