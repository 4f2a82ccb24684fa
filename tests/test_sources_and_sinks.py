import csv
import json
import os
import threading
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clicktrail.__main__ import main
from clicktrail.operators.quality import NullValidationError, SchemaValidationError
from clicktrail.operators import dedup, quality
from clicktrail.plans import batch, reports
from clicktrail.plans.batch import Run, run_batch, run_sem
from clicktrail.rules import HIT_COLUMNS, Rules
from clicktrail.session import Staging, shared_dir
from clicktrail.sinks import files, outputs
from clicktrail.sources import manifest
from clicktrail.sources.hits import read_hits
from tests.fixtures import ANCHOR_REPORT, anchor_hits, frame, hit, rows_of, sale, search, tab_text

RULES = Rules()
WHEN = datetime(2026, 2, 25, 14, 30, tzinfo=timezone.utc)
REPORT = "2026-02-25_SearchKeywordPerformance.tab"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def lines(path):
    with open(path, newline="", encoding="utf-8") as f:
        return f.read().split("\n")


def staged_tables(spark):
    folder = shared_dir(spark) + "/clicktrail"
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def json_of(folder):
    (name,) = [n for n in os.listdir(folder) if n.startswith("part-")]
    return json.loads(open(os.path.join(folder, name)).read())


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\r\r\n"])
def test_read_hit_file(spark, tmp_path, line_end):
    rows = anchor_hits()
    rows[0]["user_agent"] = '"Mozilla (KHTML, like Gecko)"'
    path = put(tmp_path / "hits.tab", tab_text(rows, line_end))
    hits = read_hits(spark, path)
    assert hits.columns == [*HIT_COLUMNS, "pos", "source_file"]
    got = hits.orderBy("pos").collect()
    assert [r["hit_time_gmt"] for r in got] == [r["hit_time_gmt"] for r in rows]
    assert got[0]["user_agent"] == '"Mozilla (KHTML, like Gecko)"'
    assert got[0]["event_list"] is None
    assert rows_of(reports.keyword_report(hits)) == ANCHOR_REPORT


def test_file_order_survives_splitting(spark, tmp_path):
    """The first of two touches in the same second wins, wherever the file is cut."""
    rows = [search(5, f"v{i % 50}", f"k{i // 50}") for i in range(500)] + [sale(6, f"v{i}", 1) for i in range(50)]
    path = put(tmp_path / "hits.tab", tab_text(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        hits = read_hits(spark, path)
        assert hits.rdd.getNumPartitions() > 4
        assert rows_of(reports.keyword_report(hits)) == [("google.com", "k0", 50.0)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bytes_that_are_not_text_are_replaced(spark, tmp_path):
    text = tab_text([hit(1, "a", name="caf?")]).encode().replace(b"caf?", b"caf\xff")
    path = tmp_path / "h.tab"
    path.write_bytes(text)
    assert read_hits(spark, str(path)).first()["pagename"] == "caf\ufffd"


def test_short_and_long_rows(spark, tmp_path):
    text = tab_text([hit(1, "a")]) + "2\tonly\n" + "3" + "\tx" * 20 + "\n"
    got = read_hits(spark, put(tmp_path / "h.tab", text)).orderBy("pos").collect()
    assert [r["hit_time_gmt"] for r in got] == ["1", "2", "3"]
    assert got[1]["referrer"] is None and got[2]["referrer"] == "x"


def test_another_column_order_fails_instead_of_shifting(spark, tmp_path):
    put(tmp_path / "in" / "a.tab", tab_text([hit(1, "a")]))
    put(tmp_path / "in" / "b.tab", tab_text([hit(1, "a")], columns=HIT_COLUMNS[::-1]))
    with pytest.raises(Exception, match="(?i)header"):
        read_hits(spark, str(tmp_path / "in")).collect()


def test_batch_run(spark, tmp_path):
    path = put(tmp_path / "raw" / "hits.tab", tab_text(anchor_hits()))
    out, before = str(tmp_path / "out"), staged_tables(spark)
    summary = run_batch(spark, read_hits(spark, path), out, RULES, Run(path, "phase1", "run-12345678", WHEN))
    target = f"{out}/processed/phase1/year=2026/month=02/day=25/source={Run(path).source}/{REPORT}"
    assert {k: summary[k] for k in ("status", "input_rows", "clean_rows", "output_rows", "dq_passed", "output_file")} == {
        "status": "SUCCESS",
        "input_rows": 12,
        "clean_rows": 12,
        "output_rows": 2,
        "dq_passed": True,
        "output_file": target,
    }
    assert lines(target) == [
        "Search Engine Domain\tSearch Keyword\tRevenue",
        "google.com\tgarden hose\t50.50",
        "bing.com\tspade\t35.00",
        "",
    ]
    assert not os.path.exists(target + "_tmp") and not os.path.exists(f"{out}/dq-errors")
    report = json_of(f"{out}/dq-reports/2026/02/25/hits_run-1234_dq_report.json")
    assert report["overall_passed"] and report["rows_in"] == report["rows_out"] == 12 and report["error_count"] == 0
    assert [c["check"] for c in report["checks"]] == ["schema_validation", "null_validation", "duplicate_check"]
    lineage = json_of(f"{out}/lineage/2026-02-25/run-12345678.json")
    assert lineage["status"] == "SUCCESS" and lineage["output_file"] == target and lineage["input_rows"] == 12
    assert staged_tables(spark) == before  # its own are gone


def test_batch_run_with_rejects(spark, tmp_path):
    rows = anchor_hits() + [anchor_hits()[11] | {"pagename": "again"}, hit("", ""), hit("abc", "t")]
    out = str(tmp_path / "out")
    rules = RULES.but(fail_on_null_critical=False, reject_type_errors=True)
    summary = run_batch(spark, frame(spark, rows), out, rules, Run("h.tab", "other", "run-1", WHEN))
    assert (summary["input_rows"], summary["clean_rows"], summary["dq_passed"]) == (15, 12, False)
    stored = spark.read.options(header=True).csv(f"{out}/dq-errors/2026/02/25/h_run-1_errors.csv")
    assert sorted(r["_error_reason"].split(" key=")[0] for r in stored.collect()) == [
        "duplicate_row:",
        "null_critical_column: hit_time_gmt",
        "null_critical_column: ip",
        "type_error: hit_time_gmt",
    ]
    assert "10.7" not in str(stored.select("ip", "user_agent").collect())
    report = json_of(f"{out}/dq-reports/2026/02/25/h_run-1_dq_report.json")
    assert report["error_count"] == 4
    assert lines(summary["output_file"])[1] == "google.com\tgarden hose\t50.50"


def test_fatal_nulls_leave_evidence_and_no_report(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(NullValidationError):
        run_batch(spark, frame(spark, anchor_hits() + [hit(1, "a", referrer="")]), out, RULES, Run("h.tab", "p", "run-1", WHEN))
    assert os.path.exists(f"{out}/dq-errors/2026/02/25/h_run-1_errors.csv") and not os.path.exists(f"{out}/processed")
    lineage = json_of(f"{out}/lineage/2026-02-25/run-1.json")
    assert lineage["status"] == "FAILED" and "critical" in lineage["error"] and lineage["input_rows"] == 13


def test_missing_columns(spark, tmp_path):
    hits = frame(spark, anchor_hits()).drop("geo_city")
    with pytest.raises(SchemaValidationError):
        run_batch(spark, hits, str(tmp_path / "a"), RULES, Run(when=WHEN))
    assert os.path.exists(tmp_path / "a" / "dq-errors")
    summary = run_batch(spark, hits, str(tmp_path / "b"), RULES.but(fail_on_schema_error=False), Run(when=WHEN))
    assert summary["output_rows"] == 2 and not summary["dq_passed"]


@pytest.mark.parametrize("model", ["last_touch", "linear", "time_decay"])
def test_batch_run_with_other_models(spark, tmp_path, model):
    rules = RULES.but(attribution_model=model)
    summary = run_batch(spark, frame(spark, anchor_hits()), str(tmp_path), rules, Run(when=WHEN))
    assert lines(summary["output_file"])[1:3] == ["google.com\tgarden hose\t50.50", "bing.com\tspade\t35.00"]


def test_reports_can_be_sorted_parts(spark, tmp_path):
    rows = [r for i in range(40) for r in (search(1, f"v{i}", f"k{i:02d}"), sale(2, f"v{i}", 100 + i))]
    report = reports.keyword_report(frame(spark, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        target, count = outputs.write_keyword_report(report, str(tmp_path), WHEN, RULES, layout="parts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    version = files.current(spark, target)
    parts = sorted(n for n in os.listdir(version) if n.startswith("part-"))
    got = [l.split("\t")[1] for n in parts for l in lines(f"{version}/{n}")[1:] if l]
    assert count == 40 and len(parts) > 1 and got == [f"k{i:02d}" for i in reversed(range(40))]


def test_sem_report(spark, tmp_path):
    summary = run_sem(spark, frame(spark, anchor_hits()), str(tmp_path), RULES, Run(run_id="r1", when=WHEN))
    assert summary["output_file"] == f"{tmp_path}/processed/sem_insights/year=2026/month=02/day=25/sem_insights_20260225.csv"
    with open(summary["output_file"], newline="") as f:
        got = list(csv.DictReader(f))
    assert [(r["search_keyword"], r["total_revenue"], r["run_id"]) for r in got] == [
        ("garden hose", "50.5", "r1"),
        ("spade", "35.0", "r1"),
        ("bird bath", "0.0", "r1"),
    ]
    nothing = run_sem(spark, frame(spark, [hit(1, "a")]), str(tmp_path / "none"), RULES, Run(when=WHEN))
    assert nothing["output_file"] is None and not os.path.exists(tmp_path / "none")


def test_size_never_decides_the_form_of_a_report(spark, tmp_path):
    rows = [r for i in range(60) for r in (search(1, f"v{i}", f"k{i:02d}"), sale(2, f"v{i}", 100 + i))]
    report = reports.keyword_report(frame(spark, rows, 5))
    for n in (1, 60):
        target, _ = outputs.write_keyword_report(report.limit(n), str(tmp_path / str(n)), WHEN, RULES)
        assert os.path.isfile(target)
    with pytest.raises(ValueError, match="layout"):
        outputs.write_keyword_report(report, str(tmp_path), WHEN, RULES, layout="auto")


def test_runs_of_one_day_keep_their_reports(spark, tmp_path):
    for name, price in (("a", 5), ("b", 7)):
        rows = frame(spark, [search(1, "v", "x"), sale(2, "v", price)])
        run_batch(spark, rows, str(tmp_path), RULES, Run(f"{name}.tab", "phase1", f"run-{name}", WHEN))
    day = tmp_path / "processed" / "phase1" / "year=2026" / "month=02" / "day=25"
    assert [lines(day / f"source={Run(f'{n}.tab').source}" / REPORT)[1] for n in "ab"] == ["google.com\tx\t5.00", "google.com\tx\t7.00"]


def test_equal_names_of_two_folders_keep_their_reports(spark, tmp_path):
    for name, price in (("a", 5), ("b", 7)):
        rows = frame(spark, [search(1, "v", "x"), sale(2, "v", price)])
        run_batch(spark, rows, str(tmp_path), RULES, Run(f"/in/{name}/hits.tab", "phase1", f"run-{name}", WHEN))
    day = tmp_path / "processed" / "phase1" / "year=2026" / "month=02" / "day=25"
    assert len([n for n in os.listdir(day) if n.startswith("source=hits-")]) == 2
    same = {Run(n).source for n in ("/in/a/hits.tab", "file:/in/a/hits.tab", "file:///in//a/./hits.tab")}
    assert len(same) == 1 and Run("/in/b/hits.tab").source not in same


def test_readers_always_see_one_whole_version(spark, tmp_path):
    target = str(tmp_path / "report")
    seen, lost, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                folder = files.current(spark, target)
            except Exception as exc:  # noqa: BLE001
                lost.append(exc)
                return
            if folder:
                texts = [open(f"{folder}/{n}").read() for n in sorted(os.listdir(folder)) if n.startswith("part-")]
                seen.append({line for t in texts for line in t.split("\n")[1:] if line})

    put(tmp_path / "report", "a file of the other layout")
    files.publish_parts(spark.range(100).selectExpr("'v0' AS version", "id"), target, [F.col("id")])
    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 6):
        files.publish_parts(spark.range(100).selectExpr(f"'v{i}' AS version", "id"), target, [F.col("id")])
    stop.set()
    reader.join()
    assert seen and not lost and all(len(rows) == 100 and len({r.split(",")[0] for r in rows}) == 1 for rows in seen)
    assert len([n for n in os.listdir(target) if n.startswith("version=")]) == 2  # the one before stays for its readers


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "UTF-8", "UTF-16LE", "UTF-16BE"])
def test_headers_are_read_as_their_rows_are(spark, tmp_path, encoding):
    names = ["plain", "b\u00fcro", 'with\ttab and "quotes"', "la\u010d" if encoding != "ISO-8859-1" else "lac"]
    quoted = "\t".join('"' + n.replace('"', '""') + '"' if "\t" in n else n for n in names)
    path = tmp_path / "h.tab"
    path.write_bytes(f"{quoted}\r\n1\t2\t3\t4\r\n".encode(encoding))
    assert files.header_names(spark, str(path), "\t", encoding) == tuple(names)


def test_malformed_and_endless_headers(spark, tmp_path, monkeypatch):
    path = tmp_path / "h.tab"
    path.write_bytes(b"\xef\xbb\xbfcaf\xe9 au\tx\n" + b"1\t2\n" * 10)
    assert files.header_names(spark, str(path), "\t") == ("caf\ufffd au", "x")
    path.write_bytes(b"")
    assert files.header_names(spark, str(path), "\t") == ("",)
    monkeypatch.setattr(files, "HEADER_BYTES", 1000)
    path.write_bytes(b"x" * 5000)
    with pytest.raises(ValueError, match="no line end"):
        files.first_line(spark, str(path))


def test_malformed_bytes_stay_in_their_line(spark, tmp_path):
    lines_ = tab_text([hit(i, "v", page=f"p{i}X") for i in range(4)]).encode().split(b"\n")
    bad = [b"\xff", b"\xe9", b"\xc3", b"\xf0\x9f"]
    lines_ = [lines_[0], *(x.replace(b"X", b, 1) for x, b in zip(lines_[1:], bad)), b""]
    path = tmp_path / "bad.tab"
    path.write_bytes(b"\n".join(lines_))
    got = read_hits(spark, str(path)).orderBy("hit_time_gmt").select("page_url").collect()
    assert len(got) == 4 and all("\ufffd" in r["page_url"] for r in got)


def test_output_delimiter_and_encoding_are_rules(spark, tmp_path):
    rules = RULES.but(output_delimiter=";", output_encoding="ISO-8859-1")
    rows = frame(spark, [search(1, "v", "b%C3%BCro"), sale(2, "v", 5)])
    summary = run_batch(spark, rows, str(tmp_path), rules, Run(when=WHEN))
    with open(summary["output_file"], "rb") as f:
        assert f.read().split(b"\n")[1] == b"google.com;b\xfcro;5.00"


def test_a_lost_lineage_record_does_not_break_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outputs, "write_lineage", lambda *_: 1 / 0)
    assert run_batch(spark, frame(spark, anchor_hits()), str(tmp_path), RULES, Run(when=WHEN))["status"] == "SUCCESS"


def test_a_file_takes_the_place_of_a_file(spark, tmp_path):
    new, old = put(tmp_path / "new", "2"), put(tmp_path / "old", "1")
    files.move(spark, new, old)
    assert open(old).read() == "2" and not os.path.exists(new)
    put(tmp_path / "parts" / "part-1", "2")
    put(tmp_path / "target" / "part-0", "1")
    files.move(spark, str(tmp_path / "parts"), str(tmp_path / "target"))
    assert [n for n in os.listdir(tmp_path / "target") if n.startswith("part")] == ["part-1"] and not os.path.exists(tmp_path / "target_old")


def copies_in_files(tmp_path, files_=3, keys=200):
    for f in range(files_):
        rows = [hit(k, "v", page=f"{f}-{k}", name=n) for k in range(keys) for n in ("first", "second")]
        put(tmp_path / "in" / f"h{f}.tab", tab_text(rows))
    return str(tmp_path / "in")


def test_splits_may_change_between_two_scans(spark, tmp_path):
    hits = read_hits(spark, copies_in_files(tmp_path))
    kept, rejected = dedup.keep_first(hits, RULES), dedup.duplicate_rejects(hits, RULES)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert {(r["pagename"], r["count"]) for r in kept.groupBy("pagename").count().collect()} == {("first", 600)}
        assert {(r["pagename"], r["count"]) for r in rejected.groupBy("pagename").count().collect()} == {("second", 600)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rejects_are_found_by_inner_joins(spark, tmp_path):
    frame(spark, anchor_hits()).write.parquet(str(tmp_path / "h"))
    plan = dedup.duplicate_rejects(spark.read.parquet(str(tmp_path / "h")), RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([("x", 1.0)], "keyword string, revenue double")
    for day, keyword in ((1, "a"), (2, "b"), (2, "c")):
        dated = outputs.with_day(df.withColumn("keyword", F.lit(keyword)), WHEN.replace(day=day), "phase1")
        outputs.write_partitioned(dated, out, ["phase", "year", "month", "day"])
    got = {(r["keyword"], r["day"]) for r in spark.read.parquet(out).collect()}
    assert got == {("a", 1), ("c", 2)} and os.path.exists(f"{out}/phase=phase1/year=2026/month=02/day=01")


def test_moves_can_be_repeated(spark, tmp_path):
    a = put(tmp_path / "a" / "f.tab", "x")
    b = str(tmp_path / "b" / "f.tab")
    files.move(spark, a, b)
    files.move(spark, a, b)
    assert open(b).read() == "x"
    with pytest.raises(FileNotFoundError):
        files.move(spark, a, str(tmp_path / "c"))


def test_manifest(spark, tmp_path):
    root = tmp_path / "run" / "raw"  # 'run' above the root is no phase word
    good = ["phase3/h_20260225_143000.tab", "phase3/sub/h_20260225_143000.tab", "phase3/seen_20260225_143000.TAB"]
    for name in good + ["x_walk.tab", "notes.txt"]:
        put(root / name, "x")
    deliveries = manifest.delivery_facts(manifest.list_files(spark, str(root)), str(root))
    registry = spark.createDataFrame([("phase3", "seen_20260225_143000.TAB")], "phase string, file_name string")
    got = {r["key"]: (r["phase"], r["reason"]) for r in manifest.judged(deliveries, registry).collect()}
    assert got == {
        good[0]: ("phase3", None),
        good[1]: ("phase3", "duplicate"),
        good[2]: ("phase3", "duplicate"),
        "x_walk.tab": ("phase2", "missing_timestamp_in_filename"),
    }
    lax = manifest.judged(deliveries, registry, RULES.but(enforce_filename_date=False))
    assert {r["key"] for r in lax.where("reason IS NULL").collect()} == {good[0], "x_walk.tab"}
    fresh = manifest.not_yet_processed(deliveries, registry)
    assert fresh.count() + manifest.already_processed(deliveries, registry).count() == 4


def test_command_line(spark, tmp_path, capsys):
    path = put(tmp_path / "in" / "phase1" / "hits_20260225_143000.tab", tab_text(anchor_hits()))
    assert main(["report", "--input", path, "--output", str(tmp_path / "o")]) == 0
    summary = json.loads(capsys.readouterr().out)
    assert summary["output_rows"] == 2 and "/processed/phase1/" in summary["output_file"]  # read off the path
    config = '{"keyword_normalize_case": false}'
    assert main(["sem", "--input", path, "--output", str(tmp_path / "s"), "--run-id", "r", "--config-json", config]) == 0
    assert json.loads(capsys.readouterr().out)["output_rows"] == 4
    copy = put(tmp_path / "once" / "hits.tab", tab_text(anchor_hits()))
    late = put(tmp_path / "once" / "other.txt", "not read")
    kept = tmp_path / "kept"
    assert main(["report", "--input", str(tmp_path / "once" / "*.tab"), "--output", str(tmp_path / "k"), "--archive-input", str(kept)]) == 0
    assert os.listdir(kept)[-1:] and os.path.exists(kept / "hits.tab") and not os.path.exists(copy) and os.path.exists(late)
    assert json.loads(capsys.readouterr().out)["status"] == "SUCCESS"
    bad = put(tmp_path / "bad" / "phase3" / "short.tab", tab_text(anchor_hits(), columns=HIT_COLUMNS[:-1]))
    assert main(["report", "--input", bad, "--output", str(tmp_path / "b")]) == 1
    assert json.loads(capsys.readouterr().out)["status"] == "FAILED"
    args = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "i"), "--checkpoint", str(tmp_path / "c")]
    assert main(["intake", *args]) == 0
    assert os.path.exists(tmp_path / "i" / "archive" / "phase1" / "hits_20260225_143000.tab")


def test_profile_is_taken_while_hits_are_staged(spark, tmp_path):
    rows = anchor_hits() + [hit("", ""), hit("abc", "t")]
    path = put(tmp_path / "h.tab", tab_text(rows))
    rules = RULES.but(reject_type_errors=True)
    hits = read_hits(spark, path, rules)
    staged, facts = batch.staged_hits(hits, rules, Staging(spark, "seen"))
    assert facts == quality.profile(staged, rules).first().asDict()
    assert (facts["rows_in"], facts["null_failed"], facts["type_errors"]) == (len(rows), 1, 1)
    assert batch.staged_hits(hits.drop("referrer"), rules, Staging(spark, "seen"))[1] is None


def test_a_file_with_a_header_alone_is_a_run_of_no_rows(spark, tmp_path):
    path = put(tmp_path / "h.tab", tab_text([]))
    summary = run_batch(spark, read_hits(spark, path), str(tmp_path / "out"), RULES, Run(path, when=WHEN))
    assert (summary["input_rows"], summary["clean_rows"], summary["status"]) == (0, 0, "SUCCESS")
