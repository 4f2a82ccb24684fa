import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicktrail.rules import HIT_COLUMNS, Rules
from clicktrail.sinks import outputs
from clicktrail.sinks import files
from clicktrail.streaming import registry
from clicktrail.streaming.intake import Intake
from clicktrail.streaming.registry import Registry
from tests.fixtures import anchor_hits, hit, sale, search, tab_text
from tests.test_sources_and_sinks import put

ANCHORS = {("google.com", "garden hose", 50.5), ("bing.com", "spade", 35.0)}


class Place:
    def __init__(self, spark, root, **kw):
        self.spark, self.root = spark, root
        self.landing, self.out = root / "raw", str(root / "out")
        os.makedirs(self.landing)
        self.kw = kw

    def run(self):
        intake = Intake(self.spark, str(self.landing), self.out, **self.kw)
        intake.start(str(self.root / "ck")).awaitTermination()
        return intake

    def report(self):
        rows = self.spark.read.parquet(f"{self.out}/processed").collect()
        return {(r["domain"], r["keyword"], r["revenue"]) for r in rows}

    def outcomes(self):
        intake = Intake(self.spark, str(self.landing), self.out, **self.kw)
        return {(r["key"], r["outcome"], r["reason"]) for r in intake.registry().collect()}


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_files_are_taken_in_once(spark, place):
    name = "phase1/hits_20260225_143000.tab"
    put(place.landing / name, tab_text(anchor_hits(), "\r\n"))
    put(place.landing / "phase1" / "notes.txt", "x")
    place.run()
    assert place.report() == ANCHORS
    assert os.path.exists(f"{place.out}/archive/{name}") and not os.path.exists(place.landing / name)

    place.run()  # nothing new
    assert place.report() == ANCHORS

    # the same delivery again, in another folder of the same phase
    put(place.landing / "phase1" / "again" / "hits_20260225_143000.tab", tab_text(anchor_hits()))
    place.run()
    assert place.report() == ANCHORS
    assert (("phase1/again/hits_20260225_143000.tab", "rejected", "duplicate")) in place.outcomes()
    rejected = [f for _, _, names in os.walk(f"{place.out}/rejected/phase1") for f in names if f.endswith(".tab")]
    assert rejected == ["hits_20260225_143000.tab"]

    # a new delivery
    put(place.landing / "phase1" / "hits_20260226_143000.tab", tab_text([search(1, "z", "new"), sale(2, "z", 9)]))
    place.run()
    assert place.report() == ANCHORS | {("google.com", "new", 9.0)}
    lineage = spark.read.json(f"{place.out}/lineage")
    assert lineage.where("status = 'SUCCESS'").count() == 2
    assert {(r["input_rows"], r["output_rows"]) for r in lineage.collect()} == {(12, 2), (2, 1)}


def test_each_file_is_attributed_on_its_own(place):
    put(place.landing / "phase1" / "a_20260225_000000.tab", tab_text([search(1, "v", "one"), sale(2, "v", 5)]))
    put(place.landing / "phase1" / "b_20260225_000001.tab", tab_text([search(3, "v", "two"), sale(4, "v", 6)]))
    place.run()
    assert place.report() == {("google.com", "one", 5.0), ("google.com", "two", 6.0)}


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_results_do_not_depend_on_batches(spark, tmp_path, max_files):
    place = Place(spark, tmp_path, **({"max_files": max_files} if max_files else {}))
    for i, day in enumerate(("2026-01-31", "2026-02-04", "2026-02-04")):
        path = put(place.landing / "phase1" / f"f{i}_20260225_00000{i}.tab", tab_text([search(1, "v", f"k{i}"), sale(2, "v", 5 + i)]))
        when = datetime.fromisoformat(f"{day}T12:00:00+00:00").timestamp()
        os.utime(path, (when, when))
    place.run()
    rows = spark.read.parquet(f"{place.out}/processed").select("file_name", "keyword", "revenue", "month", "day").collect()
    assert {tuple(r) for r in rows} == {
        ("f0_20260225_000000.tab", "k0", 5.0, 1, 31),
        ("f1_20260225_000001.tab", "k1", 6.0, 2, 4),
        ("f2_20260225_000002.tab", "k2", 7.0, 2, 4),
    }


def test_every_file_has_a_ranked_report_and_a_quality_report(spark, tmp_path):
    rules = Rules(output_columns=("engine", "term", "income"), sort_ascending=True, filename_pattern="{date}_terms.tab")
    place = Place(spark, tmp_path, rules=rules)
    rows = [search(1, "v", "big"), sale(2, "v", 50), search(1, "w", "small"), sale(2, "w", 5), sale(2, "w", 5)]
    path = put(place.landing / "phase1" / "a_20260225_000000.tab", tab_text(rows))
    os.utime(path, (1772000000, 1772000000))
    place.run()
    name = f"{place.out}/reports/phase=phase1/year=2026/month=02/day=25/file_name=a_20260225_000000.tab/2026-02-25_terms.tab"
    with open(name) as f:
        assert f.read() == "engine\tterm\tincome\ngoogle.com\tsmall\t5.00\ngoogle.com\tbig\t50.00\n"
    (report,) = spark.read.schema(outputs.QUALITY_SCHEMA).json(f"{place.out}/dq-reports").collect()
    assert (report["rows_in"], report["rows_out"], report["error_count"], report["overall_passed"]) == (5, 4, 1, True)
    assert [c["check"] for c in report["checks"]] == ["schema_validation", "null_validation", "duplicate_check"]


@pytest.mark.parametrize("name", ["with space", "with%20code", "with#hash", "with+plus", "wïth äccent", "with[glob]"])
def test_file_names_with_special_characters(place, name):
    key = f"phase1/{name}_20260225_000000.tab"
    put(place.landing / key, tab_text([search(1, "v", "one"), sale(2, "v", 5)]))
    place.run()
    assert place.report() == {("google.com", "one", 5.0)}
    assert place.outcomes() == {(key, "processed", None)} and os.path.exists(f"{place.out}/archive/{key}")


def test_useless_headers_fail_alone(place):
    good = tab_text([search(1, "v", "one"), sale(2, "v", 5)])
    put(place.landing / "phase1" / "ok_20260225_000000.tab", good)
    put(place.landing / "phase1" / "twice_20260225_000000.tab", good.replace("user_agent", "IP", 1))
    put(place.landing / "phase1" / "blank_20260225_000000.tab", good.replace("user_agent", "", 1))
    put(place.landing / "phase1" / "lines_20260225_000000.tab", "\n\n")
    put(place.landing / "phase1" / "bare_20260225_000000.tab", good.split("\n")[0] + "\n")
    for _ in range(2):
        place.run()
    assert place.report() == {("google.com", "one", 5.0)}
    assert {(k.split("/")[1].split("_")[0], o) for k, o, _ in place.outcomes()} == {
        ("ok", "processed"),
        ("bare", "processed"),
        ("twice", "failed"),
        ("blank", "failed"),
        ("lines", "failed"),
    }


def test_repeated_deliveries_are_all_kept(place):
    for folder in ("a", "b", "c"):
        put(place.landing / "phase1" / folder / "h_20260225_000000.tab", tab_text([search(1, folder, folder)]))
    place.run()
    found = [os.path.join(d, f) for d, _, names in os.walk(f"{place.out}/rejected") for f in names if not f.startswith(".")]
    assert sorted(os.path.basename(f) for f in found) == ["h_20260225_000000.tab"] * 2 + ["reason.txt"] * 2
    assert {open(f).read() for f in found if f.endswith(".txt")} == {"duplicate\n"}


def test_bad_files_do_not_stop_good_ones(spark, place):
    good = [search(1, "v", "one"), sale(2, "v", 5), sale(2, "v", 5)]
    put(place.landing / "phase1" / "ok_20260225_000000.tab", tab_text(good))
    put(place.landing / "phase1" / "turned_20260225_000000.tab", tab_text([search(1, "w", "two"), sale(2, "w", 7)], columns=HIT_COLUMNS[::-1]))
    put(place.landing / "phase1" / "short_20260225_000000.tab", tab_text(good, columns=HIT_COLUMNS[:-1]))
    put(place.landing / "phase1" / "nulls_20260225_000000.tab", tab_text(good + [hit(9, "v", referrer="")]))
    put(place.landing / "phase1" / "unnamed.tab", tab_text(good))
    place.run()
    assert place.report() == {("google.com", "one", 5.0), ("google.com", "two", 7.0)}
    assert place.outcomes() == {
        ("phase1/ok_20260225_000000.tab", "processed", None),
        ("phase1/turned_20260225_000000.tab", "processed", None),
        ("phase1/short_20260225_000000.tab", "failed", "schema_error: missing columns ['referrer']"),
        ("phase1/nulls_20260225_000000.tab", "failed", "null_critical_column"),
        ("phase1/unnamed.tab", "rejected", "missing_timestamp_in_filename"),
    }
    assert os.path.exists(place.landing / "phase1" / "nulls_20260225_000000.tab")
    errors = spark.read.options(header=True).csv(f"{place.out}/dq-errors")
    got = {(r["file_name"], r["_error_reason"].split(" key=")[0]) for r in errors.collect()}
    assert got == {
        ("ok_20260225_000000.tab", "duplicate_row:"),
        ("nulls_20260225_000000.tab", "null_critical_column: referrer"),
    }
    status = {r["error"]: r["status"] for r in spark.read.json(f"{place.out}/lineage").collect()}
    assert status["null_critical_column"] == "FAILED" and status[None] == "SUCCESS"


def test_a_batch_repeated_after_a_crash_changes_nothing(spark, place, monkeypatch):
    name = "phase1/hits_20260225_143000.tab"
    put(place.landing / name, tab_text(anchor_hits()))
    intake = Intake(spark, str(place.landing), place.out, move_files=False)
    path = "file:" + str(place.landing / name)
    arrived = spark.createDataFrame([(path, 1772000000)], "path string, delivered long")
    with monkeypatch.context() as m:  # crash after the report, before the files are recorded
        m.setattr(intake, "_record", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            intake.process(arrived, 0)
    assert place.report() == ANCHORS and not os.path.exists(f"{place.out}/registry")
    intake.process(arrived, 0)
    assert place.report() == ANCHORS and spark.read.parquet(f"{place.out}/processed").count() == 2
    intake.move_files = True  # crashed before moving: the files are only moved now
    intake.process(arrived.where(F.lit(False)), 0)
    assert os.path.exists(f"{place.out}/archive/{name}")
    intake.process(arrived.where(F.lit(False)), 0)
    assert place.outcomes() == {(name, "processed", None)}


def test_rules_reach_the_stream(spark, tmp_path):
    place = Place(spark, tmp_path, rules=Rules(enforce_filename_date=False, attribution_model="last_touch"))
    rows = [search(1, "v", "one"), search(2, "v", "two"), sale(3, "v", 5)]
    put(place.landing / "walk.tab", tab_text(rows))
    place.run()
    assert place.report() == {("google.com", "two", 5.0)}
    assert os.path.exists(f"{place.out}/archive/phase2/walk.tab")


def reads_of(registry, monkeypatch):
    """How many folders a lookup asks for."""
    asked, real = [], files.exists
    monkeypatch.setattr(files, "exists", lambda spark, path: asked.append(path) or real(spark, path))
    return asked


def test_registry_knows_all_batches_and_reads_few_folders(spark, tmp_path, monkeypatch):
    known = Registry(spark, str(tmp_path / "r"), str(tmp_path / "i"), fold_every=2, merge=3)
    schema = "phase string, file_name string, outcome string"
    asked, costs = reads_of(known, monkeypatch), []
    for b in range(24):
        rows = [("phase1", f"h{b}_2026{b // 28 + 1:02d}{b % 28 + 1:02d}_000000.tab", "processed"), ("phase1", f"bad{b}.tab", "failed"), ("phase2", f"plain{b}.tab", "processed")]
        del asked[:]
        new = spark.createDataFrame(rows, schema)
        before = known.processed(new, b).collect()
        costs.append(len(asked))
        assert not {(r["phase"], r["file_name"]) for r in before} & {r[:2] for r in rows}
        new.coalesce(1).write.parquet(str(tmp_path / "r" / f"batch_id={b}"))
        known.fold(b)
        known.fold(b)
    everything = spark.createDataFrame([(f"h{b}_2026{b // 28 + 1:02d}{b % 28 + 1:02d}_000000.tab",) for b in range(24)] + [(f"plain{b}.tab",) for b in range(24)], "file_name string")
    got = known.processed(everything, 24).collect()
    assert len(got) == 48 and {r["batch_id"] for r in got} == set(range(24)) and not any("bad" in r["file_name"] for r in got)
    assert {r["batch_id"] for r in known.processed(everything, 7).collect()} == set(range(7))
    assert max(costs[12:]) <= max(costs[:12]) + 8
    assert len([n for n in os.listdir(tmp_path / "i") if n.startswith("run=")]) <= 4


def test_a_fold_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    known = Registry(spark, str(tmp_path / "r"), str(tmp_path / "i"), fold_every=2, merge=2)
    for b in range(4):
        spark.createDataFrame([("p", f"f{b}.tab", "processed")], "phase string, file_name string, outcome string").write.parquet(str(tmp_path / "r" / f"batch_id={b}"))
        with monkeypatch.context() as m:
            m.setattr(files, "replace_text", lambda *_: 1 / 0)
            if b % 2:
                with pytest.raises(ZeroDivisionError):
                    known.fold(b)
        known.fold(b)
    names = spark.createDataFrame([(f"f{b}.tab",) for b in range(4)], "file_name string")
    assert sorted(r["file_name"] for r in known.processed(names, 4).collect()) == [f"f{b}.tab" for b in range(4)]


def test_names_of_old_batches_are_still_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FOLD_EVERY", 2)
    place = Place(spark, tmp_path, max_files=1)
    for i in range(5):
        put(place.landing / "phase1" / f"f{i}_20260225_00000{i}.tab", tab_text([search(1, "v", f"k{i}"), sale(2, "v", 5)]))
    place.run()
    put(place.landing / "phase1" / "again" / "f0_20260225_000000.tab", tab_text([search(1, "v", "k0"), sale(2, "v", 5)]))
    place.run()
    assert ("phase1/again/f0_20260225_000000.tab", "rejected", "duplicate") in place.outcomes() and len(place.outcomes()) == 6
