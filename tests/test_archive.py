"""Archived inputs: nothing is replaced, and a run that dies between two moves is finished by the next."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from clicktrail import catalog
from clicktrail.__main__ import main
from clicktrail.plans.batch import Run, run_batch
from clicktrail.rules import Rules
from clicktrail.sinks import archive, files
from clicktrail.sources.hits import read_hits
from tests.fixtures import anchor_hits, sale, search, tab_text

RULES = Rules()


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def found(folder):
    names = (os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs)
    return {n: open(f"{folder}/{n}").read() for n in names if not n.startswith(("_moves", ".")) and "/." not in n}


def visits(name, price):
    return tab_text([search(1, name, name), sale(2, name, price)])


def test_equal_names_of_two_folders(spark, tmp_path):
    texts = {f"{n}/hits.tab": visits(n, p) for n, p in (("a", 5), ("b", 7))}
    for name, text in texts.items():
        put(tmp_path / "in" / name, text)
    pattern = str(tmp_path / "in" / "*" / "hits.tab")
    assert main(["report", "--input", pattern, "--output", str(tmp_path / "o"), "--archive-input", str(tmp_path / "kept")]) == 0
    assert found(tmp_path / "kept") == texts and found(tmp_path / "in") == {}
    moves = archive.archived(spark, str(tmp_path / "kept")).collect()
    assert {os.path.relpath(r["target"].removeprefix("file:"), tmp_path / "kept") for r in moves} == set(texts)


def test_a_name_that_is_taken_is_not_replaced(spark, tmp_path):
    for i in range(3):  # one name, delivered again and again
        path = put(tmp_path / "in" / "hits.tab", visits(f"v{i}", 5 + i))
        run_batch(spark, read_hits(spark, path), str(tmp_path / "o"), RULES, Run(path, run_id="always-the-same"), archive=str(tmp_path / "kept"))
    kept = found(tmp_path / "kept")
    assert set(kept.values()) == {visits(f"v{i}", 5 + i) for i in range(3)} and "hits.tab" in kept


@pytest.mark.parametrize("survived", [0, 1, 2])
def test_a_run_killed_between_two_moves(spark, tmp_path, monkeypatch, survived):
    texts = {f"{n}/hits.tab": visits(n, 5) for n in "abc"}
    for name, text in texts.items():
        put(tmp_path / "in" / name, text)
    kept, real, moves = str(tmp_path / "kept"), files.move_new, []

    def dying(spark, source, target):
        if len(moves) == survived:
            raise RuntimeError("killed")
        moves.append(target)
        real(spark, source, target)

    pattern = str(tmp_path / "in" / "*" / "hits.tab")
    with monkeypatch.context() as m:
        m.setattr(files, "move_new", dying)
        with pytest.raises(RuntimeError):
            run_batch(spark, read_hits(spark, pattern), str(tmp_path / "o"), RULES, Run(pattern), archive=kept)
    assert {**found(tmp_path / "in"), **found(kept)} == texts and len(found(kept)) == survived
    again = put(tmp_path / "in" / "a" / "hits.tab", visits("new", 9)) if survived else None  # redelivered meanwhile
    assert archive.resume(spark, kept) == 1 and archive.resume(spark, kept) == 0
    assert found(kept) == texts and found(tmp_path / "in") == ({"a/hits.tab": visits("new", 9)} if again else {})


def test_conflicts_and_losses_are_told(spark, tmp_path):
    source, kept = put(tmp_path / "in" / "x.tab", "1"), str(tmp_path / "kept")
    plan = archive.write_plan(spark, [source], kept, "one")
    put(tmp_path / "kept" / "x.tab", "somebody else's")
    with pytest.raises(FileExistsError):
        archive.carry_out(spark, plan)
    assert found(kept) == {"x.tab": "somebody else's"} and os.path.exists(source)
    os.unlink(source)
    os.unlink(f"{kept}/x.tab")
    with pytest.raises(FileNotFoundError):
        archive.resume(spark, kept)


def test_a_half_written_plan_moves_nothing(spark, tmp_path):
    source, kept = put(tmp_path / "in" / "x.tab", "1"), str(tmp_path / "kept")
    plan = archive.write_plan(spark, [source], kept, "one")
    os.unlink(f"{plan}/_SUCCESS")
    archive.resume(spark, kept)
    assert os.path.exists(source) and not os.path.exists(plan)


def test_files_keep_their_place_below_the_common_folder():
    below = archive.below_common_folder
    assert below(["/a/b/x.tab"]) == ["x.tab"] and below(["/a/b/x.tab", "/a/c/x.tab"]) == ["b/x.tab", "c/x.tab"]
    assert below(["/a/x.tab", "/a/b/x.tab", "/a/b/c/y.tab"]) == ["x.tab", "b/x.tab", "b/c/y.tab"] and below([]) == []


def test_an_ordinary_run_leaves_no_plan(spark, tmp_path):
    path = put(tmp_path / "in" / "hits.tab", tab_text(anchor_hits()))
    run_batch(spark, read_hits(spark, path), str(tmp_path / "o"), RULES, Run(path), archive=str(tmp_path / "kept"))
    assert files.children(spark, str(tmp_path / "kept" / "_moves" / "pending")) == [] and set(found(tmp_path / "kept")) == {"hits.tab"}


@pytest.mark.parametrize("users", [400, 1, 0])
def test_every_task_writes_its_part_of_a_half(spark, tmp_path, monkeypatch, users):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(i, datetime(2024, 1, 31, 12, 0, i % 60), i, "view", 1.0, '{"k": 3}') for i in range(users)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    moved, real = [], archive.archive_files
    monkeypatch.setattr(archive, "archive_files", lambda spark, sources, *rest: moved.extend(sources) or real(spark, sources, *rest))
    got = {r.archived: r.row_count for r in catalog.archived_inputs(spark, str(tmp_path)).collect()}
    halves = {f"half{i}/hits.tab": len(range(i, users, 2)) for i in (0, 1)}
    assert got == {name: n for name, n in halves.items() if n}
    assert len(moved) == (8 if users == 400 else 2) and {os.path.basename(path) for path in moved} == {"hits.tab"}
