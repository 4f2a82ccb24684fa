"""Similar documents, repeated passages and near vectors against brute force."""

from __future__ import annotations

import hashlib
import random
import time
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clicktrail.llm import components as components_module
from clicktrail.llm import jaccard, passages, vectors
from clicktrail.llm.components import components, forest

WORDS = [f"w{i}" for i in range(400)]


def plain_components(ids, linked):
    roots = dict(forest(*zip(*linked, strict=True))) if linked else {}
    return {i: roots.get(i, i) for i in ids}


def shingles(text, n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def changed(text, rng, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    rng = random.Random(11)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "one"), (5, "one two"), (6, "É é"), (7, "é É")]
    for base in range(12):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([4, 9, 30, 120, 400])))
        rows += [(100 * (base + 1) + k, changed(text, rng, rng.randrange(0, 6)) if k else text.upper()) for k in range(14)]
    rows += [(9000, "a " * 20_000), (9001, "a " * 19_000)]
    return rows


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 90, 1 << 22), (5, 80, 1 << 22), (5, 80, 300), (2, 60, 1 << 22)])
def test_similar_documents_equal_brute_force(documents, family, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    sets = {i: shingles(t, n) for i, t in family}
    linked = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and x and y and 100 * len(x & y) >= percent * len(x | y)]
    want = plain_components(sets, linked)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(documents(family), n, percent).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_similar_documents_on_odd_rows(documents):
    text = "a b c d e f g"
    rows = [(None, text), (None, text), (5, text), (3, text), (3, "x y z x y q r"), (3, text)]
    got = sorted((str(r.doc_id), r.component_id) for r in jaccard.similar_documents(documents(rows)).collect())
    assert got == [("3", 3)] * 3 + [("5", 3)] + [("None", None)] * 2
    assert sorted((r.doc_id, r.text) for r in jaccard.one_of_each(documents(rows)).collect()) == [(3, text), (3, "x y z x y q r")]
    assert jaccard.similar_documents(documents(rows).where("false")).count() == 0


def test_one_python_worker_runs_in_a_task(documents, family, monkeypatch):
    plans, real = [], jaccard.components

    def seen(links, *names):
        plans.append(links._jdf.queryExecution().executedPlan().toString().split("Exchange")[0])
        return real(links, *names)

    monkeypatch.setattr(jaccard, "components", seen)
    assert jaccard.similar_documents(documents(family)).count() == len(family)
    assert len(plans) == 3 and not any("MapInArrow" in plan for plan in plans)  # components puts one of its own on top


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (3, 90)])
def test_a_common_passage_makes_no_cell(documents, monkeypatch, n, percent):
    rng = random.Random(21)
    prose = lambda k: " ".join(f"{rng.choice(WORDS)}{rng.randrange(1000)}" for _ in range(k))
    passage = prose(100)
    rows = [(i, f"{prose(150)} {passage} {prose(rng.randrange(150, 260))}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " one more") for i in range(0, 60, 6)]
    rows += [rows[3]] * 40  # copies of a row change no order
    cells, real = [], jaccard.components

    def seen(links, *names):
        if not cells:
            cells.extend(sorted((r.first, r.node) for r in links.collect()))
        return real(links, *names)

    monkeypatch.setattr(jaccard, "components", seen)
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(documents(rows), n, percent).collect()}
    assert got == {i: i % 100 for i, _ in rows}
    assert cells == [(i, 100 + i) for i in range(0, 60, 6)]


def test_a_set_keeps_a_segment_of_each_similar_one():
    """Whichever order all sets share: of two similar sets, one equal segment at least is left out by neither."""
    rng = np.random.default_rng(8)
    shingles = lambda k: rng.integers(0, 2**63, k).astype(np.uint64)
    for n in [2, 5, 6, 9, 30, 31, 100, 333, 1000]:
        for percent in (70, 80, 90):
            base = shingles(n)
            for new in range(n * (100 - percent) // percent + 1):
                less = rng.integers(0, new + 1)
                sets = [np.unique(base), np.unique(np.concatenate((base[less:], shingles(new - less))))]
                if not jaccard.similar(*sets, percent):
                    continue
                kept = []
                for s in sets:
                    for part, keys in jaccard.segment_keys(s, percent):
                        left = part // 2
                        kept.append(set(np.sort(keys)[left:].tolist()))
                assert any(a & b for i, a in enumerate(kept) for b in kept[i + 1 :])


def test_one_of_equal_rows_stays(documents):
    text = "a b c d e f g"
    assert jaccard.one_of_each(documents([(4, text)] * 4 + [(None, text)] * 3)).count() == 1
    assert [r.doc_id for r in jaccard.one_of_each(documents([(None, text)] * 5 + [(None, text.upper())])).collect()] == [None]
    rows = [(1, ""), (1, ""), (2, ""), (2, None), (None, ""), (None, None), (7, text), (7, text + " h"), (8, text), (None, "p q r s t u")]
    got = Counter((r.doc_id, r.text or "") for r in jaccard.one_of_each(documents(rows)).collect())
    assert got == {(1, ""): 1, (2, ""): 1, (None, ""): 1, (7, text): 1, (7, text + " h"): 1, (None, "p q r s t u"): 1}
    out = jaccard.one_of_each(documents(rows))
    assert out.columns == documents(rows).columns


def test_trees_find_links_of_large_cells():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = {i: np.unique(np.concatenate((rng.choice(base, 285, replace=False), rng.integers(0, 2**63, 5).astype(np.uint64)))) for i in range(60)}
    sets |= {100 + i: np.unique(rng.integers(0, 2**63, 50 + i).astype(np.uint64)) for i in range(40)}
    linked = [(a, b) for a, x in sets.items() for b, y in sets.items() if a < b and jaccard.similar(x, y, 90)]
    want = plain_components(sets, linked)
    rows = [(i, len(s), jaccard.bitmap(s), s) for i, s in sets.items()]
    assert plain_components(want, jaccard.join_trees(rows, None, 90)) == want
    cross = [(a, b) for a, b in linked if (a % 2) != (b % 2)]
    halves = [[s for s in rows if s[0] % 2 == k] for k in (0, 1)]
    assert plain_components(want, jaccard.join_trees(*halves, 90)) == plain_components(want, cross)
    # Bitmaps alone connect at least as much, and leave unlike sets alone.
    loose = plain_components(want, jaccard.join_trees([(*r[:3], None) for r in rows], None, 90))
    assert all(loose[a] == loose[b] for a, b in linked) and all(loose[i] == i for i in range(100, 140))


def plain_repeats(rows, window):
    seen, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        cut = set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if seen.setdefault(w, i) < i:
                cut.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in cut)
        out[i] = (len(words), len(cut), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [50, 20])
def test_repeated_passages_equal_brute_force(documents, window, monkeypatch):
    monkeypatch.setattr(passages, "INDEX_WORDS", 2000)
    rng = random.Random(window)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    shared = [prose(n) for n in (window - 1, window, window + 1, 70, 130)]
    rows = [(0, None), (1, ""), (2, prose(window - 1)), (3, "x " * 400), (4, "x " * 300), (5, "x " * 400)]
    for i in range(10, 130):
        parts = [prose(rng.randrange(0, 90)) for _ in range(3)] + rng.sample(shared, rng.randrange(0, 3))
        rng.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    rows += [(200 + k, rows[20 + k][1]) for k in range(20)] + [(300 + k, changed(rows[30 + k][1], rng, 2)) for k in range(20)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.remove_repeats(documents(rows), window).collect()}
    assert got == plain_repeats(rows, window)


def test_common_passages_are_one_segment(documents):
    rng = random.Random(1)
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(80)) + " " + passage + " " + " ".join(f"v{i}x{k}" for k in range(80))) for i in range(300)]
    docs = documents(rows)
    assert len(passages.common_grams(docs)) == 60 - passages.GRAM + 1
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passages.remove_repeats(docs).collect()}
    assert got == plain_repeats(rows, 50)


def test_repeated_rows_take_linear_time(documents):
    text = " ".join([" ".join(f"p{k}w{j}" for j in range(60)) for k in range(20)])
    took = []
    for n in (1_000, 10_000):
        rows = [(1, text.replace("w5 ", "v5 ") + " " + text)] + [(2, text)] * n + [(3, text + " tail")]
        start = time.monotonic()
        got = Counter((r.doc_id, r.n_removed) for r in passages.remove_repeats(documents(rows), keep_text=False).collect())
        took.append(time.monotonic() - start)
        assert got == {(1, 0): 1, (2, 1200): n, (3, 1200): 1}
    assert took[1] < 12 * took[0] + 5


def test_a_very_long_text(documents):
    words = [f"v{k * 7919 % 90001}" for k in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[50_000:100_000]) + " and an end of its own"), (3, " ".join(words[:49]))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in passages.remove_repeats(documents(rows)).collect()}
    assert got[1][:2] == (150_000, 0) and got[2] == (50_006, 50_000, "and an end of its own") and got[3][1] == 0


def test_repeats_on_odd_rows(documents):
    text = " ".join(f"t{k}" for k in range(60))
    rows = [(None, text), (4, text), (4, text), (4, text + " more"), (9, text), (None, text)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in passages.remove_repeats(documents(rows)).collect())
    assert got == sorted([("None", 60, 0, text)] * 2 + [("4", 60, 0, text)] * 2 + [("4", 61, 0, text + " more"), ("9", 60, 60, "")])
    assert passages.remove_repeats(documents(rows).where("false")).count() == 0


def plain_vectors(rows):
    fine = {}
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            u = np.array(v, np.float32).astype(float)
            u /= np.abs(u).max()
            fine[k] = (i, u / np.linalg.norm(u), label)
    links = [(a, b) for a, x in fine.items() for b, y in fine.items() if a != b and x[2] == y[2] and len(x[1]) == len(y[1]) and x[1] @ y[1] >= 0.98]
    n = [sum(a == k for a, _ in links) for k in range(len(rows))]
    linked = [(rows[a][0], rows[b][0]) for a, b in links if rows[a][0] != rows[b][0]]
    group = plain_components({r[0] for r in rows}, linked)
    return sorted((str(r[0]), n[k], group[r[0]], r[0] is not None and group[r[0]] == r[0]) for k, r in enumerate(rows))


@pytest.mark.parametrize(("shard", "block"), [(4096, 65_536), (64, 65_536), (64, 50)])
def test_near_vectors_equal_brute_force(vectors_table, monkeypatch, shard, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rng = np.random.default_rng(9)
    rows, centre = [], rng.normal(size=(12, 16))
    for i in range(240):
        v = centre[i % 12] + rng.normal(size=16) * 0.12 if i % 3 == 0 else rng.normal(size=16)
        rows.append((i, v.tolist(), int(i % 2)))
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 0), (0, rows[0][1], 0), (502, rows[0][1], 1), (503, rows[0][1], None), (None, rows[0][1], 0)]
    rows += [(504, None, 0), (505, [], 0), (506, [0.0] * 16, 0), (507, [None] + [1.0] * 15, 0), (508, [float("nan")] * 16, 0)]
    rows += [(509, [float("inf")] + [1.0] * 15, 0), (510, [1e-30] * 16, 0), (511, [1e30] * 16, 0), (512, [1.0, 2.0], 0), (513, [1.0, 2.0], 0)]
    got = vectors.near_vectors(vectors_table(rows), shard_rows=shard).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == plain_vectors(rows)


def test_the_audit_sees_vectors_beside_a_hot_group(monkeypatch):
    rng = np.random.default_rng(4)
    units = rng.normal(size=(1200, 16))
    units[::3] = units[0] + rng.normal(size=(400, 16)) * 1e-3
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    units[2] = units[1] + 0.01 * units[4]
    units[2] /= np.linalg.norm(units[2])
    hot = np.arange(0, 1200, 3)
    monkeypatch.setattr(vectors.Graph, "within", lambda self, q, least, width: hot)  # blind to all but the hot group
    shard = vectors.Shard(units)
    for k in (0, 1, 2, 5):
        assert shard.links(units[k]).tolist() == np.flatnonzero(units @ units[k] >= vectors.COSINE).tolist()


def test_a_third_of_equal_vectors(vectors_table):
    rng = np.random.default_rng(12)
    pairs = rng.normal(size=(100, 16))
    hot = rng.normal(size=16)
    rows = [(i, (hot if i % 3 == 0 else pairs[i % 100] + rng.normal(size=16) * 0.02).tolist(), 0) for i in range(450)]
    rows += [(1000, (hot + 0.02 * pairs[0]).tolist(), 0), (1000, rows[1][1], 0), (0, rows[2][1], 1), (2, rows[2][1], 1)]
    got = vectors.near_vectors(vectors_table(rows)).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == plain_vectors(rows)


def test_vectors_of_several_lengths_in_a_batch(vectors_table):
    rng = np.random.default_rng(6)
    rows = [(100 * d + i, (np.arange(1, d + 1) + rng.normal(size=d) * 0.3).tolist(), 0) for d in (2, 3, 5, 16) for i in range(20)]
    table = vectors_table(rows)
    part = lambda d, query: [{"task": d, "query": query, "row": d + i, "vec_id": d + i, "n_equal": 1, "unit": [1.0] + [0.0] * (d - 1)} for i in (0, 1)]
    batch = pa.RecordBatch.from_pylist([r for d in (2, 16) for query in (False, True) for r in part(d, query)])
    found = [r for b in vectors._search(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    assert sorted((r["row"], r["n"]) for r in found if r["row"] is not None) == [(2, 1), (3, 1), (16, 1), (17, 1)]
    got = vectors.near_vectors(table).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == plain_vectors(rows)


def test_no_vectors(vectors_table):
    table = vectors_table([(1, [1.0], 0)])
    assert vectors.near_vectors(table.where("false")).count() == 0
    assert vectors.near_vectors(table.withColumnRenamed("row", "unit")).first()[:3] == (1, 0, 1)


@pytest.mark.parametrize("one_task", [200_000, 20])
def test_components_of_long_paths_and_stars(spark, monkeypatch, one_task):
    monkeypatch.setattr(components_module, "ONE_TASK", one_task)
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (7, None)]
    random.Random(2).shuffle(links)
    table = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(table).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
