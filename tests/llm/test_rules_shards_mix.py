"""Quality rules, shards and mixing on odd rows; the SQL check covers the ordinary ones."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest

from clicktrail.llm import jaccard, mixing, quality_rules, sharding

PROSE = " ".join(f"word{i} of text{i * 7 % 31} and" for i in range(30))


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


ODD = [None, "", " \n\t ", "one", "a b", "a b c a b c", "\x0bx\x0by\x0cz", "é🙂 ß\n\né🙂 ß", "# * | <>&\n# * | <>&", "a " * 3000, PROSE, PROSE, "u v w x"]


def test_counts_equal_a_plain_version(documents):
    rows = quality_rules.apply_rules(documents(list(enumerate(ODD)))).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        want = plain_counts(ODD[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_frequent_lines_go_and_depleted_documents_too(documents):
    line = "Subscribe to our  letter and read " + " ".join(f"b{i}" for i in range(60))
    docs = [(i, f"{line.upper() if i % 2 else line}\n" + " ".join(f"d{i}w{k}" for k in range(100)), "h") for i in range(6)]
    docs += [(10, line + "\n" + " ".join(f"only{k}" for k in range(9)), "h"), (11, line + "\nother here", "elsewhere"), (12, None, None)]
    kept = {r.doc_id: r for r in quality_rules.apply_rules(documents(docs)).collect()}
    assert all(kept[i].kept and kept[i].n_boilerplate_words == 66 for i in range(6))
    assert not kept[10].kept and not kept[10].base_failed
    assert kept[11].kept and kept[11].n_boilerplate_words == 0
    clean = {r.doc_id: r for r in quality_rules.clean_documents(documents(docs)).collect()}
    assert set(clean) == {0, 1, 2, 3, 4, 5, 11}
    assert clean[3].text == " ".join(f"d3w{k}" for k in range(100)) and clean[3].n_chars == len(clean[3].text)


def test_copies_of_a_text_are_one_document_of_a_host(documents):
    docs = [(i, PROSE, "h") for i in range(40)]
    assert all(r.kept for r in quality_rules.apply_rules(documents(docs)).collect())


def near_copies_of_lines(n):
    """Texts of ten lines of 12 words, each with one word of its own, in any of the lines."""
    shared = [" ".join(f"g{j}w{k}" for k in range(12)) for j in range(10)]
    return ["\n".join(f"{x} own{i}" if j == i % 10 else x for j, x in enumerate(shared)) for i in range(n)]


@pytest.mark.parametrize("n", [10, 40])
def test_near_copies_count_once(documents, n):
    template = "Read our letter and " + " ".join(f"b{i}" for i in range(20))
    docs = [(i, t, "h") for i, t in enumerate(near_copies_of_lines(n))] + [(None, near_copies_of_lines(1)[0], "h"), (0, None, "h")]
    docs += [(100 + i, template + "\n" + " ".join(f"d{i}w{k}" for k in range(100)), "h") for i in range(6)]
    clean = {r.doc_id: r.text for r in quality_rules.clean_documents(documents(docs)).collect()}
    assert all(clean.get(i) == t for i, t, _ in docs[: n + 1])
    assert all(clean[100 + i] == " ".join(f"d{i}w{k}" for k in range(100)) for i in range(6))
    assert [r.doc_id for r in jaccard.one_of_each(quality_rules.clean_documents(documents(docs))).collect() if r.doc_id is not None and r.doc_id < 100] == [0]


def test_many_documents_make_boilerplate_on_a_large_host(documents):
    docs = [(i, ("All rights reserved here\n" if i < 60 else "") + " ".join(f"d{i}w{k}" for k in range(52)), "h") for i in range(3100)]
    clean = {r.doc_id: r.text for r in quality_rules.clean_documents(documents(docs)).collect()}
    assert clean == {i: " ".join(f"d{i}w{k}" for k in range(52)) for i in range(3100)}


def templates(n):
    """Texts that share ten of eleven lines; the other one is their own."""
    shared = [" ".join(f"t{j}w{k}" for k in range(12)) for j in range(10)]
    return ["\n".join([*shared[: i % 11], " ".join(f"own{i}w{k}" for k in range(12)), *shared[i % 11 :]]) for i in range(n)]


def plain_law(rows):
    """doc_id -> words in lines that enough documents of the host have, near copies counted as one; by loops over all."""
    lines = {}
    for i, text, host in rows:
        lines[host, text or ""] = [ws for x in (text or "").split("\n") if (ws := re.findall(r"[^\x20\x09-\x0D]+", x.lower()))]
    out = {}
    for host in {h for _, _, h in rows}:
        texts = {t: ls for (h, t), ls in lines.items() if h == host}
        users = {}
        for t, ls in texts.items():
            for ws in ls:
                users.setdefault(tuple(ws), set()).add(t)
        enough = lambda n, all=len(texts): n >= 5 and (100 * n >= 2 * all or n >= 50)
        users = {w: ts for w, ts in users.items() if enough(len(ts))}
        held = set().union(*users.values()) if users else set()
        anchors = lambda ws: {tuple(ws[k : k + 3]) for k in (0, 3, len(ws) - 6, len(ws) - 3)}
        count = Counter(a for t in held for a in {a for ws in texts[t] if len(ws) >= 6 for a in anchors(ws)})
        least = {t: min((max(count[a] for a in anchors(ws)) for ws in texts[t] if len(ws) >= 6), default=10**9) for t in held}
        often = set()
        for w, ts in users.items():
            alone = sum(2 * least[t] < len(ts) for t in ts)
            if enough(alone + (alone < len(ts))):
                often.add(w)
        for i, t, h in rows:
            if h == host:
                out.setdefault(i, []).append(sum(len(ws) for ws in texts[t or ""] if tuple(ws) in often))
    return {i: sorted(n) for i, n in out.items()}


def test_near_copies_stay_and_templates_go(documents):
    rows = [(i, t, "copies") for i, t in enumerate(near_copies_of_lines(10))]
    rows += [(100 + i, t, "templates") for i, t in enumerate(templates(60))]
    rows += [(200 + i, t, "both") for i, t in enumerate(near_copies_of_lines(30) + templates(60))]
    rows += [(400 + i, "Terms of use apply to all pages\n" + PROSE + f" and {i}", None) for i in range(7)] + [(500, None, "copies"), (501, "one", None)]
    got = {}
    for r in quality_rules.apply_rules(documents(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {i: [r.n_boilerplate_words for r in rs] for i, rs in got.items()} == plain_law(rows)
    kept = {i for i, rs in got.items() if rs[0].kept}
    assert kept == {*range(10), *range(200, 230), *range(400, 407)}
    assert {r.doc_id for r in quality_rules.clean_documents(documents(rows)).collect()} == kept


def test_very_long_texts(documents):
    text = "\n".join(" ".join(f"l{i}w{k * k % 977}" for k in range(40)) for i in range(4_000))
    rows = [(1, text), (2, None), (3, "short"), (4, text + "\nand one more line of six words")]
    got = {r.doc_id: r for r in quality_rules.apply_rules(documents(rows)).collect()}
    assert got[1].n_words == 160_000 and got[1].kept and got[4].kept and not got[2].kept
    assert {r.doc_id for r in quality_rules.clean_documents(documents(rows)).collect()} == {1, 4}
    shards = {r.doc_id: r for r in sharding.assign_shards(documents(rows), 4).collect()}
    assert shards[1].size == len(text) + 1 and shards[2].size == 1
    mixed = mixing.mix_sources(documents(rows)).where("doc_id = 1").collect()
    assert all(r.text == text for r in mixed)


def test_empty_tables(documents):
    empty = documents([(1, "x")]).where("false")
    assert quality_rules.apply_rules(empty).count() == 0
    assert quality_rules.clean_documents(empty).count() == 0
    assert sharding.assign_shards(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0


@pytest.mark.parametrize("n", [1, 3, 500])
def test_shards_are_contiguous_and_balanced(documents, n):
    rows = [(i, "x" * (i * 37 % 90)) for i in range(n)] + [(None, "é"), (None, None), (n // 2, "again"), (7, "y" * 5000)]
    got = sharding.assign_shards(documents(rows), 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    target, largest = sum(r.size for r in got) / 4, max(r.size for r in got)
    by = {s: [r for r in got if r.shard == s] for s in range(4)}
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
        assert abs(sum(r.size for r in shard) - target) <= largest
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_written_shards_hold_every_row(documents, spark, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(60)])
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60 and back.select("shard").distinct().count() == 3


def test_mixing_reaches_the_weights(documents):
    docs = documents([(i, f"text number {i:05d}", "a" if i % 4 else "b") for i in range(4000)] + [(i, "null source", None) for i in range(300)])
    mixed = mixing.mix_sources(docs, weights={"a": 1.0, "b": 3.0})
    sizes = Counter()
    for r in mixed.select("source", "text").collect():
        sizes[r.source] += len(r.text) + 1
    assert set(sizes) == {"a", "b"}
    assert 2.7 < sizes["b"] / sizes["a"] < 3.3
    again = mixing.mix_sources(docs.repartition(3), weights={"a": 1.0, "b": 3.0})
    key = lambda df: sorted((r.doc_id, r.copy) for r in df.select("doc_id", "copy").collect())
    assert key(mixed) == key(again)


def test_sources_without_a_weight_keep_their_name(documents):
    docs = documents([(1, "aa", "a"), (2, "bb", "b"), (3, "cc", None)])
    rates = {r.source: r for r in mixing.repetition_rates(docs, weights={"a": 1.0}).collect()}
    assert set(rates) == {"a", "b", None} and rates["b"].rate == 0 and rates["b"].cdf is None and rates["a"].rate == 3


def test_large_rates_draw_from_the_middle_of_the_distribution(documents):
    docs = documents([(i, "x", "tiny") for i in range(40)] + [(1000 + i, "y" * 4000, "big") for i in range(100)])
    row = mixing.repetition_rates(docs, weights={"tiny": 1.0, "big": 1.0}).where("source = 'tiny'").first()
    assert 2000 < row.rate and len(row.cdf) < 30 * row.rate**0.5 and row.first > 1
    exact, log_p = 0.0, -row.rate
    for k in range(1, row.first + len(row.cdf)):
        exact += math.exp(log_p)
        log_p += math.log(row.rate / k)
        if k >= row.first:
            assert abs(row.cdf[k - row.first] - exact) < 1e-9
    n = Counter(r.doc_id for r in mixing.mix_sources(docs, weights={"tiny": 1.0, "big": 1.0}).where("source = 'tiny'").select("doc_id").collect())
    assert len(n) == 40 and abs(sum(n.values()) / 40 - row.rate) < 4 * (row.rate / 40) ** 0.5


def test_counts_are_poisson(documents):
    docs = documents([(i, f"t{i:06d}", "a") for i in range(6000)] + [(10**6 + i, "x" * 6 + f"{i}", "b") for i in range(2000)])
    counts = Counter(r.doc_id for r in mixing.mix_sources(docs).where("source = 'a'").select("doc_id").collect())
    mean = sum(counts.values()) / 6000
    none = 1 - len(counts) / 6000
    assert abs(none - math.exp(-mean)) < 0.03


def test_mixing_keeps_repeated_rows_and_nulls(documents):
    docs = documents([(1, "same", "s")] * 50 + [(None, None, "s")] * 10)
    n = Counter((r.doc_id, r.copy) for r in mixing.mix_sources(docs).collect())
    assert all(v in (50, 10) for v in n.values())
