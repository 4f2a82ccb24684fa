"""Periodic runs against a comparison of every word with the one a period on."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from clicktrail.llm import periods


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            e = k
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - k + q
            stretch = words[k : k + length]
            if e > k and length >= max(6, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                out.append((k, length, q))
            k = e + 1
    return sorted(out)


def plain(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    longest = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (len(found), *longest, longest[1] * 1000 // longest[2] if found else None, digest(listed.encode()), digest(kept))


def texts(seed, n):
    """Random words with repeated units in them, also repeated units of repeated units."""
    rng = random.Random(seed)
    for _ in range(n):
        kinds = rng.choice([1, 2, 3, 9, 60])
        words = [rng.randrange(kinds) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(0, 4)):
            unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 26))]
            if rng.random() < 0.5:
                unit = ([rng.randrange(kinds) for _ in range(rng.randrange(1, 5))] * 26)[: len(unit)] + [rng.randrange(kinds)]
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = (unit * 8)[: rng.randrange(2 * len(unit), 7 * len(unit))]
        yield " ".join(f"w{w}" for w in words)


WORDS = ["a"]
for _ in range(9):
    WORDS += ["b" if w == "a" else "a" for w in WORDS]
FIBONACCI = ["a"], ["a", "b"]
while len(FIBONACCI[1]) < 600:
    FIBONACCI = FIBONACCI[1], FIBONACCI[1] + FIBONACCI[0]
ODD = [None, "", " \n", "one", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3, "é " * 7, " ".join(WORDS), " ".join(FIBONACCI[1]), "A a " * 9]
ODD += ["x " * 30_000, "x y z " * 5 + "x y z x y w " * 5]


def test_equal_a_plain_version(documents):
    rows = list(enumerate([*ODD, *texts(1, 400)])) + [(None, "a a a a a a b"), (3, "c " * 8), (3, "c " * 8)]
    got = periods.periodic_runs(documents(rows).repartition(3), tail=True).collect()
    assert len(got) == len(rows)
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((str(r.doc_id), *map(str, (r[c] for c in names))) for r in got) == sorted((str(i), *map(str, plain(i, t))) for i, t in rows)
    for r in got:
        assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs


@pytest.mark.parametrize("seed", range(6))
def test_texts_searched_together(seed):
    many = [t.encode().split() for t in texts(100 + seed, 60)]
    symbols, first = periods._numbered(many)
    start, length, period = periods.runs(symbols)
    for k, words in enumerate(many):
        mine = (start >= first[k]) & (start < first[k] + len(words) + 1)
        assert sorted(zip((start[mine] - first[k]).tolist(), length[mine].tolist(), period[mine].tolist(), strict=True)) == plain_runs(words)


def test_range_successor():
    rng = np.random.default_rng(2)
    numbers = rng.permutation(700)[:500]
    tree = periods.Successor(numbers, 700)
    low = rng.integers(0, 400, 300)
    high = low + rng.integers(1, 100, 300)
    value, k = rng.integers(0, 900, 300), rng.integers(0, 100, 300) % (high - low)
    assert tree.below(low, high, value).tolist() == [int((numbers[a:b] < v).sum()) for a, b, v in zip(low, high, value, strict=True)]
    assert tree.smallest(low, high, k).tolist() == [int(np.sort(numbers[a:b])[i]) for a, b, i in zip(low, high, k, strict=True)]


def test_empty_table(documents):
    out = periods.periodic_runs(documents([(1, "x")]).where("false"), keep_text=False)
    assert out.count() == 0 and "collapsed" not in out.columns
