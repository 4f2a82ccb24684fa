"""Fingerprints and edited texts against a plain version."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from clicktrail.llm import imatch


def prose(rng, n, topic=0):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % 4000}t{topic if rng.random() < 0.5 else 0}" for _ in range(n))


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    rows = [(3 * i - 50, prose(rng, rng.choice([1, 5, 40, 200, 900]), i % 3)) for i in range(n)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, rows[0][1]), (1004, "é🙂" * 70_000), (1005, rows[0][1])]
    rng.shuffle(rows)
    return rows


def plain(rows):
    """doc_id -> n_chars, digest of the edited text and the two texts it is compared with."""
    order = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), text, new, after)
    return out


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 40_000])
def test_edited_texts_and_likeness(documents, spark, bucket_bytes):
    rows = corpus()
    docs = documents(rows).repartition(5)
    got = imatch.edit_likeness(docs, bucket_bytes).collect()
    want = plain(rows)
    assert sorted(r.doc_id for r in got) == sorted(want)
    known = imatch.lexicon(docs)
    prints = {t: imatch.Prints([t], known).text(0) for w in want.values() for t in w[2:]}
    for r in got:
        n, digest, text, new, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert (r.fingerprint, r.edited_fingerprint) == (prints[text], prints[new])
        assert r.near_edited == imatch.likeness(prints[text], prints[new])
        assert r.near_next == imatch.likeness(prints[text], prints[after])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    one = {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs).collect()}
    assert one == {r.doc_id: r.fingerprint for r in got}


def test_lexicon_is_the_band_of_document_frequencies(documents):
    rows = corpus(300)
    count = {}
    for _, t in rows:
        for w in {w.lower() for w in (t or "").split()}:
            count[w] = count.get(w, 0) + 1
    band = [w for w, n in count.items() if n >= imatch.LEAST_DOCS and 100 * n <= imatch.COMMONEST_PERCENT * len(rows)]
    hashes = imatch.find_words(imatch.pa.array(band), lower=True).hash
    assert sorted(hashes.tolist()) == imatch.lexicon(documents(rows)).tolist()


def test_a_full_lexicon_leaves_out_the_rarest(documents, monkeypatch):
    whole = imatch.lexicon(documents(corpus(300)))
    monkeypatch.setattr(imatch, "LEXICON_TERMS", len(whole) // 2)
    part = imatch.lexicon(documents(corpus(300)))
    assert 0 < len(part) <= len(whole) // 2 and set(part.tolist()) < set(whole.tolist())


def test_edited_texts_are_nearer_than_others(documents):
    rng = random.Random(8)
    rows = [(i, prose(rng, 300, i % 2)) for i in range(200)]
    got = imatch.edit_likeness(documents(rows)).collect()
    near = np.array([(r.near_edited, r.near_next) for r in got])
    assert (near[:, 0] > near[:, 1]).mean() > 0.9


def test_signatures_ignore_order_case_and_repeats(documents):
    known = np.zeros(0, np.uint64)
    a, b, c = imatch.Prints(["a b c d", "D c\n b  A a a", "a b c e"], known), 1, 2
    assert a.text(0) == a.text(b) != a.text(c)
    assert imatch.likeness(a.text(0), a.text(0)) == 1 and imatch.likeness("", "") == 1 and imatch.likeness("", a.text(0)) == 0


def test_odd_tables(documents):
    assert imatch.edit_likeness(documents([(1, "x")]).where("false")).count() == 0
    (r,) = imatch.edit_likeness(documents([(7, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    rows = [(None, "abcd"), (None, None), (None, "wxyz"), (1, "one two"), (1, "three four"), (1, "three four"), (5, "the last one")]
    got = imatch.edit_likeness(documents(rows), 4).collect()
    assert len(got) == 7
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in got if r.doc_id is None) == sorted([digest("ab"), digest(""), digest("wx")])
    assert sorted(r.edited_sha256 for r in got if r.doc_id == 1) == sorted([digest("one the"), *[digest("threethe l")] * 2])
    assert {r.edited_sha256 for r in got if r.doc_id == 5} <= {digest("the laone tw"), digest("the lathree ")}
    many = imatch.edit_likeness(documents([(4, f"copy {i % 3} of a text") for i in range(300)] + [(9, "z")])).collect()
    assert len(many) == 301 and len({r.edited_sha256 for r in many if r.doc_id == 4}) == 3
