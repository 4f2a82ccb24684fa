"""Extraction, tokens, personal data and the classifier against plain versions."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clicktrail.llm import bpe, html_text, pii, quality_model

ARTICLE = "<article><h1>A &lt;title&gt;</h1><p>First   paragraph with a good number of words\n in it.<br>More.</p><p>Short.</p></article>"


def test_main_text_of_an_article():
    page = (
        '<html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/a">Menu</a></ul></nav>'
        f'<div class="ad">Buy now, it is cheap and good and you need it</div>{ARTICLE}<aside>More links</aside>'
        '<div id="comments"><p>A reader says very much about this article, and more</p></div><footer>&copy; all</footer></body'
    )
    assert html_text.main_text(page) == "A <title>\nFirst paragraph with a good number of words in it. More.\nShort."


def test_parts_inside_an_article_that_are_not_its_text():
    page = ARTICLE.replace("</article>", '<form><p>Mail address please, we write to you often</p></form><div class="share-box">Share</div><p>End.</p></article>')
    assert html_text.main_text(page).endswith("Short.\nEnd.")


def test_pages_without_an_article_use_density():
    text = "word " * 40
    page = "<div><a>x</a> <a>y</a> <a>z</a></div>" * 3 + f"<div><p>{text}</p><p>{text}</p></div>" + "<div><a>x</a> <a>y</a></div>" * 3
    assert html_text.main_text(page) == "\n".join([text.strip()] * 2)


@given(st.text(alphabet='<>/ab p="&;!-\n', max_size=60))
@settings(max_examples=200, deadline=None)
def test_broken_markup_never_fails(html):
    html_text.main_text(html)


def test_extract_table(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", ARTICLE, "x"), (3, "u", "<p>" + "long " * 200_000, "x"), (3, "u", ARTICLE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert html_text.extract(pages.where("false")).count() == 0


VOCABULARY = bpe.default_vocabulary()
THEIRS = Tokenizer.from_file(VOCABULARY)
OURS, BACK = bpe.encoder(VOCABULARY), bpe.decoder(VOCABULARY)


@given(st.one_of(st.text(max_size=80), st.text(alphabet="aabet hn'sré🙂<|endoftext|>\n 1", max_size=120)))
@settings(max_examples=500, deadline=None)
def test_ids_equal_the_library(text):
    # Letters that Unicode has added lately are classed differently by different libraries.
    text = "".join(c for c in text if ord(c) < 0x3000 and (c.isalnum() or c.isspace() or ord(c) < 128) or c == "🙂")
    want = THEIRS.encode(text, add_special_tokens=False).ids
    got = OURS.encode(text)
    assert got == want
    assert BACK.decode(np.array(got, np.int64)) == THEIRS.decode(want, skip_special_tokens=False) == text


def test_every_token_is_its_own_encoding():
    some = range(0, 50256, 17)
    assert all(OURS.merged(OURS.name[i]) == [i] for i in some)


@given(st.integers(0, 50255), st.integers(0, 50255))
@settings(max_examples=500, deadline=None)
def test_pair_table_equals_the_merges(a, b):
    assert OURS.compatible(a, b) == (OURS.merged(OURS.name[a] + OURS.name[b]) == [a, b])


def test_encode_table(documents):
    texts = [None, "", "a <|endoftext|> b", "x" * 50_000, "le été\n\n  fin", "le été\n\n  fin"]
    got = {r.doc_id: r[1:] for r in bpe.digests(documents(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == bpe.plain_digest(THEIRS.encode(t or "", add_special_tokens=False).ids, t or "")
    assert bpe.digests(documents([(1, "x")]).where("false")).count() == 0


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return [(k, *m.span()) for k, m in out]


@given(st.one_of(st.text(alphabet="a.@-1+% 2", max_size=60), st.text(alphabet="0123456789.- +()", max_size=80)))
@settings(max_examples=1500, deadline=None)
def test_base_spans_equal_plain_regular_expressions(text):
    assert pii.base_spans(text) == plain_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1 " * 100_000, "a@" * 100_000, "x" * 100_000 + "@mail.example.com"):
        pii.base_spans(text)
        pii.candidates(text, [])


def test_weak_supervision_finds_secrets_and_leaves_prose(documents):
    secret = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f'some words token = "{secret(i)}" and mail to.me{i}@mail.example.com end') for i in range(60)]
    rows += [(100 + i, f"the commit {secret(i)} and version 1.2.3 of 2021") for i in range(20)] + [(200, None), (201, ""), (200, None)]
    got = {r.doc_id: r for r in pii.spans_of(documents(rows)).collect()}
    for i in range(60):
        a = rows[i][1].index(secret(i))
        base = "email:" + ":".join(map(str, re.search(r"\S+@\S+", rows[i][1]).span()))
        assert got[i].spans == f"{base},secret:{a}:{a + 40}"
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[i].n_email == 1
    assert not any(got[100 + i].spans for i in range(20))
    assert got[200].spans == "" and got[201].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_redaction(documents):
    text = "é mail a@b.example.com, 10.0.0.1 or +1 (052) 555-0934 🙂"
    rows = documents([(1, text), (1, text), (2, "nothing here"), (None, "10.0.0.1"), (4, None)])
    got = sorted((str(r.doc_id), r.text, r.n_chars) for r in pii.redact(rows).collect())
    clean = "é mail [EMAIL], [IP] or [PHONE] 🙂"
    assert got == [("1", clean, len(clean))] * 2 + [("2", "nothing here", 12), ("4", None, None), ("None", "[IP]", 4)]
    assert pii.redact(rows.where("false")).count() == 0


def test_expectation_maximisation_tells_good_labelers_from_bad():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in (0.95, 0.9, 0.85, 0.55, 0.5)], axis=1)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table = pii.reliabilities(patterns, counts.astype(float))
    assert ((posterior > 0.5)[at.ravel()] == truth).mean() > 0.95
    assert table[0, 1, 2] > 0.9 and abs(table[4, 1, 2] - 0.5) < 0.1


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_model.score_documents(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 or score > 1").count() == 0
    rows = got.join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.85
    assert sum(r.predicted == 1 for r in rows if r.quality == 1) / len(good) > 0.95


def test_classifier_without_labels_and_on_odd_rows(documents, spark):
    docs = documents([(1, None), (None, ""), (2, "x" * 300_000), (2, "x")])
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_model.score_documents(docs, labels).collect()} == {0.5}
    assert quality_model.score_documents(docs.where("false"), labels).count() == 0


def test_decoding_a_table_of_ids(documents):
    docs = documents([(1, "le été"), (2, None)])
    encoded = bpe.encode_documents(docs)
    assert sorted(map(tuple, bpe.decode_documents(encoded).select("doc_id", "text").collect())) == [(1, "le été"), (2, "")]
    assert sorted(bpe.round_trip(docs).collect()) == sorted(bpe.decode_documents(encoded).collect())


def test_class_names_of_pages_and_articles():
    page = '<body class="single comments-open"><article class="post comments-open">' + ARTICLE[9:].replace("</article>", "")
    page += '<div class="adText">Buy</div></article><article class="comment">I do not agree with a word of it</article></body>'
    assert html_text.main_text(page) == "A <title>\nFirst paragraph with a good number of words in it. More.\nShort."


def test_long_zeros_before_a_dot_pattern():
    text = "0" * 5000 + ".1.2.3 and 10.0.0.255"
    assert [x for x in pii.base_spans(text) if x[0] == "ip"][-1] == ("ip", len(text) - 10, len(text))
