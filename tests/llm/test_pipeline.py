"""The pipeline against the plain meaning of its stages, on a small corpus."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from clicktrail.llm import bpe, mixing


def corpus():
    prose = lambda i: " ".join(f"word{i}n{k}" for k in range(80))
    rows = [(i, prose(i), "en", f"s{i % 2}", 0) for i in range(40)]
    rows += [(100 + i, prose(i), "en", "s0", 0) for i in range(10)]  # copies
    rows += [(200 + i, prose(i) + " end", "en", "s1", 0) for i in range(10)]  # near copies
    rows += [(300, "too short", "en", "s0", 0), (301, "again " * 200, "en", "s1", 0), (302, None, None, None, None)]
    rows += [(400 + i, prose(50 + i) + f" mail me{i}@mail.example.com now", "en", "s0", 0) for i in range(5)]
    return rows


def test_run(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("extra", docs.text).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    texts = {i: t for i, t, *_ in corpus() if i < 40 or 400 <= i}  # rejected, copies and near copies are gone
    texts = {i: re.sub(r"\S+@\S+", "[EMAIL]", t) for i, t in texts.items()}
    kept = spark.createDataFrame([(i, t, "en", "s0" if i >= 400 else f"s{i % 2}", 0) for i, t in texts.items()], docs.schema)
    times = Counter(r.doc_id for r in mixing.mix_sources(kept).collect())
    assert Counter(r.doc_id for r in got) == times
    ours = bpe.encoder(bpe.default_vocabulary())
    for r in got:
        assert r.text == texts[r.doc_id] and list(r.ids) == ours.encode(r.text) and r.n_tokens == len(r.ids)


def test_stages_return_the_columns_of_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == empty.columns and out.dtypes == empty.dtypes
            empty = out
