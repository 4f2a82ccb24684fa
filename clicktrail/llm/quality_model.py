"""A quality score from how much better a text compresses with a dictionary of good texts than with one of bad texts.

Two zstandard dictionaries are built from labelled texts of either kind.  A text is compressed with each,
and without one; the difference of the sizes over the plain size, the plain compression ratio and the
length give a logistic score, fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.words import chunks

#: Bounds of the labelled sample that is brought to the driver: texts of each label, and bytes of a text.
SAMPLE_DOCS = 3000
SAMPLE_TEXT_BYTES = 65_536
DICTIONARY_BYTES = 32_768
THRESHOLD = 0.3
FOLDS = 5
#: One in so many sampled texts is kept from the dictionaries for the calibration.
CALIBRATION = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]


@lru_cache(maxsize=2)
def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    plain = {"level": 3, "write_content_size": False, "write_checksum": False}
    out = [zstandard.ZstdCompressor(**plain)]
    for raw in (model.good, model.bad):
        if raw:
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(level=3)
            out.append(zstandard.ZstdCompressor(dict_data=words, write_dict_id=False, **plain))
        else:
            out.append(out[0])
    return out


def features(model: Model, text: str | None) -> list[float]:
    raw = (text or "").encode()
    plain, good, bad = (len(c.compress(raw)) for c in _compressors(model))
    gain, ratio, length = (bad - good) / plain, plain / (len(raw) + 1), math.log(len(raw) + 1)
    return [gain, ratio, length, gain * length, ratio * ratio]


def _dictionary(texts: list[str]) -> bytes:
    raw = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, raw).as_bytes()
    except (zstandard.ZstdError, ValueError):
        # Too few texts for the trainer: their own bytes are the dictionary.
        return b"".join(raw)[-DICTIONARY_BYTES:]


def fit(rows: list[tuple[int, str, int]]) -> Model:
    """From (hash, text, label) of the sample; the hash says which rows calibrate."""
    train = {q: [t for h, t, label in rows if label == q and h % CALIBRATION] for q in (0, 1)}
    model = Model(_dictionary(train[1]), _dictionary(train[0]), (), (), ())
    held = [(t, label) for h, t, label in rows if h % CALIBRATION == 0]
    x = np.array([features(model, t) for t, _ in held]).reshape(len(held), 5)
    y = np.array([float(label) for _, label in held])
    if len(set(y)) < 2:
        # Nothing to tell apart: the share of good texts is everyone's score.
        share = float(np.mean([label for *_, label in rows])) if rows else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(model.good, model.bad, (math.log(share / (1 - share)), 0.0, 0.0, 0.0, 0.0, 0.0), (0.0,) * 5, (1.0,) * 5)
    center, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - center) / scale])
    w = np.zeros(6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + 0.01 * np.eye(6), a.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return Model(model.good, model.bad, tuple(w), tuple(center), tuple(scale))


def score(model: Model, text: str | None) -> float:
    x = (np.array(features(model, text)) - model.center) / model.scale
    return 1 / (1 + math.exp(-min(max(float(model.weights[0] + x @ model.weights[1:]), -30.0), 30.0)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows from which no label is learned; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int, str, int]]:
    """(hash, text, label) of at most SAMPLE_DOCS labelled texts of each label, by the order of a hash."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).withColumn("h", F.xxhash64("doc_id"))
    picked = [known.where(F.col("quality") == q).orderBy("h").limit(SAMPLE_DOCS) for q in (0, 1)]
    some = picked[0].union(picked[1])  # a bounded number of rows
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT_BYTES))
    rows = texts.join(F.broadcast(some), "doc_id").select(F.crc32(F.hex("doc_id")).alias("h"), "text", "quality")
    return sorted((r.h, r.text, r.quality) for r in rows.limit(4 * SAMPLE_DOCS).collect())


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Null and empty texts are scored as empty.  Without labels of both kinds all scores are the share of
    good labels, or 0.5.  Repeated rows are each scored; other columns are not read.
    """
    model = fit(sample(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            values = [score(model, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    rows = docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
