from __future__ import annotations

import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) rows, with columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", 1) for r in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, words string, _key string, node int"
        return spark.createDataFrame(full, names)

    return make


@pytest.fixture
def vectors_table(spark):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
            T.StructField("row", T.StringType()),
        ]
    )
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], schema)
