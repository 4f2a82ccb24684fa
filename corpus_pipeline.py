"""A training corpus from raw documents: quality rules, near duplicates, personal data, source mix, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktrail.llm import bpe, jaccard, mixing, pii, quality_rules
from clicktrail.llm.store import staged

#: The columns of ``documents``, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines of their host go from the others."""
    return quality_rules.clean_documents(docs).select(*COLUMNS)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at 80 percent of common five-word shingles stays: that of the smallest doc_id."""
    return jaccard.one_of_each(docs).select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out by their source's rate, and shuffled."""
    return mixing.mix_sources(docs).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids and the text that they decode to."""
    return bpe.round_trip(docs).selectExpr("doc_id", "cast(size(ids) as bigint) as n_tokens", "ids", "text")


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", encoding_stage),
]

#: Spans from weak supervision and the merges of a vocabulary are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage-{k}")
    return docs
