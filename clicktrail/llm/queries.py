"""One query for each operator over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clicktrail.llm import (
    bpe,
    html_text,
    imatch,
    jaccard,
    mixing,
    passages,
    periods,
    pii,
    quality_model,
    quality_rules,
    sharding,
    vectors,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to the target shares of their sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "source", "copy", "order_key")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 contiguous shards of equal bytes."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at 90 percent of common three-word shingles."""
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"), words=3, percent=90).drop("n_equal")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated quality score of every document."""
    return quality_model.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word passages of earlier ones."""
    return passages.remove_repeats(_table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids and back."""
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.spans_of(_table(spark, sf_dir, "documents"))


def op10_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near equal embeddings of a label."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return imatch.edit_likeness(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, every tenth of them with a repeated tail."""
    return periods.periodic_runs(_table(spark, sf_dir, "documents"), tail=True, keep_text=False).drop("runs")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_html_extraction,
            op2_mixing,
            op3_sharding,
            op4_quality_rules,
            op5_jaccard_join,
            op6_quality_classifier,
            op7_substring_dedup,
            op8_bpe,
            op9_pii,
            op10_embedding_neighbours,
            op11_embedding_whitening,
            op12_fingerprints,
            op13_periodic_runs,
        )
    }


def oracle_sql() -> dict[str, str]:
    """The others are not SQL: a parser, a trained model, a vocabulary's merges, weak supervision, eigenvectors, fingerprints and runs."""
    return {
        "op2_mixing": mixing.ORACLE,
        "op3_sharding": sharding.ORACLE,
        "op4_quality_rules": quality_rules.ORACLE,
        "op5_jaccard_join": jaccard.ORACLE,
        "op7_substring_dedup": passages.ORACLE,
        "op10_embedding_neighbours": vectors.ORACLE,
    }
