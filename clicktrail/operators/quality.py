"""Row and column checks with row-level rejects.

Rejects carry the whole row plus ``_error_reason``.  Only :func:`error_rows`
runs jobs, to know the repeated keys; :func:`profile` is a single aggregate a
caller may collect (one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.text import is_blank, masked
from clicktrail.operators import dedup
from clicktrail.operators.dedup import Stage, dedup_key
from clicktrail.rules import TYPE_NAMES, Rules
from clicktrail.session import Staging
from clicktrail.sources.hits import with_stored_positions

REASON = "_error_reason"


class SchemaValidationError(ValueError):
    pass


class NullValidationError(ValueError):
    pass


def data_columns(hits: DataFrame) -> list[str]:
    """The columns of the file itself, without arrival order and file name."""
    return [c for c in hits.columns if c not in ("pos", "source_file")]


def missing_columns(hits: DataFrame, rules: Rules) -> list[str]:
    """Metadata only; runs nothing."""
    return sorted(set(rules.required_columns) - set(hits.columns))


def check_schema(hits: DataFrame, rules: Rules) -> dict:
    missing = missing_columns(hits, rules)
    return {
        "check": "schema_validation",
        "passed": not missing,
        "missing": missing,
        "actual_columns": data_columns(hits),
    }


def schema_rejects(hits: DataFrame, rules: Rules) -> DataFrame:
    """All rows, when a required column is missing; none otherwise."""
    missing = missing_columns(hits, rules)
    reason = f"schema_error: missing columns {missing}"
    return hits.where(F.lit(bool(missing))).withColumn(REASON, F.lit(reason))


def has_null_critical(rules: Rules, columns: Sequence[str]) -> Column:
    failing = F.lit(False)
    for c in rules.critical_columns:
        if c in columns:
            failing = failing | is_blank(F.col(c))
    return failing


def _typed(rules: Rules, columns: Sequence[str]) -> list[tuple[str, str]]:
    """The columns that can have the wrong type, with their Spark types."""
    declared = [(c, TYPE_NAMES.get(t, t)) for c, t in rules.column_dtypes if c in columns]
    return [(c, t) for c, t in declared if t != "string"]


def _type_error(column: str, dtype: str) -> Column:
    return ~is_blank(F.col(column)) & F.col(column).try_cast(dtype).isNull()


def has_type_error(rules: Rules, columns: Sequence[str]) -> Column:
    failing = F.lit(False)
    for c, dtype in _typed(rules, columns):
        failing = failing | _type_error(c, dtype)
    return failing


def is_valid(rules: Rules, columns: Sequence[str]) -> Column:
    bad = has_null_critical(rules, columns)
    if rules.reject_type_errors:
        bad = bad | has_type_error(rules, columns)
    return ~bad


def _with_reasons(rows: DataFrame, reasons: list[Column]) -> DataFrame:
    """One output row per reason that applies."""
    if not reasons:
        return rows.where(F.lit(False)).withColumn(REASON, F.lit(""))
    return rows.withColumn(REASON, F.explode(F.array_compact(F.array(*reasons))))


def _null_reasons(rules: Rules, columns: Sequence[str]) -> list[Column]:
    present = [c for c in rules.critical_columns if c in columns]
    return [F.when(is_blank(F.col(c)), F.lit(f"null_critical_column: {c}")) for c in present]


def _type_reasons(rules: Rules, columns: Sequence[str]) -> list[Column]:
    return [F.when(_type_error(c, t), F.lit(f"type_error: {c}")) for c, t in _typed(rules, columns)]


def null_rejects(hits: DataFrame, rules: Rules) -> DataFrame:
    """A row per failing critical column."""
    return _with_reasons(hits.where(has_null_critical(rules, hits.columns)), _null_reasons(rules, hits.columns))


def type_rejects(hits: DataFrame, rules: Rules) -> DataFrame:
    """A row per column whose text is not of the declared type."""
    return _with_reasons(hits.where(has_type_error(rules, hits.columns)), _type_reasons(rules, hits.columns))


def profile_counts(hits: DataFrame, rules: Rules) -> list[Column]:
    """How many rows, how many fail, how many type errors there are, and blanks per column."""
    blanks = [F.count_if(is_blank(F.col(c))).alias(f"blank_{c}") for c in data_columns(hits)]
    null_critical = has_null_critical(rules, hits.columns)
    type_errors = F.lit(0)
    for c, dtype in _typed(rules, hits.columns):
        type_errors = type_errors + F.when(_type_error(c, dtype), 1).otherwise(0)
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(null_critical).alias("null_failed"),
        F.count_if(~null_critical & has_type_error(rules, hits.columns)).alias("type_failed"),
        F.count_if(~is_valid(rules, hits.columns)).alias("rows_failed"),
        F.coalesce(F.sum(type_errors), F.lit(0)).alias("type_errors"),
        *blanks,
    ]


def profile(hits: DataFrame, rules: Rules) -> DataFrame:
    """One row of :func:`profile_counts` - a single map-side aggregate."""
    return hits.agg(*profile_counts(hits, rules))


def null_counts(hits: DataFrame) -> DataFrame:
    """Blank values per column, as ``(column_name, blanks, total)``."""
    columns = data_columns(hits)
    counted = hits.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_blank(F.col(c))).alias(c) for c in columns],
    )
    return counted.unpivot("total", columns, "column_name", "blanks").select("column_name", "blanks", "total")


def null_rate_warnings(hits: DataFrame, rules: Rules) -> DataFrame:
    """Non-critical columns that are blank more often than the rules allow."""
    rate = F.round(F.col("blanks") * F.lit(100).cast("decimal(5,0)") / F.col("total"), 2).cast("double")
    return (
        null_counts(hits)
        .where(~F.col("column_name").isin(*rules.critical_columns))
        .withColumn("blank_pct", F.when(F.col("total") > 0, rate).otherwise(F.lit(0.0)))
        .where(F.col("blank_pct") > float(rules.null_warning_threshold_pct))
    )


def summary(hits: DataFrame, rules: Rules) -> DataFrame:
    """The quality report as one row; duplicates are counted but never fail a run.

    Exact and skew-safe: copies of a key collapse on the map side before the
    distinct count moves anything.
    """
    valid = is_valid(rules, hits.columns)
    key = F.struct(*dedup_key(hits, rules))
    reasons = F.lit(0)
    for c in rules.critical_columns:
        reasons = reasons + F.when(is_blank(F.col(c)), 1).otherwise(0)
    if rules.reject_type_errors:
        for c, dtype in _typed(rules, hits.columns):
            reasons = reasons + F.when(_type_error(c, dtype), 1).otherwise(0)
    counted = hits.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(has_null_critical(rules, hits.columns)).alias("null_failed"),
        F.count_if(valid).alias("rows_before"),
        F.count_distinct(F.when(valid, key)).alias("rows_after"),
        F.coalesce(F.sum(reasons), F.lit(0)).alias("reject_reasons"),
    )
    duplicates = F.col("rows_before") - F.col("rows_after")
    schema_ok = F.lit(not missing_columns(hits, rules))
    return counted.select(
        "rows_in",
        F.col("rows_after").alias("rows_out"),
        F.col("null_failed").alias("critical_failures"),
        "rows_before",
        "rows_after",
        duplicates.alias("duplicate_count"),
        (F.col("reject_reasons") + duplicates).alias("error_count"),
        (schema_ok & (F.col("rows_before") == F.col("rows_in"))).alias("overall_passed"),
    )


def row_rejects(hits: DataFrame, rules: Rules) -> DataFrame:
    """All rejects that can be told from the row alone, in one pass."""
    if not rules.reject_type_errors:
        return null_rejects(hits, rules)
    reasons = _null_reasons(rules, hits.columns) + _type_reasons(rules, hits.columns)
    return _with_reasons(hits.where(~is_valid(rules, hits.columns)), reasons)


def error_rows(
    hits: DataFrame,
    rules: Rules,
    scope: Sequence[str] = (),
    stage: Stage | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """All rejects: blank critical columns, bad types (if the rules reject them), duplicates.

    ``repeated`` are the repeated keys of the valid hits, where the caller has them.  They are counted: up to
    ``dedup.BROADCAST_KEYS`` of them are broadcast, and one scan without a shuffle gives each row all its reasons;
    more are joined, apart from the rejects that a row alone tells.
    """
    stage = stage or Staging(hits.sparkSession, "errors")
    hits = with_stored_positions(hits, stage)
    is_good = is_valid(rules, hits.columns)
    if repeated is None:
        repeated = dedup.repeated_keys(hits.where(is_good), rules, scope, stage)
    if repeated.count() > dedup.BROADCAST_KEYS:
        copies = dedup.duplicate_rejects(hits.where(is_good), rules, scope, stage, repeated)
        return row_rejects(hits, rules).unionByName(copies)
    rows = dedup.first_positions(hits, rules, repeated, is_good, scope)
    later = F.coalesce(F.col("_first") != F.col("pos"), F.lit(False))
    reasons = _null_reasons(rules, hits.columns)
    reasons += _type_reasons(rules, hits.columns) if rules.reject_type_errors else []
    reasons.append(F.when(later, dedup.duplicate_reason(hits, rules)))
    return _with_reasons(rows.where(~is_good | later), reasons).select(*hits.columns, REASON)


def masked_errors(errors: DataFrame, rules: Rules) -> DataFrame:
    """Rejects fit to be stored: personal columns hashed, empty values left empty."""
    hidden = {
        c: F.when(F.col(c).isNull() | (F.col(c) == ""), F.col(c)).otherwise(masked(F.col(c)))
        for c in rules.pii_columns
        if c in errors.columns
    }
    return errors.withColumns(hidden)
