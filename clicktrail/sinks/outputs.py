"""Report, reject, quality and lineage outputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.operators.quality import masked_errors
from clicktrail.plans.reports import report_as_text
from clicktrail.rules import Rules
from clicktrail.session import Staging
from clicktrail.sinks import files

# How a report is delivered: one file, written by one task, or a folder of
# sorted parts under the same name.  The caller chooses; row counts never do.
LAYOUTS = ("single", "parts")

# The field names of the lineage record.
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("input_file", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_file", T.StringType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("engine_used", T.StringType()),
        T.StructField("dq_passed", T.BooleanType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("git_commit", T.StringType()),
        T.StructField("attribution_model", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

CHECK_TYPE = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("missing", T.ArrayType(T.StringType())),
        T.StructField("actual_columns", T.ArrayType(T.StringType())),
        T.StructField("critical_failures", T.LongType()),
        T.StructField("type_failures", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("duplicate_count", T.LongType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("warnings", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("input_file", T.StringType()),
        T.StructField("overall_passed", T.BooleanType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("checks", T.ArrayType(CHECK_TYPE)),
    ]
)


def day_folder(root: str, when: datetime, *parts: str) -> str:
    """``root/parts.../year=YYYY/month=MM/day=DD``."""
    return "/".join([root.rstrip("/"), *parts, f"year={when:%Y}", f"month={when:%m}", f"day={when:%d}"])


def partition_path(root: str, values: dict[str, str]) -> str:
    """The folder of a partition as Spark names it, special characters escaped."""
    special = "\"#%'*/:=?\\{[]^\x7f"
    escaped = lambda v: "".join(f"%{ord(c):02X}" if c in special or c < " " else c for c in v)
    return "/".join([root.rstrip("/"), *(f"{k}={escaped(v)}" for k, v in values.items())])


def report_file_name(rules: Rules, when: datetime) -> str:
    return rules.filename_pattern.replace("{date}", f"{when:%Y-%m-%d}")


def _publish(
    df: DataFrame,
    target: str,
    order: list[Column],
    layout: str,
    decorate: Callable[[DataFrame], DataFrame] = lambda d: d,
    skip_empty: bool = False,
    **options,
) -> int:
    """Compute once into a staging table, then deliver it whole under ``target``."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    spark = df.sparkSession
    stage = Staging(spark, "report")
    try:
        table = stage(df)
        rows = table.count()
        if rows or not skip_empty:
            how = files.publish_one_file if layout == "single" else files.publish_parts
            how(decorate(table), target, order, **options)
    finally:
        files.delete(spark, stage.folder)
    return rows


def write_keyword_report(
    report: DataFrame, folder: str, when: datetime, rules: Rules = Rules(), layout: str = "single"
) -> tuple[str, int]:
    """The ranked report, delimited as the rules say; returns its path and row count."""
    target = f"{folder.rstrip('/')}/{report_file_name(rules, when)}"
    domain, keyword, revenue = (F.col(f"`{c}`") for c in rules.output_columns)
    as_number = revenue.cast("double")
    order: list[Column] = [as_number.asc() if rules.sort_ascending else as_number.desc(), domain, keyword]
    rows = _publish(report, target, order, layout, lambda d: report_as_text(d, rules), sep=rules.output_delimiter, encoding=rules.output_encoding)
    return target, rows


def write_sem_report(
    report: DataFrame, folder: str, when: datetime, layout: str = "single"
) -> tuple[str | None, int]:
    """The keyword funnel as CSV; no file when there is nothing to report."""
    target = f"{day_folder(folder, when, 'sem_insights')}/sem_insights_{when:%Y%m%d}.csv"
    order = [F.col("total_revenue").desc(), F.col("search_engine_domain"), F.col("search_keyword")]
    rows = _publish(report, target, order, layout, skip_empty=True)
    return (target if rows else None), rows


def with_day(df: DataFrame, when: datetime, phase: str | Column | None = None) -> DataFrame:
    """Zero-padded partition columns ``[phase,] year, month, day``."""
    added = {} if phase is None else {"phase": phase if isinstance(phase, Column) else F.lit(phase)}
    added |= {"year": F.lit(f"{when:%Y}"), "month": F.lit(f"{when:%m}"), "day": F.lit(f"{when:%d}")}
    return df.withColumns(added)


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet", **options) -> None:
    """Replace exactly the partitions present in ``df``; the commit makes them visible together."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partitions)
        .save(path)
    )


def write_errors(errors: DataFrame, folder: str, when: datetime, stem: str, run_id: str, rules: Rules = Rules()) -> str:
    """Masked rejects as CSV parts below ``YYYY/MM/DD/<stem>_<run>_errors.csv``; any number of rows."""
    target = f"{folder.rstrip('/')}/{when:%Y}/{when:%m}/{when:%d}/{stem}_{run_id[:8]}_errors.csv"
    flat = masked_errors(errors, rules).drop("pos", "source_file")
    flat.write.mode("overwrite").options(header=True).csv(target)
    return target


def write_json_record(spark: SparkSession, record: dict, schema: T.StructType, target: str) -> str:
    """One record as a JSON dataset."""
    row = {name: record.get(name) for name in schema.names}
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(target)
    return target


def write_quality_report(spark: SparkSession, report: dict, folder: str, when: datetime, stem: str) -> str:
    target = f"{folder.rstrip('/')}/{when:%Y}/{when:%m}/{when:%d}/{stem}_{report['run_id'][:8]}_dq_report.json"
    return write_json_record(spark, report, QUALITY_SCHEMA, target)


def write_lineage(spark: SparkSession, record: dict, folder: str) -> str:
    target = f"{folder.rstrip('/')}/{record['execution_date'][:10]}/{record['run_id']}.json"
    return write_json_record(spark, record, LINEAGE_SCHEMA, target)
