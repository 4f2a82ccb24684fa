"""Every operator and report as a query over the given tables.

``events`` supplies the hits, ``pages`` supplies URLs and - as an example of
delivered objects - file names.  All queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clicktrail.functions import commerce, paths, text, urls
from clicktrail.operators import dedup, quality, sessions
from clicktrail.operators.activity import activity, purchases, touches
from clicktrail.plans import models, reports
from clicktrail.plans.batch import Run, run_batch, run_sem
from clicktrail.rules import HIT_COLUMNS, Rules
from clicktrail.session import Staging, new_path, unstaged
from clicktrail.sinks import files, outputs
from clicktrail.sources import manifest
from clicktrail.sources.event_hits import hits_from_events, with_dirt
from clicktrail.sources.hits import read_hits
from clicktrail.streaming.intake import Intake
from clicktrail.streaming.registry import Registry

RULES = Rules()
LENIENT = Rules(fail_on_null_critical=False)
TYPED = Rules(fail_on_null_critical=False, reject_type_errors=True)
CUSTOM = Rules(
    search_engine_domains=("google.com", "bing.com", "duckduckgo.com"),
    keyword_params=("q",),
    purchase_event_id="2",
    revenue_col_index=2,
    keyword_normalize_case=False,
    min_revenue_threshold=1.5,
    sort_ascending=True,
    output_columns=("engine", "term", "units"),
)
WHEN = datetime(2024, 2, 1, 12, 0, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_from_events(_table(spark, sf_dir, "events"))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_dirt(_hits(spark, sf_dir))


def _activity(spark: SparkSession, sf_dir: str, rules: Rules = RULES) -> DataFrame:
    return activity(_hits(spark, sf_dir), rules)


def _flat(df: DataFrame) -> DataFrame:
    """Arrival order as plain columns."""
    rest = [c for c in df.columns if c != "pos"]
    return df.select("pos.event_id", "pos.copy", *rest)


def _event(df: DataFrame) -> DataFrame:
    return df.withColumn("event_id", F.col("pos.event_id")).drop("pos")


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# -- scalar functions --------------------------------------------------------


@query
def url_host(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", urls.url_host(F.col("url")).alias("host"))


@query
def registrable_domain(spark, sf_dir):
    domain = urls.registrable_domain(urls.url_host(F.col("url")))
    return _table(spark, sf_dir, "pages").select("page_id", domain.alias("domain"))


@query
def url_param(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_param(F.col("url"), "ref").alias("ref"),
        urls.url_param(F.col("url"), "utm_source", "page").alias("source_or_page"),
    )


@query
def search_touch(spark, sf_dir):
    touch = urls.search_touch(F.col("referrer"), RULES)
    skipping = urls.search_touch(F.col("referrer"), RULES, "skip")
    parsed = _hits(spark, sf_dir).select("pos", touch.alias("t"), skipping.alias("s"))
    return parsed.select(
        "pos.event_id",
        F.col("t.domain").alias("domain"),
        F.col("t.keyword").alias("keyword"),
        F.col("s.keyword").alias("keyword_skip"),
    )


@query
def has_purchase(spark, sf_dir):
    return _hits(spark, sf_dir).select(
        "pos.event_id",
        commerce.has_purchase(F.col("event_list"), RULES).alias("is_purchase"),
        commerce.has_event(F.col("event_list"), "11").alias("is_checkout"),
    )


@query
def product_revenue(spark, sf_dir):
    revenue = commerce.product_revenue(F.col("product_list"), RULES)
    return _hits(spark, sf_dir).select("pos.event_id", revenue.cast("double").alias("revenue"))


@query
def product_rows(spark, sf_dir):
    entries = commerce.products(F.col("product_list"), RULES)
    rows = _hits(spark, sf_dir).select("pos.event_id", F.posexplode(entries).alias("position", "entry"))
    return rows.select("event_id", "position", commerce.product_struct(F.col("entry"), RULES).alias("p")).select(
        "event_id", "position", "p.*"
    )


@query
def mask_pii(spark, sf_dir):
    return _dirty(spark, sf_dir).select(
        "pos.event_id",
        "pos.copy",
        text.masked(F.col("ip")).alias("ip"),
        text.masked(F.col("user_agent")).alias("user_agent"),
    )


@query
def revenue_text(spark, sf_dir):
    value = (F.col("value") * 1000).cast("decimal(18,2)")
    return _table(spark, sf_dir, "events").select("event_id", commerce.revenue_text(value).alias("revenue"))


@query
def crlf_normalize(spark, sf_dir):
    windows = F.concat(F.col("pagename"), F.lit("\r"), F.col("page_url"), F.lit("\r"))
    return _hits(spark, sf_dir).select("pos.event_id", text.without_cr(windows).alias("line"))


# -- sources -----------------------------------------------------------------


def _hit_parts(hits: DataFrame, folder: str) -> list[str]:
    """Write hits as tab-delimited files, one for each task."""
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    hits.select(*HIT_COLUMNS).write.options(sep="\t", header=True, escape='"', emptyValue="", **keep_blanks).csv(folder)
    return files.part_files(hits.sparkSession, folder)


def _hit_files(spark: SparkSession, hits: DataFrame, stem: str = "hits") -> str:
    """Write hits as tab-delimited files in arrival order, named as the contract asks."""
    folder = new_path(spark, "landing")
    for i, part in enumerate(_hit_parts(hits, f"{folder}/parts")):
        stamp = datetime(2024, 1, 31) + timedelta(seconds=i)
        files.move(spark, part, f"{folder}/raw/phase2/{stem}_{stamp:%Y%m%d_%H%M%S}.tab")
    return f"{folder}/raw"


def _visitor_files(spark: SparkSession, sf_dir: str) -> str:
    """Hit files that hold all hits of their visitors, so that files on their own give what all give together."""
    return _hit_files(spark, _hits(spark, sf_dir).repartition("ip").sortWithinPartitions("pos"))


@query
def read_hit_files(spark, sf_dir):
    folder = _hit_files(spark, _hits(spark, sf_dir))
    return read_hits(spark, f"{folder}/phase2").select(*HIT_COLUMNS)


@query
def keyword_report_from_files(spark, sf_dir):
    folder = _hit_files(spark, _hits(spark, sf_dir))
    return reports.keyword_report(read_hits(spark, f"{folder}/phase2"))


def _dirty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_hits(spark, f"{_hit_files(spark, _dirty(spark, sf_dir).orderBy('pos'))}/phase2")


@query
def dedup_hits_from_files(spark, sf_dir):
    return dedup.keep_first(_dirty_files(spark, sf_dir), RULES).select(*HIT_COLUMNS)


@query
def dq_dup_rejects_from_files(spark, sf_dir):
    return dedup.duplicate_rejects(_dirty_files(spark, sf_dir), RULES).select(*HIT_COLUMNS, quality.REASON)


def _object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivered object per page, in the folder and name styles that occur."""
    n = F.col("page_id")
    stamp = F.concat(F.lit("20240131_"), F.lpad((n % 86400).cast("string"), 6, "0"))
    name = (
        F.when(n % 4 == 0, F.concat(F.lit("hits_walk_"), n, F.lit(".tab")))
        .when(n % 4 == 1, F.concat(F.lit("hits_20240131_"), n, F.lit(".tab")))
        .otherwise(F.concat(F.lit("hits_"), n, F.lit("_"), stamp, F.lit(".TAB")))
    )
    folder = (
        F.when(n % 6 == 0, F.lit("raw/"))
        .when(n % 6 == 1, F.lit("raw/Sprint/"))
        .when(n % 6 == 2, F.lit("raw/phase/"))
        .otherwise(F.concat(F.lit("raw/phase"), n % 7, F.lit("/")))
    )
    # The generator stands for a scan: the path is a value, not an expression to copy around.
    path = F.explode(F.array(F.concat(folder, name))).alias("path")
    return _table(spark, sf_dir, "pages").select(path, "url")


def _registry(deliveries: DataFrame) -> DataFrame:
    """Objects whose page was already fetched over https count as processed."""
    return deliveries.where(F.col("url").startswith("https")).select("phase", "file_name")


@query
def phase_label(spark, sf_dir):
    return _object_keys(spark, sf_dir).select("path", paths.phase_label(F.col("path")).alias("phase"))


@query
def filename_contract(spark, sf_dir):
    keys = _object_keys(spark, sf_dir)
    name = paths.file_name(F.col("path"))
    return keys.select("path", paths.has_name_timestamp(name).alias("ok"), paths.is_hit_file(name).alias("is_hit_file"))


@query
def dup_delivery(spark, sf_dir):
    deliveries = manifest.delivery_facts(_object_keys(spark, sf_dir))
    return manifest.already_processed(deliveries, _registry(deliveries)).select("key", "phase", "file_name")


@query
def intake_manifest(spark, sf_dir):
    deliveries = manifest.delivery_facts(_object_keys(spark, sf_dir))
    return manifest.judged(deliveries, _registry(deliveries)).select("key", "phase", "file_name", "reason")


def _taken_in(spark: SparkSession, sf_dir: str) -> str:
    out = new_path(spark, "intake-out")
    intake = Intake(spark, _visitor_files(spark, sf_dir), out, RULES, move_files=False)
    intake.start(f"{out}/_checkpoint").awaitTermination()
    return out


@query
def stream_intake(spark, sf_dir):
    schema = "domain string, keyword string, revenue double, phase string, year string, month string, day string, file_name string"
    written = spark.read.schema(schema).parquet(f"{_taken_in(spark, sf_dir)}/processed")
    return written.groupBy("domain", "keyword").agg(F.round(F.sum("revenue"), 2).alias("revenue"))


@query
def intake_report_files(spark, sf_dir):
    """The ranked text reports that people read, summed over files."""
    domain, keyword, revenue = RULES.output_columns
    schema = StructType([StructField(c, StringType()) for c in RULES.output_columns])
    path = f"{_taken_in(spark, sf_dir)}/reports/phase=*/year=*/month=*/day=*/file_name=*/*_SearchKeywordPerformance.tab"
    texts = spark.read.options(sep="\t", header=True).schema(schema).csv(path)
    return texts.groupBy(F.col(f"`{domain}`").alias("domain"), F.coalesce(f"`{keyword}`", F.lit("")).alias("keyword")).agg(
        F.sum(F.col(f"`{revenue}`").cast("decimal(38,2)")).cast("double").alias("revenue")
    )


@query
def intake_quality_reports(spark, sf_dir):
    reports_ = spark.read.schema(outputs.QUALITY_SCHEMA).json(f"{_taken_in(spark, sf_dir)}/dq-reports")
    return reports_.agg(
        F.min("overall_passed").alias("all_passed"), F.sum("rows_in").alias("rows_in"), F.sum("error_count").alias("error_count")
    )


@query
def two_runs_one_day(spark, sf_dir):
    """Reports of two inputs of one day and one name, each with half of the visitors, side by side."""
    out = new_path(spark, "runs")
    keyword = RULES.output_columns[1]
    schema = StructType([StructField(c, StringType()) for c in RULES.output_columns])
    half = F.substring_index(F.trim("ip"), ".", -1).try_cast("int") % 2
    found = []
    for i in (0, 1):
        run = Run(f"raw/half{i}/hits.tab", "phase2", f"run-{i}", WHEN)
        run_batch(spark, _hits(spark, sf_dir).where(half == i), out, RULES, run)
        path = f"{out}/processed/phase2/year=2024/month=02/day=01/source={run.source}/2024-02-01_SearchKeywordPerformance.tab"
        text = spark.read.options(sep="\t", header=True).schema(schema).csv(path)
        found.append(text.withColumns({keyword: F.coalesce(F.col(f"`{keyword}`"), F.lit("")), "half": F.lit(i).cast("bigint")}))
    return found[0].unionByName(found[1])


@query
def archived_inputs(spark, sf_dir):
    """What a run leaves in its archive of two folders, whose files all have one name, read back: nothing replaced, nothing lost."""
    folder = new_path(spark, "landing")
    half = F.substring_index(F.trim("ip"), ".", -1).try_cast("int") % 2
    for i in (0, 1):
        for n, part in enumerate(_hit_parts(_hits(spark, sf_dir).where(half == i), f"{folder}/parts{i}")):
            files.move(spark, part, f"{folder}/half{i}/{n}/hits.tab")
    rules = RULES.but(fail_on_null_critical=False)
    pattern = "half*/*/hits.tab"
    run_batch(spark, read_hits(spark, f"{folder}/{pattern}", rules), f"{folder}/out", rules, Run(pattern, when=WHEN), archive=f"{folder}/kept")
    kept = read_hits(spark, f"{folder}/kept/{pattern}", rules)
    name = F.regexp_replace("source_file", r"^.*/(half\d)/\d+/(hits\.tab)$", "$1/$2")
    return kept.groupBy(name.alias("archived")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("hit_time_gmt").try_cast("bigint")).alias("time_sum"),
        F.sum(F.length("page_url")).alias("url_chars"),
    )


@query
def intake_registry(spark, sf_dir):
    """Names of user and day, recorded batch by batch, and which of those that arrive again are known."""
    events = _table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    names = events.select(
        F.concat(F.lit("phase"), F.col("user_id") % 3).alias("phase"),
        F.concat(F.lit("hits_"), F.col("user_id") % 500, F.lit("_"), day, F.lit("_000000.tab")).alias("file_name"),
        (F.col("user_id") % 10).cast("int").alias("batch"),
    ).distinct()
    out = new_path(spark, "registry")
    known = Registry(spark, f"{out}/registry", f"{out}/index", fold_every=2, merge=2)
    recorded = Staging(spark, "names")(names.withColumn("outcome", F.when(F.col("batch") == 3, "failed").otherwise("processed")))
    for b in range(9):
        recorded.where(F.col("batch") == b).select("phase", "file_name", "outcome").write.parquet(f"{out}/registry/batch_id={b}")
        known.fold(b)
    arriving = recorded.select("phase", "file_name").distinct()
    return manifest.already_processed(arriving, known.processed(arriving, 9).select("phase", "file_name").distinct())


@query
def malformed_bytes(spark, sf_dir):
    """Texts of one encoding read by their own and by another one: bytes that mean nothing there are replaced, the line stays whole."""
    hits = _hits(spark, sf_dir)
    marked = hits.withColumn("pagename", F.concat(F.lit("caf\u00e9 "), "pos.event_id", F.lit(" \u00fc")))
    folder = new_path(spark, "latin")
    marked.select(*HIT_COLUMNS).write.options(sep="\t", header=True, escape='"', emptyValue="", encoding="ISO-8859-1").csv(folder)
    read = {}
    for name, encoding in (("as_utf8", "UTF-8"), ("as_latin1", "ISO-8859-1")):
        rows = read_hits(spark, folder, RULES.but(file_encoding=encoding))
        read[name] = rows.select(F.regexp_extract("pagename", r"(\d+)", 1).cast("bigint").alias("event_id"), F.col("pagename").alias(name))
    return read["as_utf8"].join(read["as_latin1"], "event_id")


# -- quality -----------------------------------------------------------------


@query
def dq_schema(spark, sf_dir):
    rejects = quality.schema_rejects(_dirty(spark, sf_dir).drop("referrer", "geo_city"), RULES)
    return rejects.groupBy(F.col(quality.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def dq_null_counts(spark, sf_dir):
    return quality.null_counts(_dirty(spark, sf_dir))


@query
def dq_null_rates(spark, sf_dir):
    return quality.null_rate_warnings(_dirty(spark, sf_dir), RULES)


@query
def dq_null_rejects(spark, sf_dir):
    return _flat(quality.null_rejects(_dirty(spark, sf_dir), RULES))


@query
def dq_type_rejects(spark, sf_dir):
    return _flat(quality.type_rejects(_dirty(spark, sf_dir), RULES))


@query
def dq_dup_rejects(spark, sf_dir):
    return _flat(dedup.duplicate_rejects(_dirty(spark, sf_dir), RULES))


@query
def dq_errors(spark, sf_dir):
    errors = quality.error_rows(_dirty(spark, sf_dir), TYPED)
    return _flat(quality.masked_errors(errors, TYPED))


@query
def dq_summary(spark, sf_dir):
    return quality.summary(_dirty(spark, sf_dir), RULES)


@query
def dedup_hits(spark, sf_dir):
    return _flat(dedup.keep_first(_dirty(spark, sf_dir), RULES))


@query
def dedup_any(spark, sf_dir):
    survivors = dedup.keep_any(_dirty(spark, sf_dir), RULES)
    return survivors.select("hit_time_gmt", F.trim("ip").alias("ip"), "page_url")


@query
def dedup_count(spark, sf_dir):
    return dedup.duplicate_counts(_dirty(spark, sf_dir), RULES)


# -- filters and joins ---------------------------------------------------------


@query
def search_hits(spark, sf_dir):
    return _event(touches(_activity(spark, sf_dir)))


@query
def purchase_rows(spark, sf_dir):
    return _money(_event(purchases(_activity(spark, sf_dir))), "revenue")


@query
def first_touch(spark, sf_dir):
    return sessions.first_touch(_activity(spark, sf_dir))


@query
def attribute_revenue(spark, sf_dir):
    act = Staging(spark, "activity")(_activity(spark, sf_dir))
    return _money(_event(sessions.attribute_purchases(act, RULES)), "revenue")


@query
def attribute_revenue_prior_only(spark, sf_dir):
    rules = RULES.but(require_prior_touch=True)
    act = Staging(spark, "activity")(_activity(spark, sf_dir))
    return _money(_event(sessions.attribute_purchases(act, rules)), "revenue")


@query
def unattributed_purchases(spark, sf_dir):
    act = Staging(spark, "activity")(_activity(spark, sf_dir))
    return _money(_event(sessions.unattributed_purchases(act)), "revenue")


@query
def invoice_reconcile(spark, sf_dir):
    """Bills are derived from clicks and errors alike, so they differ from what was recorded."""
    events = _table(spark, sf_dir, "events")
    charged = events.where(F.col("event_type").isin("click", "error")).withColumn("event_type", F.lit("click"))
    billed = (
        touches(activity(hits_from_events(charged), RULES))
        .groupBy(F.when(F.col("domain") == "aol.com", F.lit("aol.de")).otherwise(F.col("domain")).alias("domain"), "keyword")
        .agg(F.count(F.lit(1)).alias("billed_clicks"))
    )
    return reports.reconcile_clicks(billed, _activity(spark, sf_dir))


# -- aggregates and models -------------------------------------------------------


def _revenue_of(spark, sf_dir, model: str) -> DataFrame:
    act = _activity(spark, sf_dir)
    stage = unstaged
    if model in models.MULTI_PASS:
        stage = Staging(spark, model)
        act = stage(act)
    return _money(models.keyword_revenue(models.credit(act, RULES, model=model, stage=stage), RULES), "revenue")


@query
def keyword_revenue(spark, sf_dir):
    return _revenue_of(spark, sf_dir, "first_touch")


@query
def last_touch(spark, sf_dir):
    return _revenue_of(spark, sf_dir, "last_touch")


@query
def linear_touch(spark, sf_dir):
    return _revenue_of(spark, sf_dir, "linear")


@query
def time_decay(spark, sf_dir):
    return _revenue_of(spark, sf_dir, "time_decay")


@query
def model_compare(spark, sf_dir):
    stage = Staging(spark, "compare")
    return models.compare_models(stage(_activity(spark, sf_dir)), RULES, stage=stage)


@query
def keyword_revenue_named(spark, sf_dir):
    rules = RULES.but(output_columns=("engine", "term", "income"), sort_ascending=True)
    return reports.keyword_report(_hits(spark, sf_dir), rules)


@query
def keyword_clicks(spark, sf_dir):
    return reports.keyword_clicks(_activity(spark, sf_dir))


@query
def keyword_sessions(spark, sf_dir):
    return reports.keyword_sessions(_activity(spark, sf_dir))


@query
def keyword_conversions(spark, sf_dir):
    return reports.keyword_conversions(_activity(spark, sf_dir))


@query
def run_totals(spark, sf_dir):
    return reports.run_totals(_activity(spark, sf_dir), RULES)


@query
def shared_session_keys(spark, sf_dir):
    padded = F.when(F.col("pos.event_id") % 7 == 0, F.concat(F.lit(" "), F.col("ip"), F.lit(" "))).otherwise(F.col("ip"))
    return reports.shared_session_keys(_dirty(spark, sf_dir).withColumn("ip", padded))


# -- reports -------------------------------------------------------------------


@query
def keyword_report(spark, sf_dir):
    return reports.keyword_report(_hits(spark, sf_dir), RULES)


@query
def keyword_report_custom_rules(spark, sf_dir):
    return reports.keyword_report(_hits(spark, sf_dir), CUSTOM)


@query
def sem_insights(spark, sf_dir):
    return reports.sem_insights(_hits(spark, sf_dir), RULES, "2024-02-01 12:00:00 UTC", "run-1")


# -- sinks: what was written, read back ------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> tuple[dict, str]:
    out = new_path(spark, "run")
    run = Run("raw/phase2/hits_20240131_000000.tab", "phase2", "run-0001", WHEN)
    return run_batch(spark, _dirty(spark, sf_dir), out, LENIENT, run), out


@query
def report_file(spark, sf_dir):
    summary, _ = _run(spark, sf_dir)
    schema = StructType([StructField(c, StringType()) for c in RULES.output_columns])
    tab = spark.read.options(sep="\t", header=True).schema(schema).csv(summary["output_file"])
    keyword = RULES.output_columns[1]
    return tab.withColumn(keyword, F.coalesce(F.col(f"`{keyword}`"), F.lit("")))


@query
def error_files(spark, sf_dir):
    _, out = _run(spark, sf_dir)
    stored = spark.read.options(header=True).csv(f"{out}/dq-errors/2024/02/01/*_errors.csv")
    return stored.groupBy(F.col(quality.REASON).alias("reason"), "ip").agg(F.count(F.lit(1)).alias("row_count"))


@query
def quality_report_file(spark, sf_dir):
    _, out = _run(spark, sf_dir)
    report = spark.read.schema(outputs.QUALITY_SCHEMA).json(f"{out}/dq-reports/2024/02/01/*_dq_report.json")
    checks = report.select("overall_passed", "rows_in", "rows_out", "error_count", F.inline("checks"))
    return checks.select(
        "overall_passed",
        "rows_in",
        "rows_out",
        "error_count",
        F.col("check").alias("check_name"),
        "passed",
        "critical_failures",
        "duplicate_count",
        "rows_before",
        "rows_after",
    )


@query
def lineage_file(spark, sf_dir):
    _, out = _run(spark, sf_dir)
    record = spark.read.schema(outputs.LINEAGE_SCHEMA).json(f"{out}/lineage/2024-02-01/run-0001.json")
    return record.select("run_id", "input_file", "input_rows", "output_rows", "engine_used", "dq_passed", "attribution_model", "status")


@query
def sem_report_file(spark, sf_dir):
    out = new_path(spark, "sem")
    summary = run_sem(spark, _hits(spark, sf_dir), out, RULES, Run("hits.tab", run_id="run-1", when=WHEN))
    stored = spark.read.options(header=True).csv(summary["output_file"])
    numbers = {c: F.col(c).cast("bigint") for c in ("total_clicks", "unique_sessions", "converting_sessions")}
    numbers |= {c: F.col(c).cast("double") for c in ("total_revenue", "conversion_rate", "revenue_per_click", "avg_order_value")}
    return stored.withColumns(numbers)


@query
def partitioned_parquet(spark, sf_dir):
    report = models.keyword_revenue(models.credit(_activity(spark, sf_dir), RULES), RULES)
    out = new_path(spark, "processed")
    outputs.write_partitioned(outputs.with_day(report, WHEN, "phase2"), out, ["phase", "year", "month", "day"])
    schema = "domain string, keyword string, revenue decimal(38,2), phase string, year string, month string, day string"
    return _money(spark.read.schema(schema).parquet(out).where("phase = 'phase2' AND month = '02'"), "revenue")
