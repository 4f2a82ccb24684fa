"""User-level reports over hits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.commerce import ratio, revenue_text
from clicktrail.functions.text import stripped
from clicktrail.operators.activity import activity, is_touch, touch_order, touches
from clicktrail.operators.sessions import first_touch, session_summary
from clicktrail.plans.models import MULTI_PASS, credit, keyword_revenue
from clicktrail.rules import Rules
from clicktrail.session import Staging, unstaged


def named_report(revenue: DataFrame, rules: Rules, scope: Sequence[str] = (), ordered: bool = True) -> DataFrame:
    """Final column names and, unless the caller has seen to it, order; ties are broken by domain and keyword."""
    by_revenue = F.col("revenue").asc() if rules.sort_ascending else F.col("revenue").desc()
    domain_name, keyword_name, revenue_name = rules.output_columns
    ranked = revenue.orderBy(*scope, by_revenue, "domain", "keyword") if ordered else revenue
    return ranked.select(
        *scope,
        F.col("domain").alias(domain_name),
        F.col("keyword").alias(keyword_name),
        F.col("revenue").cast("double").alias(revenue_name),
    )


def report_of(
    act: DataFrame,
    rules: Rules,
    scope: Sequence[str] = (),
    model: str | None = None,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> DataFrame:
    return named_report(keyword_revenue(credit(act, rules, scope, model, stage), rules, scope), rules, scope)


def keyword_report(
    hits: DataFrame,
    rules: Rules = Rules(),
    scope: Sequence[str] = (),
    model: str | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Revenue by search domain and keyword, best first.

    With the default model: one scan, one map-side combined aggregation per
    session, one per keyword, one sort of the report.  For models that read the
    activity more than once it is staged first, so that hits are parsed once.
    """
    act = activity(hits, rules, scope)
    if (model or rules.attribution_model) not in MULTI_PASS:
        return report_of(act, rules, scope, model)
    stage = stage or Staging(hits.sparkSession, "report")
    return report_of(stage(act), rules, scope, model, stage)


def report_as_text(report: DataFrame, rules: Rules) -> DataFrame:
    name = rules.output_columns[2]
    return report.withColumn(name, revenue_text(F.col(f"`{name}`"), rules.revenue_decimal_places))


def _keyword_funnel(act: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Clicks, sessions, converting sessions and revenue per keyword in one scan.

    A touch counts twice: for its own keyword (clicks) and for its session.
    Instead of scanning twice and joining, each touch is emitted once in each
    role, and one aggregation keyed by role handles both: click rows are keyed
    by keyword, session rows by session.
    """
    click = F.col("_is_click")
    roles = F.when(is_touch(), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    rows = act.select("*", F.explode(roles).alias("_is_click"))
    combined = rows.groupBy(
        *scope,
        F.when(~click, F.col("session")).alias("session"),
        F.when(click, F.col("domain")).alias("click_domain"),
        F.when(click, F.col("keyword")).alias("click_keyword"),
    ).agg(
        F.count_if(click).alias("clicks"),
        F.min_by(F.struct("domain", "keyword"), F.when(~click & is_touch(), touch_order())).alias("first"),
        F.max(~click & F.col("is_purchase")).alias("converted"),
        F.sum(F.when(~click, F.col("revenue"))).alias("revenue"),
    )
    has_first = F.col("first").isNotNull()
    return (
        combined.where(F.col("click_domain").isNotNull() | has_first)
        .groupBy(
            *scope,
            F.coalesce("click_domain", "first.domain").alias("domain"),
            F.coalesce("click_keyword", "first.keyword").alias("keyword"),
        )
        .agg(
            F.sum("clicks").alias("clicks"),
            F.count_if(has_first).alias("sessions"),
            F.count_if(has_first & F.col("converted")).alias("converting"),
            F.round(F.coalesce(F.sum("revenue"), F.lit(0)), 2).alias("revenue"),
        )
    )


def sem_insights(hits: DataFrame, rules: Rules = Rules(), run_date: str = "", run_id: str = "", scope: Sequence[str] = ()) -> DataFrame:
    """Keyword funnel: clicks, sessions, conversions, revenue and their ratios.

    Keywords without revenue stay in, and every purchase event counts,
    whatever it earned.
    """
    every_purchase = rules.but(min_revenue_threshold=-(10.0**14))
    funnel = _keyword_funnel(activity(hits, every_purchase, scope, blank_keyword="skip"), scope)
    sessions, converting = F.col("sessions"), F.col("converting")
    return funnel.orderBy(*scope, F.col("revenue").desc(), "domain", "keyword").select(
        *scope,
        F.col("domain").alias("search_engine_domain"),
        F.col("keyword").alias("search_keyword"),
        F.col("clicks").alias("total_clicks"),
        sessions.alias("unique_sessions"),
        converting.alias("converting_sessions"),
        F.col("revenue").cast("double").alias("total_revenue"),
        ratio(converting.cast("decimal(18,0)") * 100, sessions.cast("decimal(18,0)")).cast("double").alias("conversion_rate"),
        ratio(F.col("revenue"), F.col("clicks").cast("decimal(18,0)")).cast("double").alias("revenue_per_click"),
        ratio(F.col("revenue"), converting.cast("decimal(18,0)")).cast("double").alias("avg_order_value"),
        F.lit(run_date).alias("run_date"),
        F.lit(run_id).alias("run_id"),
    )


def keyword_clicks(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every search touch counts as a click."""
    return touches(act).groupBy(*scope, "domain", "keyword").agg(F.count(F.lit(1)).alias("clicks"))


def keyword_sessions(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Sessions by the keyword of their first touch."""
    return first_touch(act, scope).groupBy(*scope, "domain", "keyword").agg(F.count(F.lit(1)).alias("sessions"))


def keyword_conversions(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Sessions with a purchase event, by the keyword of their first touch."""
    return (
        session_summary(act, scope)
        .where(is_touch() & (F.col("purchase_events") > 0))
        .groupBy(*scope, "domain", "keyword")
        .agg(F.count(F.lit(1)).alias("converting_sessions"))
    )


def run_totals(act: DataFrame, rules: Rules, scope: Sequence[str] = ()) -> DataFrame:
    """Control totals: all counted revenue, and how much of it found a keyword."""
    found = is_touch()
    return (
        session_summary(act, scope)
        .groupBy(*scope)
        .agg(
            F.count_if(found).alias("search_sessions"),
            F.coalesce(F.sum("touches"), F.lit(0)).alias("touches"),
            F.coalesce(F.sum("purchases"), F.lit(0)).alias("purchases"),
            F.coalesce(F.sum(F.when(found, F.col("purchases"))), F.lit(0)).alias("attributed_purchases"),
            F.round(F.coalesce(F.sum("revenue"), F.lit(0)), rules.revenue_decimal_places).cast("double").alias("revenue"),
            F.round(F.coalesce(F.sum(F.when(found, F.col("revenue"))), F.lit(0)), rules.revenue_decimal_places)
            .cast("double")
            .alias("attributed_revenue"),
        )
    )


def shared_session_keys(hits: DataFrame, rules: Rules = Rules(), scope: Sequence[str] = ()) -> DataFrame:
    """Session keys used with more than one user agent: visitors that may have been merged.

    Keys are trimmed as sessions are, and hits without one are no session.
    """
    session = stripped(F.col(rules.session_key_column))
    return (
        hits.select(*scope, session.alias("session"), "user_agent")
        .where(F.col("session") != "")
        .groupBy(*scope, "session")
        .agg(F.count_distinct("user_agent").alias("user_agents"))
        .where(F.col("user_agents") > 1)
    )


def shared_session_count(hits: DataFrame, rules: Rules = Rules(), scope: Sequence[str] = ()) -> DataFrame:
    """How many session keys are shared, per scope as ``count``: one shuffle of a key and two hashes.

    A key has several agents if the least and the greatest hash of them differ.
    """
    session = stripped(F.col(rules.session_key_column))
    agent = F.when(F.col("user_agent").isNotNull(), F.xxhash64("user_agent"))
    return (
        hits.select(*scope, session.alias("session"), agent.alias("agent"))
        .where(F.col("session") != "")
        .groupBy(*scope, "session")
        .agg(F.min("agent").alias("low"), F.max("agent").alias("high"))
        .where(F.col("low") < F.col("high"))
        .groupBy(*scope)
        .count()
    )


def reconcile_clicks(billed: DataFrame, act: DataFrame) -> DataFrame:
    """Clicks an ad platform billed ``(domain, keyword, billed_clicks)`` against what was recorded.

    Both sides are one row per keyword before they meet.
    """
    recorded = _keyword_funnel(act, ()).select("domain", "keyword", "clicks", "sessions")
    invoice = billed.groupBy("domain", "keyword").agg(F.sum("billed_clicks").alias("billed_clicks"))
    count = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("billed_clicks", "clicks", "sessions")}
    return invoice.join(recorded, ["domain", "keyword"], "full_outer").select(
        "domain",
        "keyword",
        count["billed_clicks"].alias("billed_clicks"),
        count["clicks"].alias("recorded_clicks"),
        count["sessions"].alias("recorded_sessions"),
        (count["billed_clicks"] - count["sessions"]).alias("discrepancy"),
    )
