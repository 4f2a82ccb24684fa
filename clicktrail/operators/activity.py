"""The narrow projection every report starts from.

``activity`` keeps only hits that matter for attribution - search touches and
purchases - and only their parsed values.  Column pruning then reads six input
columns, and everything after it moves a few dozen bytes per row.

Columns: the scope columns, ``session``, ``ts`` (epoch seconds or NULL),
``pos`` (arrival order, unique), ``domain`` and ``keyword`` (NULL unless the
hit is a touch), ``is_purchase``, ``revenue`` (NULL unless the purchase counts
towards revenue).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.commerce import epoch_seconds, has_purchase, product_revenue
from clicktrail.functions.text import is_missing, stripped
from clicktrail.functions.urls import search_touch
from clicktrail.rules import Rules

TIME_LAST = 2**63 - 1


def is_touch() -> Column:
    return F.col("domain").isNotNull()


def is_counted() -> Column:
    return F.col("revenue").isNotNull()


def touch_order() -> Column:
    """Chronological order with hits of unknown time last."""
    return F.struct(F.coalesce(F.col("ts"), F.lit(TIME_LAST)).alias("ts"), F.col("pos").alias("pos"))


def keyed(scope: Sequence[str]) -> list[str]:
    return [*scope, "session"]


def parsed(hits: DataFrame, rules: Rules, scope: Sequence[str] = (), blank_keyword: str = "keep") -> DataFrame:
    """One parsed row per hit; nothing is filtered."""
    purchase = has_purchase(F.col("event_list"), rules)
    counts = purchase & ~is_missing(F.col("product_list"))
    # Two steps, so that each expensive expression is written - and evaluated - once.
    step = hits.select(
        *scope,
        stripped(F.col(rules.session_key_column)).alias("session"),
        epoch_seconds(F.col("hit_time_gmt")).alias("ts"),
        F.col("pos"),
        search_touch(F.col("referrer"), rules, blank_keyword).alias("_touch"),
        purchase.alias("is_purchase"),
        F.when(counts, product_revenue(F.col("product_list"), rules)).alias("_revenue"),
    )
    return step.select(
        *keyed(scope),
        "ts",
        "pos",
        F.col("_touch.domain").alias("domain"),
        F.col("_touch.keyword").alias("keyword"),
        "is_purchase",
        F.when(F.col("_revenue") > F.lit(rules.min_revenue_threshold).cast("decimal(38,6)"), F.col("_revenue")).alias(
            "revenue"
        ),
    )


def activity(hits: DataFrame, rules: Rules, scope: Sequence[str] = (), blank_keyword: str = "keep") -> DataFrame:
    return relevant(parsed(hits, rules, scope, blank_keyword))


def relevant(rows: DataFrame) -> DataFrame:
    """Touches and purchases of hits that have a session key."""
    return rows.where((F.col("is_purchase") | is_touch()) & (F.col("session") != ""))


def touches(act: DataFrame) -> DataFrame:
    return act.where(is_touch()).drop("is_purchase", "revenue")


def purchases(act: DataFrame) -> DataFrame:
    return act.where(is_counted()).drop("domain", "keyword", "is_purchase")
