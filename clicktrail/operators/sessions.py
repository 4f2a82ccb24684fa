"""Per-session facts, built with mergeable aggregates.

No window runs over the hits of a session: ``min_by`` and the sums combine on
the map side first, so a session shared by a third of all traffic arrives at
its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.operators.activity import is_counted, is_touch, keyed, purchases, touch_order
from clicktrail.operators.spread import hot_keys, join_spread, salted, with_salts
from clicktrail.rules import Rules
from clicktrail.session import Staging


def first_by_time() -> Column:
    """Aggregate: the earliest touch of the group."""
    return F.min_by(F.struct("domain", "keyword"), F.when(is_touch(), touch_order()))


def session_summary(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per session: first touch (or NULL), touches, purchases, revenue."""
    return (
        act.groupBy(*keyed(scope))
        .agg(
            first_by_time().alias("_first"),
            F.min(F.when(is_touch(), F.col("ts"))).alias("first_ts"),
            F.count_if(is_touch()).alias("touches"),
            F.count_if("is_purchase").alias("purchase_events"),
            F.count_if(is_counted()).alias("purchases"),
            F.sum("revenue").alias("revenue"),
        )
        .select(*keyed(scope), "_first.domain", "_first.keyword", "first_ts", "touches", "purchase_events", "purchases", "revenue")
    )


def first_touch(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Session map: every session with a search touch and its earliest one."""
    return (
        act.where(is_touch())
        .groupBy(*keyed(scope))
        .agg(first_by_time().alias("_first"))
        .select(*keyed(scope), "_first.domain", "_first.keyword")
    )


def _purchases_with_sessions(act: DataFrame, scope: Sequence[str], how: str) -> DataFrame:
    keys = keyed(scope)
    sessions = Staging(act.sparkSession, "sessions")(
        act.groupBy(*keys).agg(
            first_by_time().alias("_first"),
            F.min(F.when(is_touch(), F.col("ts"))).alias("first_ts"),
            F.count_if(is_counted()).alias("_bought"),
        )
    )
    # Also sessions without a touch can be hot, where rows without a partner are looked for.
    hot = hot_keys(sessions, keys, "_bought")
    one = sessions.where(F.col("_first").isNotNull()).select(*keys, "_first.domain", "_first.keyword", "first_ts")
    return join_spread(salted(purchases(act), keys, hot, F.col("pos")), with_salts(one, keys, hot), keys, how)


def attribute_purchases(act: DataFrame, rules: Rules, scope: Sequence[str] = ()) -> DataFrame:
    """Every counted purchase of a session that has a touch, with that session's first touch."""
    rows = _purchases_with_sessions(act, scope, "inner")
    if rules.require_prior_touch:
        rows = rows.where(F.col("first_ts") <= F.col("ts"))
    return rows.select(*keyed(scope), "ts", "pos", "revenue", "domain", "keyword")


def unattributed_purchases(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The complement: counted purchases of sessions without any touch."""
    return _purchases_with_sessions(act, scope, "left_anti").select(*keyed(scope), "ts", "pos", "revenue")
