"""Attribution models: who gets the revenue.

Every model maps activity to credit rows ``(scope..., domain, keyword,
revenue)``.  ``first_touch`` and ``linear`` credit all counted purchases of a
session, also those before its first touch; ``last_touch`` and ``time_decay``
look only at touches at or before the purchase.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.operators.activity import is_counted, is_touch, keyed
from clicktrail.operators.sessions import attribute_purchases, session_summary
from clicktrail.operators.spread import SALT, join_spread, salt_of, salt_set
from clicktrail.operators.timeline import CREDIT, last_touch_credit, time_decay_credit
from clicktrail.rules import MODELS, Rules
from clicktrail.session import unstaged

# Models that read the activity more than once.
MULTI_PASS = ("linear", "time_decay")


def first_touch_credit(act: DataFrame, rules: Rules, scope: Sequence[str] = ()) -> DataFrame:
    """All revenue of a session to its first touch: one aggregation, no join."""
    if rules.require_prior_touch:
        return attribute_purchases(act, rules, scope)
    sessions = session_summary(act, scope)
    return sessions.where(is_touch() & is_counted()).select(*scope, "session", "domain", "keyword", "revenue")


def linear_credit(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Revenue of a session split evenly over all its touches, in exact decimals."""
    keys = keyed(scope)
    salted = act.withColumn(SALT, F.when(is_touch(), salt_of(F.col("domain"), F.col("keyword"))))
    totals = (
        salted.groupBy(*keys)
        .agg(F.sum("revenue").alias("total"), F.count_if(is_touch()).alias("n"), salt_set(F.col(SALT)))
        .where((F.col("n") > 0) & F.col("total").isNotNull())
    )
    counts = (
        salted.where(is_touch())
        .groupBy(*keys, SALT, "domain", "keyword")
        .agg(F.count(F.lit(1)).alias("touches"))
    )
    share = F.col("total").cast("decimal(20,6)") * F.col("touches").cast("decimal(12,0)") / F.col("n").cast("decimal(12,0)")
    return join_spread(counts, totals, keys).select(*keys, "domain", "keyword", share.cast(CREDIT).alias("revenue"))


def credit(
    act: DataFrame,
    rules: Rules,
    scope: Sequence[str] = (),
    model: str | None = None,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
    last: DataFrame | None = None,
) -> DataFrame:
    """Credit rows of one model, by default the one the rules name.

    ``first_touch`` and ``last_touch`` read the activity once; ``linear`` reads
    it twice and ``time_decay`` twice, plus its own per-second tables.  ``last``
    is the credit of ``last_touch`` where the caller has it already.
    """
    model = model or rules.attribution_model
    if model == "first_touch":
        return first_touch_credit(act, rules, scope)
    if model == "last_touch":
        return last if last is not None else last_touch_credit(act, scope)
    if model == "linear":
        return linear_credit(act, scope)
    if model == "time_decay":
        return time_decay_credit(act, rules.half_life_seconds, scope, stage, last)
    raise ValueError(f"unknown attribution model {model!r}")


def keyword_revenue(credits: DataFrame, rules: Rules, scope: Sequence[str] = ()) -> DataFrame:
    """Revenue per keyword, rounded; keywords at or below the threshold are left out."""
    return (
        credits.groupBy(*scope, "domain", "keyword")
        .agg(F.round(F.sum("revenue"), rules.revenue_decimal_places).alias("revenue"))
        .where(F.col("revenue") > F.lit(rules.min_revenue_threshold).cast("decimal(38,6)"))
    )


def compare_models(
    act: DataFrame,
    rules: Rules,
    scope: Sequence[str] = (),
    models: Sequence[str] = MODELS,
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> DataFrame:
    """One row per keyword with one revenue column per model (0 where a model gives it nothing)."""
    # Two models start from the last touches; they are looked up once.
    last = stage(last_touch_credit(act, scope)) if {"last_touch", "time_decay"} <= set(models) else None
    parts = [
        keyword_revenue(credit(act, rules, scope, m, stage, last), rules, scope).withColumn("model", F.lit(m))
        for m in models
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    per_model = [
        F.coalesce(F.sum(F.when(F.col("model") == m, F.col("revenue"))), F.lit(0)).cast("double").alias(m) for m in models
    ]
    return stacked.groupBy(*scope, "domain", "keyword").agg(*per_model)
