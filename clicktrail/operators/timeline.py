"""Time-aware credit: last touch before a purchase, and decaying shares.

Both work on seconds, not on hits.  All touches and purchases of a session in
the same second are merged first (with map-side combine), so the number of
rows per session depends on the calendar and not on the traffic.  Windows then
run over one session *and* one stretch of time:

* as-of lookup: stretch = day, at most 86,400 rows, plus one window over the
  days of a session;
* decay: stretch = ``STRETCH`` half-lives and at least a day, plus one window
  over the stretches near each stretch of a session: what lies further away has
  faded to less than the smallest double.

Hits without a usable time cannot be ordered and take no part here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.operators.activity import is_touch, keyed
from clicktrail.operators.spread import SALT, SALT_SET, join_spread, salt_of, salt_set
from clicktrail.session import unstaged

DAY = 86400
STRETCH = 8
CREDIT = "decimal(38,11)"


def _seconds(act: DataFrame, scope: Sequence[str]) -> DataFrame:
    """One row per session and second: its last touch and its counted revenue."""
    seconds = (
        act.where(F.col("ts").isNotNull())
        .groupBy(*keyed(scope), "ts")
        .agg(
            F.max_by(F.struct("ts", "domain", "keyword"), F.when(is_touch(), F.col("pos"))).alias("touch"),
            F.sum("revenue").alias("revenue"),
        )
        .withColumn("day", F.expr(f"ts div {DAY}"))
    )
    # States what the join below would infer for each side in its own way; with
    # both sides alike, their scan and shuffle are done once and reused.
    for key in [*keyed(scope), "day"]:
        seconds = seconds.where(F.col(key).isNotNull())
    return seconds


def last_touch_credit(act: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Revenue per session and second, with the last touch at or before that second.

    A touch in the same second as the purchase counts as before it.
    """
    keys = keyed(scope)
    seconds = _seconds(act, scope)
    in_day = Window.partitionBy(*keys, "day").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier_days = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)

    days = (
        seconds.groupBy(*keys, "day")
        .agg(
            F.max_by("touch", F.when(F.col("touch").isNotNull(), F.col("ts"))).alias("touch"),
            F.count("revenue").alias("_bought"),
        )
        .select(*keys, "day", "_bought", F.last("touch", ignorenulls=True).over(earlier_days).alias("carried"))
        .where(F.col("_bought") > 0)
    )
    bought = seconds.withColumn("today", F.last("touch", ignorenulls=True).over(in_day)).where(
        F.col("revenue").isNotNull()
    )
    return (
        bought.join(days, [*keys, "day"])
        .select(*keys, "ts", "revenue", F.coalesce("today", "carried").alias("touch"))
        .where(F.col("touch").isNotNull())
        .select(
            *keys,
            F.col("ts").alias("purchase_ts"),
            F.col("touch.ts").alias("touch_ts"),
            F.col("touch.domain").alias("domain"),
            F.col("touch.keyword").alias("keyword"),
            "revenue",
        )
    )


# Halvings after which any total is zero as a double.
NOTHING_LEFT = 2200


def _faded(stretches: Column, own: Column, fade: float, ahead: bool) -> Column:
    """Sum of the totals of other stretches, each halved ``fade`` times per stretch between."""

    def distance(s: Column) -> Column:
        return s["stretch"] - own if ahead else own - s["stretch"]

    return F.aggregate(stretches, F.lit(0.0), lambda total, s: total + s["total"] * F.pow(F.lit(2.0), F.lit(-fade) * distance(s)))


def _running(rows: DataFrame, keys: Sequence[str], value: Column, fade: float, ahead: bool) -> DataFrame:
    """Add ``running``: the sum of ``value`` up to this second (or from it on, when ``ahead``),
    over the whole session, scaled to the row's own stretch."""
    order = F.col("ts").desc() if ahead else F.col("ts").asc()
    within = Window.partitionBy(*keys, "stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valued = rows.withColumn("_value", value)
    far = int(NOTHING_LEFT / fade) + 1
    near = Window.partitionBy(*keys).orderBy("stretch").rangeBetween(*((1, far) if ahead else (-far, -1)))
    totals = (
        valued.groupBy(*keys, "stretch")
        .agg(F.sum("_value").alias("total"))
        .withColumn("_all", F.collect_list(F.struct("stretch", "total")).over(near))
        .select(*keys, "stretch", _faded(F.col("_all"), F.col("stretch"), fade, ahead).alias("_carried"))
    )
    return (
        valued.withColumn("_within", F.sum("_value").over(within))
        .join(totals, [*keys, "stretch"])
        .withColumn("running", F.col("_carried") + F.col("_within"))
        .drop("_value", "_within", "_carried")
    )


def time_decay_credit(
    act: DataFrame,
    half_life: int,
    scope: Sequence[str] = (),
    stage: Callable[[DataFrame], DataFrame] = unstaged,
    last: DataFrame | None = None,
) -> DataFrame:
    """Split each purchase over the touches at or before it, halving per ``half_life`` seconds of age.

    Weights are normalised per purchase, so only the ages relative to the last
    touch matter: revenue is first moved to its last touch's second.  With
    touches at t and revenue R(t) moved there,

        D(t) = sum over u <= t of touches(u) * 2^((u - t) / half_life)
        S(t) = sum over u >= t of R(u) / D(u) * 2^((t - u) / half_life)

    every touch at t earns S(t).  Both sums are running totals, so no
    touch-purchase pairs are ever formed.  They are taken relative to the start
    of a stretch, which keeps the powers in range however long the history is.

    ``stage`` is applied to the small per-second tables that are read twice;
    ``last`` is the result of :func:`last_touch_credit` where the caller has it.
    The sums are doubles, so a keyword's revenue is exact to about 15 digits.
    """
    keys = keyed(scope)
    stretch = max(STRETCH * half_life, DAY)
    fade = stretch / half_life
    x = (F.col("ts") - F.col("stretch") * F.lit(stretch)) / F.lit(float(half_life))
    up, down = F.pow(F.lit(2.0), x), F.pow(F.lit(2.0), -x)

    counts = stage(
        act.where(is_touch() & F.col("ts").isNotNull())
        .withColumn(SALT, salt_of(F.col("domain"), F.col("keyword")))
        .groupBy(*keys, "ts", SALT, "domain", "keyword")
        .agg(F.count(F.lit(1)).alias("touches"))
    )
    touched = counts.groupBy(*keys, "ts").agg(F.sum("touches").alias("touches"), salt_set(F.col(SALT)))
    moved = (
        (last if last is not None else last_touch_credit(act, scope))
        .groupBy(*keys, F.col("touch_ts").alias("ts"))
        .agg(F.sum("revenue").cast("double").alias("moved"))
    )
    line = stage(
        touched.join(moved, [*keys, "ts"], "left")
        .withColumn("moved", F.coalesce("moved", F.lit(0.0)))
        .withColumn("stretch", F.expr(f"ts div {stretch}"))
    )
    line = stage(
        _running(line, keys, F.col("touches") * up, fade, ahead=False)
        .withColumn("_share", F.col("moved") / (F.col("running") * down))
        .drop("running")
    )
    line = _running(line, keys, F.col("_share") * down, fade, ahead=True).select(
        *keys, "ts", SALT_SET, (F.col("running") * up).alias("per_touch")
    )
    return join_spread(counts, line, [*keys, "ts"]).select(
        *keys,
        "domain",
        "keyword",
        F.round(F.col("touches") * F.col("per_touch"), 11).cast(CREDIT).alias("revenue"),
    )
