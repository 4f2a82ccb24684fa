"""One session, keyword or second with most of the rows: results stay whole and rows stay spread."""

import pytest
from pyspark.sql import functions as F

from clicktrail.operators.activity import activity
from clicktrail.operators.sessions import attribute_purchases, unattributed_purchases
from clicktrail.operators.spread import HOT_KEYS, SALT_SET, SALTS, hot_keys, join_spread, salt_of, salt_set, salted, with_salts
from clicktrail.plans.models import credit, keyword_revenue
from clicktrail.plans.reports import keyword_report, sem_insights
from clicktrail.rules import Rules
from tests.fixtures import frame, rows_of, sale, search

RULES = Rules()


@pytest.fixture
def no_help(spark):
    """No broadcast and no adaptive splitting: the plan must cope by itself."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def spread_of(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def nat_hits(n):
    """A third searches, a third purchases, all by one visitor, and a few others."""
    rows = [search(i, "nat", f"k{i % 97}") for i in range(n)] + [sale(n + i, "nat", 2) for i in range(n)]
    return rows + [search(1, "other", "x"), sale(2, "other", 5), sale(2, "direct", 7)]


def test_rows_of_a_hot_session_are_joined_in_many_tasks(spark, no_help):
    act = activity(frame(spark, nat_hits(300), 4), RULES)
    joined = attribute_purchases(act, RULES)
    sizes = spread_of(joined)
    assert sum(sizes) == 301 and max(sizes) < 150
    assert rows_of(unattributed_purchases(act).select("session", "revenue")) == [("direct", 7.0)]


def test_a_session_arrives_at_its_reducer_as_one_row_per_task(spark, no_help):
    hits = frame(spark, nat_hits(300), 4)
    for report in (keyword_report(hits), sem_insights(hits)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        below_first_shuffle = plan.split("Exchange hashpartitioning")[-1]
        assert "partial_min_by" in below_first_shuffle and "Join" not in plan
    assert rows_of(keyword_report(hits)) == [("google.com", "k0", 600.0), ("google.com", "x", 5.0)]


@pytest.mark.parametrize("model, total", [("last_touch", 605.0), ("linear", 605.0), ("time_decay", 605.0)])
def test_models_with_a_hot_session(spark, no_help, model, total):
    act = activity(frame(spark, nat_hits(300), 4), RULES)
    got = keyword_revenue(credit(act, RULES, model=model), RULES).collect()
    assert sum(float(r["revenue"]) for r in got) == pytest.approx(total, abs=0.6)


def test_everything_in_one_second(spark, no_help):
    rows = [search(5, "nat", f"k{i}") for i in range(200)] + [sale(5, "nat", 1) for _ in range(200)]
    act = activity(frame(spark, rows, 4), RULES)
    for model in ("linear", "time_decay"):
        got = keyword_revenue(credit(act, RULES, model=model), RULES).collect()
        assert len(got) == 200 and {float(r["revenue"]) for r in got} == {1.0}
    assert rows_of(keyword_revenue(credit(act, RULES, model="last_touch"), RULES)) == [("google.com", "k199", 200.0)]


def test_salts_repeat_the_single_side_only_as_needed(spark):
    many = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, F.lit("hot")).otherwise(F.col("id").cast("string")))
    many = many.withColumn("_salt", salt_of(F.col("id")))
    one = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"), salt_set(F.col("_salt")))
    sizes = {r["k"]: (r["n"], r["s"]) for r in one.select("k", "n", F.size(SALT_SET).alias("s")).collect()}
    assert sizes["hot"][1] <= min(SALTS, 900) and sizes["950"] == (1, 1)
    joined = join_spread(many, one, ["k"])
    assert joined.count() == 1000 and joined.where("k = 'hot'").agg(F.max("n")).first()[0] == 900
    assert join_spread(many, one.where("k = 'hot'"), ["k"], "left_anti").count() == 100


def test_last_touch_reads_its_input_once(spark, no_help, tmp_path):
    frame(spark, nat_hits(5)).write.parquet(str(tmp_path / "h"))
    act = activity(spark.read.parquet(str(tmp_path / "h")), RULES)
    plan = credit(act, RULES, model="last_touch")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def one_and_hot(spark, counts):
    one = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(counts)], "session string, bought long")
    return one, hot_keys(one, ["session"], "bought")


@pytest.mark.parametrize("counts", [[7] * 1500, [1] * 40_000, [1_000_000] + [1] * 3000, [5_000, 3_000, 2_000] * 50, [3]])
def test_salts_are_in_proportion(spark, counts):
    one, hot = one_and_hot(spark, counts)
    salts = with_salts(one, ["session"], hot).select("bought", F.size(SALT_SET).alias("n")).collect()
    assert sum(r["n"] for r in salts) <= len(counts) + HOT_KEYS
    assert all(r["bought"] / r["n"] <= max(1, sum(counts) / HOT_KEYS) for r in salts)


def test_salted_joins_lose_and_repeat_nothing(spark, no_help):
    counts = [400, 1, 60, 3, 1, 900]
    one, hot = one_and_hot(spark, counts)
    many = one.withColumn("k", F.explode(F.expr("sequence(1L, bought)"))).select("session", "k")
    kept = one.where("session != 's2'")
    joined = join_spread(salted(many, ["session"], hot, F.col("k")), with_salts(kept, ["session"], hot), ["session"])
    assert {r["session"]: r["count"] for r in joined.groupBy("session").count().collect()} == {f"s{i}": n for i, n in enumerate(counts) if i != 2}
    rest = join_spread(salted(many, ["session"], hot, F.col("k")), with_salts(kept, ["session"], hot), ["session"], "left_anti")
    assert rest.count() == 60
    assert max(spread_of(joined)) < 900
