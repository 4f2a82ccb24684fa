import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clicktrail.operators import dedup, quality
from clicktrail.rules import HIT_COLUMNS, Rules
from tests.fixtures import frame, hit

RULES = Rules()


def reasons(df):
    return Counter(r[quality.REASON] for r in df.collect())


def test_schema_check(spark):
    hits = frame(spark, [hit(1, "a"), hit(2, "b")])
    assert quality.check_schema(hits, RULES) == {
        "check": "schema_validation",
        "passed": True,
        "missing": [],
        "actual_columns": list(HIT_COLUMNS),
    }
    assert quality.schema_rejects(hits, RULES).count() == 0
    short = hits.drop("referrer", "ip")
    assert quality.check_schema(short, RULES)["missing"] == ["ip", "referrer"]
    assert reasons(quality.schema_rejects(short, RULES)) == {"schema_error: missing columns ['ip', 'referrer']": 2}


def test_a_row_is_rejected_once_per_blank_column(spark):
    rows = [hit(1, "", referrer=" "), hit(2, "a"), hit("\t", "b"), hit(3, None)]
    got = quality.null_rejects(frame(spark, rows), RULES)
    assert reasons(got) == {
        "null_critical_column: ip": 2,
        "null_critical_column: referrer": 1,
        "null_critical_column: hit_time_gmt": 1,
    }


def test_type_rejects(spark):
    rows = [hit("abc", "a"), hit(" 12 ", "a"), hit("", "a"), hit("1.5", "a"), hit(3, "a") | {"date_time": "yesterday"}]
    got = quality.type_rejects(frame(spark, rows), RULES)
    assert reasons(got) == {"type_error: hit_time_gmt": 2, "type_error: date_time": 1}


def test_null_rates(spark):
    rows = [hit(i, "a", "2", "E;I;1;;") | {"user_agent": " " if i < 3 else "x", "geo_city": "" if i < 2 else "x"} for i in range(4)]
    got = [tuple(r) for r in quality.null_rate_warnings(frame(spark, rows), RULES).collect()]
    assert got == [("user_agent", 3, 4, 75.0)]
    stricter = RULES.but(null_warning_threshold_pct=49)
    assert quality.null_rate_warnings(frame(spark, rows), stricter).count() == 2
    assert quality.null_rate_warnings(frame(spark, []), RULES).count() == 0


COPIES = [
    hit(1, "a", page="p", name="first"),
    hit(1, " a ", page="p", name="second"),
    hit(2, "a", page="p", name="other"),
    hit(1, "a", page="p", name="third"),
]


@pytest.mark.parametrize("partitions, hot_keys", [(1, 10_000), (4, 10_000), (4, 1), (3, 2)])
def test_first_copy_survives(spark, monkeypatch, partitions, hot_keys):
    monkeypatch.setattr(dedup, "HOT_KEYS", hot_keys)  # 1: no key is broadcast
    hits = frame(spark, COPIES, partitions)
    assert {r["pagename"] for r in dedup.keep_first(hits, RULES).collect()} == {"first", "other"}
    rejected = dedup.duplicate_rejects(hits, RULES).collect()
    assert {r["pagename"] for r in rejected} == {"second", "third"}
    assert {r["_error_reason"] for r in rejected} == {"duplicate_row: key=('1', 'a', 'http://www.shop.example/p')"}
    assert dedup.keep_any(hits, RULES).count() == 2
    assert tuple(dedup.duplicate_counts(hits, RULES).first()) == (4, 2, 2)


def test_summary(spark):
    rows = COPIES + [hit("", "", page="x"), hit(9, "b", referrer="")]
    got = quality.summary(frame(spark, rows), RULES).first().asDict()
    assert got == {
        "rows_in": 6,
        "rows_out": 2,
        "critical_failures": 2,
        "rows_before": 4,
        "rows_after": 2,
        "duplicate_count": 2,
        "error_count": 5,
        "overall_passed": False,
    }
    clean = quality.summary(frame(spark, COPIES[:1]), RULES).first()
    assert clean["overall_passed"] and clean["error_count"] == 0
    assert quality.summary(frame(spark, []), RULES).first()["rows_in"] == 0


def test_errors_are_masked_but_empty_values_stay_empty(spark):
    rows = [hit(1, "192.0.2.77", agent="", referrer="")]
    (row,) = quality.masked_errors(quality.error_rows(frame(spark, rows), RULES), RULES).collect()
    assert row["ip"] == hashlib.sha256(b"192.0.2.77").hexdigest()[:16] + "..." and row["user_agent"] == ""


def messy(seed, n):
    rng = random.Random(seed)
    return [
        hit(
            rng.choice(["", "x", 1, 2, 3, 4, 5]),
            rng.choice(["", " ", "a", "b", "a "]),
            page=rng.choice(["p", "q"]),
            name=str(i),
            referrer=rng.choice(["", "http://r/"]),
        )
        for i, _ in enumerate(range(n))
    ]


@pytest.mark.parametrize("seed, hot_keys, few", [(0, 10_000, 0), (1, 1, 0), (2, 8, 0), (3, 10_000, 10_000)])
def test_every_row_is_either_kept_or_rejected(spark, monkeypatch, seed, hot_keys, few):
    monkeypatch.setattr(dedup, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(dedup, "BROADCAST_KEYS", few)
    hits = frame(spark, messy(seed, 200), 4)
    valid = hits.where(quality.is_valid(RULES, hits.columns))
    kept = {r["pagename"] for r in dedup.keep_first(valid, RULES).collect()}
    rejected = {r["pagename"] for r in quality.error_rows(hits, RULES).collect()}
    assert kept | rejected == {str(i) for i in range(200)} and not kept & rejected


def test_one_key_with_most_rows_is_split_over_tasks(spark):
    """Half of all rows are copies of one hit; its rows must not meet in one task."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        copies = frame(spark, [hit(1, "hot", name=str(i)) for i in range(400)] + [hit(i, "x") for i in range(400)])
        rejected = dedup.duplicate_rejects(copies, RULES)
        sizes = [r["count"] for r in rejected.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 399 and max(sizes) < 200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rejects_are_the_same_however_repeated_keys_are_joined(spark, monkeypatch):
    rules = RULES.but(reject_type_errors=True)
    hits = frame(spark, messy(7, 300), 4)
    got = []
    for few in (0, 10_000):
        monkeypatch.setattr(dedup, "BROADCAST_KEYS", few)
        got.append(Counter((r["pagename"], r[quality.REASON]) for r in quality.error_rows(hits, rules).collect()))
    assert got[0] == got[1] and {reason.split(":")[0] for _, reason in got[1]} == {"null_critical_column", "type_error", "duplicate_row"}


def test_few_repeated_keys_take_one_scan_without_shuffle(spark, tmp_path):
    frame(spark, messy(4, 60), 2).write.parquet(str(tmp_path / "h"))
    errors = quality.error_rows(spark.read.parquet(str(tmp_path / "h")), RULES)
    plan = errors._jdf.queryExecution().executedPlan().toString()
    # The other scan is that of the repeated keys.
    assert plan.count("FileScan parquet") == 2 and "Exchange hashpartitioning" not in plan
