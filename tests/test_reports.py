from clicktrail.operators.activity import activity
from clicktrail.plans import reports
from clicktrail.plans.models import credit, keyword_revenue
from clicktrail.rules import SEM_COLUMNS, Rules
from tests.fixtures import ANCHOR_REPORT, SITE, anchor_hits, frame, hit, rows_of, sale, search

RULES = Rules()


def sem_rows(spark, rows, **kw):
    return [tuple(r)[:9] for r in reports.sem_insights(frame(spark, rows), run_id="r", **kw).collect()]


def test_anchor_report(spark):
    report = reports.keyword_report(frame(spark, anchor_hits()))
    assert report.columns == list(RULES.output_columns)
    assert rows_of(report) == ANCHOR_REPORT


def test_report_is_the_same_in_any_arrangement(spark):
    for partitions in (1, 3, 7):
        assert rows_of(reports.keyword_report(frame(spark, anchor_hits(), partitions))) == ANCHOR_REPORT


def test_anchor_funnel(spark):
    report = reports.sem_insights(frame(spark, anchor_hits()), run_date="today", run_id="r1")
    assert report.columns == list(SEM_COLUMNS)
    assert rows_of(report) == [
        ("google.com", "garden hose", 2, 2, 2, 50.5, 100.0, 25.25, 25.25, "today", "r1"),
        ("bing.com", "spade", 1, 1, 1, 35.0, 100.0, 35.0, 35.0, "today", "r1"),
        ("yahoo.com", "bird bath", 1, 1, 0, 0.0, 0.0, 0.0, 0.0, "today", "r1"),
    ]


def test_first_touch_is_not_overwritten(spark):
    rows = [search(1, "a", "rake"), search(2, "a", "pot", "www.bing.com"), sale(3, "a", 64)]
    assert sem_rows(spark, rows) == [
        ("google.com", "rake", 1, 1, 1, 64.0, 100.0, 64.0, 64.0),
        ("bing.com", "pot", 1, 0, 0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_funnel_counts_worthless_and_negative_purchases(spark):
    rows = [
        search(1, "a", "x"),
        hit(2, "a", "1", "", page="none"),
        search(3, "b", "x"),
        hit(4, "b", "1", "T;P;1;-5;", page="refund"),
        search(5, "c", "x"),
    ]
    assert sem_rows(spark, rows) == [("google.com", "x", 3, 3, 2, -5.0, 66.67, -1.67, -2.5)]


def test_funnel_of_nothing(spark):
    assert sem_rows(spark, []) == []


def test_time_decides_the_first_touch_and_unknown_times_lose(spark):
    rows = [
        search("abc", "a", "unknown"),
        search(10, "a", "later"),
        search(9, "a", "earlier"),  # "10" < "9" as text
        sale(20, "a", 7),
    ]
    assert rows_of(reports.keyword_report(frame(spark, rows))) == [("google.com", "earlier", 7.0)]


def test_same_second_goes_by_arrival(spark):
    rows = [search(5, "a", "one"), search(5, "a", "two"), sale(6, "a", 3)]
    assert rows_of(reports.keyword_report(frame(spark, rows, 4))) == [("google.com", "one", 3.0)]


def test_purchases_without_search_stay_out(spark):
    rows = [sale(1, "direct", 50), search(2, "a", "x"), sale(3, "a", 5)]
    assert rows_of(reports.keyword_report(frame(spark, rows))) == [("google.com", "x", 5.0)]


def test_purchase_before_the_first_touch(spark):
    rows = [sale(1, "a", 50), search(2, "a", "x"), sale(3, "a", 5)]
    assert rows_of(reports.keyword_report(frame(spark, rows))) == [("google.com", "x", 55.0)]
    strict = RULES.but(require_prior_touch=True)
    assert rows_of(reports.keyword_report(frame(spark, rows), strict)) == [("google.com", "x", 5.0)]


def test_session_keys_are_trimmed_and_blank_ones_ignored(spark):
    rows = [search(1, " a ", "x"), sale(2, "a", 5), search(1, " ", "y"), sale(2, "", 9), sale(3, None, 9)]
    assert rows_of(reports.keyword_report(frame(spark, rows))) == [("google.com", "x", 5.0)]


def test_another_session_column(spark):
    rules = RULES.but(session_key_column="user_agent")
    rows = [search(1, "a", "x") | {"user_agent": "u1"}, sale(2, "b", 5) | {"user_agent": "u1"}]
    assert rows_of(reports.keyword_report(frame(spark, rows), rules)) == [("google.com", "x", 5.0)]


def test_revenue_threshold_is_exclusive(spark):
    rows = [search(1, "a", "x"), sale(2, "a", 5), sale(3, "a", 6)]
    rules = RULES.but(min_revenue_threshold=5)
    assert rows_of(reports.keyword_report(frame(spark, rows), rules)) == [("google.com", "x", 6.0)]


def test_ascending_and_named(spark):
    rules = RULES.but(sort_ascending=True, output_columns=("a", "b", "c"))
    report = reports.keyword_report(frame(spark, anchor_hits()), rules)
    assert report.columns == ["a", "b", "c"] and rows_of(report) == ANCHOR_REPORT[::-1]


def test_rules_from_json():
    rules = Rules.from_json('{"search_engine_domains": ["a.b"], "purchase_event_id": "7"}')
    assert rules.search_engine_domains == ("a.b",) and rules.purchase_event_id == "7"
    assert Rules.from_json(None) == Rules()


def test_scope_keeps_files_apart(spark):
    rows = frame(spark, [search(1, "a", "x"), sale(2, "a", 5), sale(3, "a", 6), search(4, "a", "y")])
    scoped = rows.selectExpr("*", "CASE WHEN hit_time_gmt <= 2 THEN 'one' ELSE 'two' END AS part")
    report = reports.keyword_report(scoped, scope=["part"])
    assert rows_of(report) == [("one", "google.com", "x", 5.0), ("two", "google.com", "y", 6.0)]


def test_control_totals_add_up(spark):
    act = activity(frame(spark, anchor_hits() + [sale(9, "direct", 12.5)]), RULES)
    totals = reports.run_totals(act, RULES).first().asDict()
    assert totals == {
        "search_sessions": 4,
        "touches": 4,
        "purchases": 4,
        "attributed_purchases": 3,
        "revenue": 98.0,
        "attributed_revenue": 85.5,
    }


def test_reconcile(spark):
    act = activity(frame(spark, anchor_hits()), RULES)
    billed = spark.createDataFrame([("google.com", "garden hose", 5), ("aol.com", "tv", 3)], "domain string, keyword string, billed_clicks long")
    got = {r[:2]: r[2:] for r in rows_of(reports.reconcile_clicks(billed, act))}
    assert got[("google.com", "garden hose")] == (5, 2, 2, 3)
    assert got[("aol.com", "tv")] == (3, 0, 0, 3)
    assert got[("bing.com", "spade")] == (0, 1, 1, -1)


def test_shared_session_keys(spark):
    rows = [hit(1, "a", agent="x"), hit(2, "a", agent="y"), hit(3, "b", agent="x"), hit(4, "b", agent="x")]
    rows += [hit(5, " ", agent="x"), hit(6, " ", agent="y"), hit(7, "v", agent="x"), hit(8, "v ", agent="y"), hit(9, None, agent="z")]
    assert sorted(rows_of(reports.shared_session_keys(frame(spark, rows)))) == [("a", 2), ("v", 2)]
    assert rows_of(reports.shared_session_count(frame(spark, rows))) == [(2,)]


def test_plans_have_no_python_and_one_scan(spark, tmp_path):
    frame(spark, anchor_hits()).write.parquet(str(tmp_path / "h"))
    hits = spark.read.parquet(str(tmp_path / "h"))
    for report in (reports.keyword_report(hits), reports.sem_insights(hits)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
        assert plan.count("FileScan") == 1
        assert "Join" not in plan and "Window" not in plan
        assert "user_agent" not in plan  # pruned
        assert "partial_min_by" in plan  # combined before the shuffle


def test_report_by_another_model(spark):
    for model in ("last_touch", "linear", "time_decay"):
        assert rows_of(reports.keyword_report(frame(spark, anchor_hits()), model=model)) == ANCHOR_REPORT


def test_credit_is_by_model_name(spark):
    act = activity(frame(spark, anchor_hits()), RULES)
    for model in ("first_touch", "last_touch", "linear", "time_decay"):
        total = sum(r["revenue"] for r in keyword_revenue(credit(act, RULES, model=model), RULES).collect())
        assert float(total) == 85.5
    assert SITE not in str(rows_of(act))
