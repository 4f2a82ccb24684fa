"""Attribution models against brute force on random histories."""

import random
from collections import defaultdict

import pytest

from clicktrail.operators.activity import activity
from clicktrail.plans.models import compare_models, credit, keyword_revenue
from clicktrail.operators.timeline import time_decay_credit
from clicktrail.rules import Rules
from tests.fixtures import frame, hit, rows_of, sale, search

RULES = Rules()
DAY = 86400


def random_history(seed, visitors, hits, span):
    rng = random.Random(seed)
    rows = []
    for _ in range(hits):
        ip = f"v{rng.randrange(visitors)}"
        time = 1_700_000_000 + rng.randrange(span)
        kind = rng.random()
        if kind < 0.45:
            rows.append(search(time, ip, f"k{rng.randrange(6)}"))
        elif kind < 0.8:
            rows.append(sale(time, ip, rng.randrange(1, 50_000) / 100))
        else:
            rows.append(hit(time, ip))
    return rows


def sessions_of(rows):
    touches, sales = defaultdict(list), defaultdict(list)
    for i, r in enumerate(rows):
        time = int(r["hit_time_gmt"])
        if "/search?q=" in r["referrer"]:
            touches[r["ip"]].append((time, i, r["referrer"].rsplit("=", 1)[1]))
        elif r["event_list"] == "1":
            sales[r["ip"]].append((time, float(r["product_list"].split(";")[3])))
    return {ip: sorted(t) for ip, t in touches.items()}, sales


def brute_force(rows, model, half_life=RULES.half_life_seconds):
    touches, sales = sessions_of(rows)
    out = defaultdict(float)
    for ip, bought in sales.items():
        seen = touches.get(ip, [])
        for time, price in bought:
            before = [t for t in seen if t[0] <= time]
            if model == "first_touch" and seen:
                out[seen[0][2]] += price
            elif model == "linear":
                for t in seen:
                    out[t[2]] += price / len(seen)
            elif model == "last_touch" and before:
                out[before[-1][2]] += price
            elif model == "time_decay" and before:
                # ages relative to the last touch, so that nothing underflows
                weights = [2.0 ** ((t[0] - before[-1][0]) / half_life) for t in before]
                for t, w in zip(before, weights):
                    out[t[2]] += price * w / sum(weights)
    return out


def engine(spark, rows, model, rules=RULES, partitions=5):
    act = activity(frame(spark, rows, partitions), rules)
    return {r["keyword"]: float(r["revenue"]) for r in keyword_revenue(credit(act, rules, model=model), rules).collect()}


def agree(got, want):
    want = {k: v for k, v in want.items() if round(v, 2) > 0}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=0.011)


HISTORIES = {
    "many days": random_history(1, 12, 600, 90 * DAY),
    "one busy visitor": random_history(2, 1, 400, 20 * DAY),
    "same seconds": random_history(3, 4, 300, 40),
    "years apart": random_history(4, 3, 200, 9000 * DAY),
}


@pytest.mark.parametrize("model", ["first_touch", "last_touch", "linear", "time_decay"])
@pytest.mark.parametrize("history", HISTORIES)
def test_model_equals_brute_force(spark, model, history):
    rows = HISTORIES[history]
    agree(engine(spark, rows, model), brute_force(rows, model))


@pytest.mark.parametrize("half_life", [120, 3600, 40 * DAY])
def test_other_half_lives(spark, half_life):
    rules = RULES.but(half_life_seconds=half_life)
    rows = HISTORIES["many days"]
    agree(engine(spark, rows, "time_decay", rules), brute_force(rows, "time_decay", half_life))


def test_thousands_of_stretches_in_one_session(spark):
    rules = RULES.but(half_life_seconds=DAY // 8)  # a stretch is a day
    rows = [r for d in range(4000) for r in (search(d * DAY, "v", f"k{d % 5}"), sale(d * DAY + 9, "v", 1 + d % 7))]
    agree(engine(spark, rows, "time_decay", rules), near_force(rows, DAY // 8))


def near_force(rows, half_life):
    """Brute force without the touches whose weight is nothing."""
    touches, sales = sessions_of(rows)
    out = defaultdict(float)
    for time, price in sales["v"]:
        near = [t for t in touches["v"] if time - 30 * DAY <= t[0] <= time]
        weights = [2.0 ** ((t[0] - near[-1][0]) / half_life) for t in near]
        for t, w in zip(near, weights):
            out[t[2]] += price * w / sum(weights)
    return out


@pytest.mark.parametrize("model", ["linear", "time_decay"])
def test_shares_add_up_to_the_revenue(spark, model):
    rows = HISTORIES["one busy visitor"]
    touches, sales = sessions_of(rows)
    first = min(t[0] for t in touches["v0"])
    total = sum(p for t, p in sales["v0"] if model == "linear" or t >= first)
    assert sum(engine(spark, rows, model).values()) == pytest.approx(total, abs=0.05)


def test_hits_without_time_take_no_part_in_timed_models(spark):
    rows = [search("x", "a", "lost"), search(5, "a", "kept"), sale(6, "a", 10), sale("y", "a", 99)]
    assert engine(spark, rows, "last_touch") == {"kept": 10.0}
    assert engine(spark, rows, "time_decay") == {"kept": 10.0}


def test_compare_models(spark):
    rows = [search(0, "a", "x"), search(10 * DAY, "a", "y"), sale(10 * DAY, "a", 30)]
    got = {r["keyword"]: r.asDict() for r in compare_models(activity(frame(spark, rows), RULES), RULES).collect()}
    assert {m: got["x"][m] for m in ("first_touch", "last_touch", "linear")} == {"first_touch": 30.0, "last_touch": 0.0, "linear": 15.0}
    assert got["y"]["last_touch"] == 30.0 and got["x"]["time_decay"] + got["y"]["time_decay"] == pytest.approx(30.0)
    assert got["y"]["time_decay"] / got["x"]["time_decay"] == pytest.approx(2 ** (10 / 7), rel=1e-3)


def test_scoped_time_decay(spark):
    rows = [search(1, "a", "x"), sale(2, "a", 5), search(3, "a", "y"), sale(4, "a", 7)]
    hits = frame(spark, rows).selectExpr("*", "hit_time_gmt <= 2 AS part")
    act = activity(hits, RULES, ["part"])
    got = {(r["part"], r["keyword"]): float(r["revenue"]) for r in time_decay_credit(act, RULES.half_life_seconds, ["part"]).collect()}
    assert got == {(True, "x"): 5.0, (False, "y"): 7.0}
    assert rows_of(act)
