import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.config import Config
from tidemark.operators import patterns as P
from tidemark.operators.features import rolling_features
from tidemark.sources.transactions import CITIES

TX = "transaction_id string, account_id string, ts_ms long, amount double, event_type string, latitude double, longitude double, merchant_id string"
M = 60_000


def frame(spark, events):
    """events: (ms, kind, amount, city or None, merchant) of one account."""
    rows = [(f"T{i:03d}", "A", ms, float(amount), kind, *((CITIES[city][1:]) if city is not None else (0.0, 0.0)), merchant) for i, (ms, kind, amount, city, merchant) in enumerate(events)]
    return spark.createDataFrame(rows, TX)


def logins(n, gap=500, transfer=None):
    return [(i * gap, "LOGIN_FAILED", 0, None, "") for i in range(n)] + [(n * gap, "LOGIN_SUCCESS", 0, None, ""), (transfer if transfer is not None else (n + 1) * gap, "TRANSFER", 9000, None, "M")]


@pytest.mark.parametrize("n, score, severity", [(2, None, None), (3, 0.89, "HIGH"), (4, 0.92, "HIGH"), (5, 0.95, "HIGH"), (6, 0.98, "HIGH"), (7, 0.99, "CRITICAL"), (10, 0.99, "CRITICAL")])
def test_takeover(spark, n, score, severity):
    got = P.account_takeover(frame(spark, logins(n)), Config()).collect()
    assert [(round(r.score, 2), r.severity) for r in got] == ([] if score is None else [(score, severity)])


def test_takeover_window_and_reuse(spark):
    assert P.account_takeover(frame(spark, logins(3, transfer=10 * M)), Config()).count() == 0
    assert [r.details[:30] for r in P.account_takeover(frame(spark, logins(4, transfer=10 * M)), Config()).collect()] == ["Brute force: 3 failed logins f"]
    twice = logins(3) + [(ms + 5000, k, a, c, m) for ms, k, a, c, m in logins(3)]
    assert P.account_takeover(frame(spark, twice), Config()).count() == 2


@pytest.mark.parametrize("amounts, merchants, alerts, severity", [([9.99] * 4, "M", 0, None), ([9.99] * 5, "M", 5, "MEDIUM"), ([10.0] * 5, "M", 0, None), ([9.99] * 5, "MN", 5, "HIGH"), ([9.99] * 5, "MNO", 5, "CRITICAL"), ([9.99] * 6, "M", 6, "MEDIUM")])
def test_micro(spark, amounts, merchants, alerts, severity):
    got = P.micro_transactions(frame(spark, [(i * 1000, "PAYMENT", a, None, merchants[i % len(merchants)]) for i, a in enumerate(amounts)]), Config()).collect()
    assert len(got) == alerts and {r.severity for r in got} == ({severity} if severity else set())


@pytest.mark.parametrize("times, severity", [((0, 500, 1000), "CRITICAL"), ((0, 900, 1999), "HIGH"), ((0, 900, 2000), None)])
def test_velocity(spark, times, severity):
    got = P.velocity(frame(spark, [(t, "TRANSFER", a, None, "M") for t, a in zip(times, (100, 2000, 500))]), Config()).collect()
    assert {(r.severity, round(r.score, 2)) for r in got} == ({(severity, 0.85)} if severity else set())


@pytest.mark.parametrize("to, severity, score", [(1, "HIGH", 0.913780), (2, "HIGH", 0.860603), (3, "HIGH", 0.909790), (4, "CRITICAL", 0.99), (5, "CRITICAL", 0.99)])
def test_travel(spark, to, severity, score):
    got = P.impossible_travel(frame(spark, [(0, "TRANSFER", 1, 0, ""), (2000, "TRANSFER", 1, to, "")]), Config()).collect()
    assert [(r.transaction_id, r.severity) for r in got] == [("T001", severity)] and got[0].score == pytest.approx(score, abs=1e-6)


def test_travel_without_place_and_after_two(spark):
    assert P.impossible_travel(frame(spark, [(0, "TRANSFER", 1, None, ""), (2000, "TRANSFER", 1, 4, "")]), Config()).count() == 0
    got = P.impossible_travel(frame(spark, [(0, "TRANSFER", 1, 0, ""), (1000, "TRANSFER", 1, 0, ""), (2000, "TRANSFER", 1, 4, "")]), Config()).collect()
    assert len(got) == 1 and got[0].transaction_id == "T002"


def naive_runs(events, n, window, ok):
    rows = sorted((ms, i) for i, (ms, kind, amount, *_) in enumerate(events) if ok(kind, amount))
    hit = set()
    for k in range(len(rows) - n + 1):
        if rows[k + n - 1][0] - rows[k][0] < window:
            hit.update(i for _, i in rows[k : k + n])
    return {f"T{i:03d}" for i in hit}


def naive_takeover(events, c):
    opens, found = [], []
    for ms, i in sorted((e[0], i) for i, e in enumerate(events)):
        kind, opens = events[i][1], [o for o in opens if ms - o[0] < c.takeover_ms]
        if kind == "LOGIN_FAILED":
            opens = [[a, n + (not d and n < c.takeover_most), d] for a, n, d in opens] + [[ms, 1, False]]
        elif kind == "LOGIN_SUCCESS":
            opens = [[a, n, d or n >= c.takeover_failures] for a, n, d in opens]
        elif kind == "TRANSFER" and any(o[2] for o in opens):
            found.append((f"T{i:03d}", next(o[1] for o in opens if o[2])))
            opens = []
    return found


EVENTS = st.lists(st.tuples(st.integers(0, 20 * M), st.sampled_from(["LOGIN_FAILED"] * 4 + ["LOGIN_SUCCESS", "TRANSFER", "PAYMENT", "WITHDRAWAL"]), st.sampled_from([1, 9.99, 10, 100, 500, 2000, 3000]), st.sampled_from([None, 0, 1, 4]), st.sampled_from("MNO")), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EVENTS)
def test_against_loops(spark, events):
    c, tx = Config(velocity_ms=3 * M), frame(spark, events)
    micro = {r.transaction_id for r in P.micro_transactions(tx, c).collect()}
    assert micro == naive_runs(events, 5, c.micro_ms, lambda k, a: k in P.FINANCIAL and a < 10)
    fast = {r.transaction_id for r in P.velocity(tx, c).collect()}
    assert fast == naive_runs(events, 3, c.velocity_ms, lambda k, a: k in ("TRANSFER", "PAYMENT") and 100 <= a <= 2000)
    got = {(r.transaction_id, round(min(0.99, 0.8 + 0.03 * n), 6)) for r in P.account_takeover(tx, c).collect() for n in [int(r.matched_events.split("x")[1].split()[0])]}
    assert got == {(t, round(min(0.99, 0.8 + 0.03 * n), 6)) for t, n in naive_takeover(events, c)}


def test_features_against_loop(spark):
    events = [(0, "TRANSFER", 10, 0, ""), (0, "TRANSFER", 30, 1, ""), (3_600_000, "PAYMENT", 20, None, ""), (3_600_001, "PAYMENT", 70, 4, ""), (90_000_000, "PAYMENT", 5, 4, "")]
    events = [(10**12 + ms, *rest) for ms, *rest in events]  # rows at 0 or before have no time
    got = {r.transaction_id: r for r in rolling_features(frame(spark, events)).collect()}
    assert [got[f"T{i:03d}"].tx_count_1h for i in range(5)] == [0, 1, 2, 1, 0]
    assert [got[f"T{i:03d}"].tx_count_24h for i in range(5)] == [0, 1, 2, 3, 2]
    assert got["T002"].avg_amount_24h == 20.0 and got["T002"].amount_deviation == 0.0
    std = math.sqrt((100 + 900 + 400) / 3 - 400)
    assert got["T003"].amount_deviation == math.floor((70 - 20) / std * 10000 + 0.5) / 10000
    assert got["T002"].distance_km == 0.0 and got["T003"].distance_km > 0 and got["T001"].distance_km == pytest.approx(1137.80)
    assert [got[f"T{i:03d}"].time_since_last_ms for i in range(5)] == [0, 0, 3_600_000, 1, 86_399_999]


def test_features_masked(spark):
    from pyspark.sql import functions as F

    tx = frame(spark, [(1, "TRANSFER", 10, 0, ""), (1001, "TRANSFER", 99, 0, ""), (2001, "TRANSFER", 20, 0, "")])
    got = {r.transaction_id: r for r in rolling_features(tx, F.col("amount") == 99).collect()}
    assert (got["T001"].tx_count_1h, got["T001"].avg_amount_24h, got["T002"].tx_count_1h, got["T002"].time_since_last_ms) == (0, 0.0, 1, 2000)


def test_features_without_time(spark):
    from pyspark.sql import functions as F

    tx = frame(spark, [(5000, "TRANSFER", 10, 0, ""), (0, "TRANSFER", 20, 0, ""), (-7, "TRANSFER", 30, 0, ""), (9000, "TRANSFER", 40, 0, "")])
    got = {r.transaction_id: (r.tx_count_1h, r.time_since_last_ms) for r in rolling_features(tx, now=F.lit(8000)).collect()}
    assert got == {"T000": (0, 0), "T001": (1, 3000), "T002": (2, 0), "T003": (3, 1000)}
