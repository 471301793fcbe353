import json
import math
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.config import DAY, HOUR, Config
from tidemark.operators.features import FEATURES, rolling_features
from tidemark.operators.rules import latest_rules
from tidemark.operators.scoring import TreeScorer
from tidemark.operators.storage import stored_decisions
from tidemark.plans.risk import assess
from tidemark.sources.transactions import parse_rules, parse_transactions, read_json
from tidemark.streaming import job, rolling
from traffic import generate

AT = 1_700_000_000_000


class Held:
    """A value or a map as a stream's state gives it."""

    def __init__(self):
        self.row, self.rows = None, {}

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]


def brute(events, keep):
    out = []
    for i, (ms, *_) in enumerate(events):
        past = [e for e in events[:i] if e[1]]
        day = [e[4] for e in past if e[2] and e[0] >= ms - DAY]
        seen = [e for e in past if e[0] >= ms - keep]
        places = [e for e in seen if e[3]]
        out.append((sum(e[2] and e[0] >= ms - HOUR for e in past), len(day), seen[-1][0] if seen else None, *(places[-1][5:] if places else (None, None))))
        out[-1] += (sum(day), sum(x * x for x in day))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 999, 60_000, HOUR, HOUR + 1, DAY - HOUR, DAY, DAY + 1, 2 * DAY]), st.booleans(), st.booleans(), st.booleans(), st.integers(-9, 9)), max_size=25), st.integers(1, 5))
def test_windows_of_one_account(steps, size):
    """Taken in portions, with the state read anew for each and let go as soon as it may be."""
    at, events = AT, []
    for step, counted, known, placed, amount in steps:
        at += step
        events.append((at, counted, counted and known, counted and placed, amount / 4, float(amount), 1.0))
    totals, minutes, got = Held(), Held(), []
    for i in range(0, len(events), size):
        made = rolling.Rolling(totals, minutes, 25 * HOUR)
        got += made.take(events[i : i + size])
        made.settle(events[min(i + size, len(events) - 1)][0])
    assert [(g[0], g[1], g[4], g[5], g[6], g[2], g[3]) for g in got] == brute(events, 25 * HOUR)
    if events:  # everything expires
        made = rolling.Rolling(totals, minutes, 25 * HOUR)
        made.settle(at + 26 * HOUR)
        assert not totals.exists() and not minutes.rows


def test_totals_forget_without_error():
    total, values = rolling.Total(), [0.1, 1e300, -7.25, 5e-324, 0.3]
    for v in values:
        total.add(v, 1)
    total.add(1e300, -1)
    assert total.value() == math.fsum([0.1, -7.25, 5e-324, 0.3])
    total.add(float("inf"), 1)
    assert total.value() != total.value()
    total.add(float("inf"), -1)
    for v in (0.1, -7.25, 5e-324, 0.3):
        total.add(v, -1)
    assert total.value() == 0.0


def stream(spark, folder, batches):
    (folder / "in").mkdir()
    for k, part in enumerate(batches):
        file = folder / "in" / f"{k}.txt"
        file.write_text("\n".join(part))
        os.utime(file, (AT / 1000 + k, AT / 1000 + k))
    return parse_transactions(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{folder}/in"))[0]


def ran(spark, df, name, folder):
    df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).where("account_id <> 'END'")


def message(i, account, ms, **more):
    return json.dumps({"transaction_id": i, "account_id": account, "timestamp": ms, "amount": 150, "event_type": "LOGIN"} | more)


def disordered(lines, parts):
    """Lines in portions, up to 4.9 s out of order, and two that push the watermark past all."""
    order = {v: json.loads(v)["timestamp"] + random.Random(i).randint(0, 4900) for i, v in enumerate(lines)}
    lines = sorted(lines, key=order.__getitem__)
    last, step = max(json.loads(v)["timestamp"] for v in lines) + 10**9, len(lines) // parts + 1
    return [*(lines[i : i + step] for i in range(0, len(lines), step)), [message("END0", "END", last)], [message("END1", "END", last + 10**8)]]


@pytest.mark.parametrize("keep", [25 * HOUR, None])
def test_features_of_a_stream_equal_those_of_a_batch(spark, tmp_path, keep):
    rng, lines, at = random.Random(5), [], AT
    for i in range(420):
        at += rng.choice([0, 1, 700, 3000, 60_000, 900_000, HOUR // 2, HOUR, HOUR])
        at += 30 * HOUR if i in (150, 300) else 0
        place = json.dumps({"latitude": rng.choice([0, 10.5, -33.0]), "longitude": rng.choice([106.0, 0, 151.25])})
        lines.append(message(f"T{rng.random()}", rng.choice("AAAAAABC"), at, amount=round(rng.uniform(1, 500), 2), event_type=rng.choice(["PAYMENT", "TRANSFER"]), location=place))
    masked = lambda: F.col("amount") > 450
    tx = stream(spark, tmp_path, disordered(lines, 7))
    got = ran(spark, rolling.streaming_features(tx, masked(), keep), f"features_{keep}", tmp_path)
    still = parse_transactions(read_json(spark, f"{tmp_path}/in"))[0].where("account_id <> 'END'")
    want = rolling_features(still, masked(), keep_ms=keep)
    rows = lambda df: sorted(tuple(r) for r in df.select("transaction_id", "amount", *FEATURES).collect())
    assert rows(got) == rows(want) and got.count() == len(lines) and got.where("late").count() == 0


def test_late_rows_of_a_stream(spark, tmp_path):
    batches = [
        [message("first", "A", AT), message("second", "A", AT + 60_000)],
        [message("late", "A", AT + 1_000), message("near", "A", AT + 58_000), message("untimed", "A", 0)],
        [message("last", "A", AT + 120_000), message("last", "A", AT + 120_000)],
        [message("END0", "END", AT + 10**9)], [message("END1", "END", AT + 2 * 10**9)],
    ]
    got = ran(spark, rolling.streaming_features(stream(spark, tmp_path, batches)), "late_features", tmp_path).collect()
    assert sorted((r.transaction_id, r.late, r.tx_count_1h) for r in got) == [("first", False, 0), ("last", False, 3), ("late", True, 0), ("near", False, 1), ("second", False, 2), ("untimed", False, 0)]


def test_decisions_of_one_operator_equal_those_of_a_batch(spark, tmp_path):
    """Patterns, rules, features and scores over disordered batches, without history: what critical alerts mask is known in time."""
    lines = [r.value for r in generate(spark, 300, fraud_ratio=0.4).select("value").collect()]
    rules = [{"rule_id": "BIG", "rule_name": "Big", "field": "amount", "operator": "GREATER_THAN", "threshold": 9000.5, "severity": "CRITICAL", "version": 1}]
    known = latest_rules(parse_rules(spark.createDataFrame([(json.dumps(r),) for r in rules], "value string")))
    scorer = TreeScorer([("tx_frequency_1h", 1.0, ("distance_km", 100.0, 0.1, 0.6), 0.9)])
    tx = stream(spark, tmp_path, disordered(lines, 4))
    rolling.run_judged(spark, tx, known, f"{tmp_path}/out", f"{tmp_path}/check", Config(), scorer, trigger={"availableNow": True}).awaitTermination()
    got = job.current_decisions(spark, f"{tmp_path}/out").where("account_id <> 'END'")
    still = parse_transactions(read_json(spark, f"{tmp_path}/in"))[0].where("account_id <> 'END'")
    want = stored_decisions(assess(still, known, Config(), scorer))
    told = lambda df: sorted((r.transaction_id, r.decision, r.decision_source, r.ml_score, round(r.combined_score, 9), r.rule_triggered) for r in df.collect())
    assert not set(told(got)) ^ set(told(want)) and got.count() == want.count() and len({r.decision_source for r in want.collect()}) >= 4
    flagged = want.where("decision <> 'APPROVE'").count()
    assert job.current_alerts(spark, f"{tmp_path}/out").where("account_id <> 'END'").count() == flagged > 0
    assert job.current_summary(spark, f"{tmp_path}/out", "tx_throughput").agg(F.sum("tx_count")).first()[0] == job.current_decisions(spark, f"{tmp_path}/out").count()
