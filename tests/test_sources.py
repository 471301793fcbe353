import json
import os

from pyspark.sql import functions as F
from traffic import generate
from tidemark.operators.rules import latest_rules
from tidemark.sources.transactions import parse_rules, parse_transactions, read_messages, read_rule_log


def parsed(spark, *values):
    good, bad = parse_transactions(spark.createDataFrame([(v,) for v in values], "value string"))
    return good.collect(), [r.value for r in bad.collect()]


def test_full_message(spark):
    location = json.dumps({"latitude": 10.762, "longitude": 106.660})
    text = json.dumps({"transaction_id": "TX", "account_id": "A", "card_id": "C", "timestamp": 5, "produced_at": 6, "amount": 1.5, "event_type": "TRANSFER", "channel": "ATM", "location": location, "status": "PENDING", "merchant_id": "M", "is_fraud": 1, "unknown_field": 3})
    rows, bad = parsed(spark, text)
    r = rows[0]
    assert (r.ts_ms, r.produced_ms, r.amount, r.latitude, r.longitude, r.label, bad) == (5, 6, 1.5, 10.762, 106.660, 1, [])


def test_defaults_and_rejects(spark):
    rows, bad = parsed(spark, "not json", '{"transaction_id":"T","account_id":"A","amount":"12"}', '{"account_id":"A"}', '{"transaction_id":"T2"}', "")
    assert [(r.transaction_id, r.amount, r.ts_ms, r.latitude, r.label) for r in rows] == [("T", 12.0, 0, 0.0, 0)]
    assert len(bad) == 4


def test_rules_from_json(spark):
    a = '{"rule_id":"R1","field":"amount","operator":"GREATER_THAN","threshold":5000,"severity":"HIGH","version":2,"time_window":{"start_hour":0,"end_hour":5}}'
    b = '{"rule_id":"R2","field":"channel","operator":"NOT_IN","threshold":["ATM","POS"],"severity":"MEDIUM","active":false}'
    one, two = parse_rules(spark.createDataFrame([(a,), (b,)], "value string")).orderBy("rule_id").collect()
    assert (one.threshold, one.version, one.active, one.start_hour, one.end_hour) == ("5000", 2, True, 0, 5)
    assert (json.loads(two.threshold), two.version, two.active, two.start_hour) == (["ATM", "POS"], 0, False, None)


def test_generator_is_deterministic(spark):
    rows = generate(spark, 400, fraud_ratio=0.5)
    first, again = sorted(r.value for r in rows.collect()), sorted(r.value for r in rows.repartition(3).collect())
    assert first == again
    tx, bad = parse_transactions(rows)
    assert bad.count() == 0 and tx.count() == len(first)
    kinds = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    assert set(kinds) == {"ordinary", "takeover", "rapid", "micro", "travel", "amount"}


def test_first_of_equal_versions_by_arrival(spark, tmp_path):
    line = lambda i, t, v=1: json.dumps({"rule_id": i, "field": "amount", "operator": "GREATER_THAN", "threshold": t, "version": v})
    for k, (name, lines) in enumerate([("z.json", [line("A", 7), line("A", 3), line("B", 1)]), ("a.json", [line("A", 1), line("B", 5, 2), line("B", 4, 2)])]):
        (tmp_path / name).write_text("\n".join(lines))
        os.utime(tmp_path / name, (1_700_000_000 + k, 1_700_000_000 + k))
    got = {r.rule_id: r.threshold for r in latest_rules(read_rule_log(spark, str(tmp_path)), "arrival").collect()}
    assert got == {"A": "7", "B": "5"}
    assert read_messages(spark, "text", path=str(tmp_path)).count() == 6


def test_stored_days(spark, data, tmp_path):
    """Rows appended under their day twice; the later version counts."""
    from tidemark.operators import storage
    from tidemark.plans import risk

    t = storage.stored_decisions(risk.decisions(spark, data)).limit(50).cache()
    later = t.withColumns({"decision": F.lit("LATER"), "decided_at": F.col("decided_at") + F.expr("interval 1 second")})
    for df in (t, later.limit(20)):
        storage.append(df, f"{tmp_path}/t")
    got = storage.latest(spark.read.parquet(f"{tmp_path}/t"), "transaction_id", "decided_at")
    assert got.count() == 50 and got.where("decision = 'LATER'").count() == 20
    t.unpersist()
