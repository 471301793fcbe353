import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators import rule_index
from tidemark.operators import rules as rules_module
from tidemark.operators.rules import apply_rules, apply_rules_as_of, condition, in_force, latest_rules, look_up_rules, seed_rules
from tidemark.sources.transactions import RULE

TX = "transaction_id string, account_id string, card_id string, ts_ms long, amount double, event_type string, channel string, merchant_id string, status string"
ROWS = [
    ("t1", "a", "c", 1_700_000_000_000, 100.0, "TRANSFER", "ATM", "MERCH-0199", "PENDING"),
    ("t2", "a", "c", 1_699_995_000_000, 50.0, "PAYMENT", "ONLINE", None, "PENDING"),
    ("t3", "b", "c", 0, 20000.0, "PAYMENT", None, "MERCH-0001", None),
]


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(ROWS, TX)


def rule(field, operator, threshold, start=None, end=None, **more):
    return {"rule_id": "R", "rule_name": "r", "field": field, "operator": operator, "threshold": threshold, "severity": "HIGH", "version": 1, "active": True, "start_hour": start, "end_hour": end} | more


@pytest.mark.parametrize(
    "made, expected",
    [
        (rule("amount", "GREATER_THAN", "100"), {"t3"}),
        (rule("amount", "LESS_THAN", "100.0"), {"t2"}),
        (rule("amount", "EQUALS", "100"), {"t1"}),
        (rule("amount", "EQUALS", '"word"'), set()),
        (rule("channel", "EQUALS", '"ATM"'), {"t1"}),
        (rule("merchant_id", "IN", '["MERCH-0199","X"]'), {"t1"}),
        (rule("merchant_id", "IN", '"MERCH-0199"'), {"t1"}),
        (rule("channel", "NOT_IN", '["ATM"]'), {"t2"}),
        (rule("amount", "IN", "[100, 50]"), {"t1", "t2"}),
        (rule("amount", "NOT_IN", "[100]"), {"t2", "t3"}),
        (rule("channel", "GREATER_THAN", "1"), set()),
        (rule("amount", "GREATER_THAN", '"x"'), {"t1", "t2", "t3"}),
        (rule("amount", "LIKE", "1"), set()),
        (rule("nothing", "EQUALS", "1"), set()),
        (rule(None, "EQUALS", None), set()),
        (rule("channel", "EQUALS", '["ATM","POS"]'), set()),
        (rule("channel", "NOT_IN", None), {"t1", "t2"}),
        (rule("amount", "NOT_IN", '["x"]'), {"t1", "t2", "t3"}),
        (rule("amount", "GREATER_THAN", "1", 0, 5), {"t2", "t3"}),  # t1 is at 05:13, t3 has no time
        (rule("amount", "GREATER_THAN", "1", 22, 4), {"t2", "t3"} if (1_699_995_000_000 // 3_600_000 + 7) % 24 < 4 else {"t3"}),
    ],
)
def test_operators(spark, tx, made, expected):
    assert {r.transaction_id for r in tx.where(condition(made)).collect()} == expected
    table = spark.createDataFrame([tuple(made[f.name] for f in RULE.fields)], RULE)
    compiled, found = ({r.transaction_id: r.rule_alerts for r in f(tx, table).where("size(rule_alerts) > 0").collect()} for f in (apply_rules, look_up_rules))
    assert compiled == found and set(found) == expected


def test_versions_and_inactive(spark, tx):
    old, new, same = rule("amount", "GREATER_THAN", "1"), rule("amount", "GREATER_THAN", "99999", version=3), rule("amount", "LESS_THAN", "0", version=2)
    off = rule("amount", "GREATER_THAN", "0", active=False) | {"rule_id": "OFF"}
    log = spark.createDataFrame([tuple(r[f.name] for f in RULE.fields) for r in (old, same, new, off)], RULE)
    kept = {r.rule_id: r.version for r in latest_rules(log).collect()}
    assert kept == {"R": 3, "OFF": 1}
    assert apply_rules(tx, latest_rules(log)).where("size(rule_alerts) > 0").count() == 0


def test_every_row_stays_and_details(spark, tx):
    got = {r.transaction_id: r.rule_alerts for r in apply_rules(tx, seed_rules(spark, 10000.0, 40.0)).collect()}
    assert set(got) == {"t1", "t2", "t3"}
    assert [v.rule_id for v in got["t3"]] == ["RULE_001", "RULE_003"]
    assert got["t1"][0].details == 'Rule RULE_002: merchant_id IN ["MERCH-0199","MERCH-0198","MERCH-0197"] (actual: MERCH-0199)'
    assert got["t1"][0].score == 0.8 and got["t3"][0].score == 0.6


def test_no_rules(spark, tx):
    assert apply_rules(tx, spark.createDataFrame([], RULE)).select(F.sum(F.size("rule_alerts"))).first()[0] == 0


def test_repeated_ids(spark, tx):
    twice = tx.where("transaction_id = 't3'").unionByName(tx.where("transaction_id = 't3'").withColumn("amount", F.lit(1.0)))
    for f in (apply_rules, look_up_rules):
        assert sorted(len(r.rule_alerts) for r in f(twice, seed_rules(spark)).collect()) == [0, 2]


def many_rules(n, seed=2):
    rng, out = random.Random(seed), []
    for i in range(n):
        field = rng.choice(["amount", "amount", "merchant_id", "channel", "event_type", "account_id"])
        kind = rng.choice(["GREATER_THAN", "LESS_THAN", "EQUALS", "IN", "NOT_IN"])
        value = lambda: round(rng.random() * 200, 1) if field == "amount" else rng.choice(["ATM", "POS", f"MERCH-{rng.randrange(50):04d}", "7", "TRANSFER"])
        threshold = json.dumps([value() for _ in range(rng.randint(0, 3))] if kind in ("IN", "NOT_IN") else value())
        hours = rng.choice([(None, None), (None, None), (22, 4), (3, 9), (5, None)])
        out.append(rule(field, kind, threshold, *hours, severity=rng.choice(["HIGH", "CRITICAL"])) | {"rule_id": f"R{i:05d}", "active": rng.random() < 0.95})
    return out


def traffic(spark, n=400):
    rng = random.Random(9)
    rows = [(f"t{i}", f"a{i % 5}", "c", rng.choice([0, 1_700_000_000_000 + i * 777_777]), rng.choice([None, 7.0, float("nan"), round(rng.random() * 200, 1)]), rng.choice(["TRANSFER", None, "7"]), rng.choice(["ATM", "POS", "7", None]), f"MERCH-{rng.randrange(50):04d}", None) for i in range(n)]
    return spark.createDataFrame(rows, TX)


def test_index_equals_compiled(spark):
    tx, rules = traffic(spark), spark.createDataFrame([tuple(r[f.name] for f in RULE.fields) for r in many_rules(300)], RULE)
    compiled, found = ({r.transaction_id: r.rule_alerts for r in f(tx, rules).collect()} for f in (apply_rules, look_up_rules))
    assert compiled == found and sum(map(len, found.values())) > 5000


def test_index_in_parts(spark, monkeypatch):
    tx, rules = traffic(spark, 50), spark.createDataFrame([tuple(r[f.name] for f in RULE.fields) for r in many_rules(300)], RULE)
    whole = {r.transaction_id: r.rule_alerts for r in look_up_rules(tx, rules).collect()}
    monkeypatch.setattr(rule_index, "INDEX_BYTES", 9000)
    assert {r.transaction_id: r.rule_alerts for r in look_up_rules(tx, rules).collect()} == whole


def test_fifty_thousand_rules(spark):
    """Most name a merchant or a far threshold of their own: a transaction pays for what it matches."""
    rules = [rule("merchant_id", "EQUALS", json.dumps(f"M{i}")) | {"rule_id": f"E{i}"} for i in range(25_000)] + [rule("amount", "GREATER_THAN", str(1000 + i)) | {"rule_id": f"G{i}"} for i in range(25_000)]
    table = spark.createDataFrame([tuple(r[f.name] for f in RULE.fields) for r in rules], RULE)
    i = F.col("id")
    tx = spark.range(0, 200_000, 1, 4).select(
        F.concat(F.lit("t"), i).alias("transaction_id"), F.lit("a").alias("account_id"), F.lit("c").alias("card_id"), (i + 1).alias("ts_ms"), (990 + i % 13).cast("double").alias("amount"),
        F.lit("PAYMENT").alias("event_type"), F.lit("ATM").alias("channel"), F.concat(F.lit("M"), i).alias("merchant_id"), F.lit("S").alias("status"),
    )
    begun = time.time()
    got = apply_rules(tx, table).select("amount", "merchant_id", "rule_alerts.rule_id").where("size(rule_id) > 0").collect()
    assert time.time() - begun < 120
    want = lambda n: sorted([*([f"E{n}"] if n < 25_000 else []), *(f"G{k}" for k in range(max(0, 990 + n % 13 - 1000)))])
    assert {int(r.merchant_id[1:]): sorted(r.rule_id) for r in got} == {n: want(n) for n in range(200_000) if want(n)}


def test_rules_as_of_arrival(spark):
    """Versions that come late, twice, out of order or with an older number; a replay gives the same."""
    log = [("A", "1", 1, 100), ("A", "5", 3, 200), ("A", "2", 2, 250), ("A", "9", 3, 300), ("A", "7", 4, 400), ("B", "3", 1, 250)]
    rows = [tuple((rule("amount", "GREATER_THAN", t) | {"rule_id": i, "version": v})[f.name] for f in RULE.fields) + (at,) for i, t, v, at in log]
    table = spark.createDataFrame(rows, StructType([*RULE.fields, StructField("arrived_ms", LongType())]))
    assert [(r.rule_id, r.since, r.until) for r in in_force(table).orderBy("rule_id", "since").collect()] == [("A", 100, 200), ("A", 200, 400), ("A", 400, None), ("B", 250, None)]
    tx = traffic(spark, 1).drop("amount").crossJoin(spark.createDataFrame([(at, float(x)) for at in (None, 50, 100, 199, 200, 260, 399, 400, 900) for x in (2, 4, 6, 8)], "produced_ms long, amount double"))
    level = lambda at: 99 if at is None or at < 100 else 1 if at < 200 else 5 if at < 400 else 7
    for most in (500, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(rules_module, "MOST_COMPILED", most)
            for r in apply_rules_as_of(tx, table).collect():
                want = [i for i, hit in (("A", r.amount > level(r.produced_ms)), ("B", (r.produced_ms or 0) >= 250 and r.amount > 3)) if hit]
                assert [v.rule_id for v in r.rule_alerts] == want
