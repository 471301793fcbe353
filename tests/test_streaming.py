import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.operators import patterns as P
from tidemark.operators import storage
from traffic import generate
from tidemark.sources.transactions import parse_transactions, read_json
from tidemark.streaming import job

RULES = [
    {"rule_id": "BIG", "rule_name": "Big", "field": "amount", "operator": "GREATER_THAN", "threshold": 7500.5, "severity": "HIGH", "version": 1},
    {"rule_id": "SHOP", "rule_name": "Shop", "field": "merchant_id", "operator": "IN", "threshold": ["MERCH-0150", "MERCH-0042"], "severity": "CRITICAL", "version": 1},
]


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    generate(spark, 300, fraud_ratio=0.4).select("value").coalesce(2).write.text(f"{base}/in")
    (base / "rules").mkdir()
    (base / "rules" / "a.json").write_text("\n".join(map(json.dumps, RULES)))
    return base


def test_decisions_stream_equals_batch(spark, messages):
    out = messages / "out"
    q = job.run_decisions(spark, read_json(spark, f"{messages}/in", True), f"{messages}/rules", str(out), f"{messages}/check", Config(), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/decisions")
    tx, _ = parse_transactions(read_json(spark, f"{messages}/in"))
    assert got.count() == tx.count()
    from tidemark.operators.rules import latest_rules
    from tidemark.plans.risk import assess
    from tidemark.sources.transactions import parse_rules

    want = assess(tx.withColumn("decided_ms", F.lit(0).cast("long")), latest_rules(parse_rules(spark.read.text(f"{messages}/rules"))), Config())
    both = [{(r.transaction_id, r.decision, r.decision_source) for r in x.collect()} for x in (got, want)]
    assert both[0] == both[1]
    assert spark.read.text(f"{out}/messages").count() == got.where("decision <> 'APPROVE'").count()


@pytest.mark.parametrize("kind, batch", [(job.Takeover, P.account_takeover), (job.Travel, P.impossible_travel), (job.Micro, P.micro_transactions), (job.Velocity, P.velocity)])
def test_stateful_equals_batch(spark, messages, tmp_path, kind, batch):
    """Over several batches, with events up to five seconds out of order."""
    lines = [r.value for r in read_json(spark, f"{messages}/in").collect()]
    order = {v: json.loads(v)["timestamp"] + random.Random(i).randint(0, 4900) for i, v in enumerate(lines)}
    lines.sort(key=lambda v: order[v])
    last = max(json.loads(v)["timestamp"] for v in lines) + 10**9
    end = [json.dumps({"transaction_id": f"END{k}", "account_id": "END", "timestamp": last + k * 10**8, "amount": 150, "event_type": "TRANSFER", "location": json.dumps({"latitude": 10, "longitude": 10})}) for k in (0, 1)]
    step = len(lines) // 4 + 1
    (tmp_path / "in").mkdir()
    for k, part in enumerate([*(lines[i : i + step] for i in range(0, len(lines), step)), end[:1], end[1:]]):
        file = tmp_path / "in" / f"{k}.txt"
        file.write_text("\n".join(part))
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
    tx, _ = parse_transactions(raw)
    name = kind.__name__.lower()
    q = job.stateful_alerts(tx, kind, Config()).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.table(name).where("account_id <> 'END'").collect()
    still, _ = parse_transactions(read_json(spark, f"{messages}/in"))
    want = sorted((r.transaction_id, r.ts_ms, r.severity, round(r.score, 9)) for r in batch(still, Config()).collect())
    assert sorted((r.transaction_id, r.ts_ms, r.severity, round(r.score, 9)) for r in rows) == want and want


def test_running_throughput(spark, messages):
    tx, _ = parse_transactions(read_json(spark, f"{messages}/in", True))
    q = job.running_throughput(tx).writeStream.format("memory").queryName("throughput").outputMode("complete").option("checkpointLocation", f"{messages}/check-t").trigger(availableNow=True).start()
    q.awaitTermination()
    still, _ = parse_transactions(read_json(spark, f"{messages}/in"))
    assert spark.table("throughput").agg(F.sum("tx_count")).first()[0] == still.count()


def test_latest(spark):
    rows = spark.createDataFrame([("a", 1, 5.0, 1), ("a", 2, 7.0, 0), ("b", 1, 1.0, 0)], "transaction_id string, v int, amount double, is_fraud int")
    assert {(r.transaction_id, r.v) for r in storage.latest(rows, "transaction_id", "v").collect()} == {("a", 2), ("b", 1)}


def test_summaries_of_batches(spark, data, tmp_path):
    """Partial rows of three batches, one of them tried twice, make the summaries of the whole."""
    from tidemark.operators.decisions import final_alerts
    from tidemark.plans import dashboards, risk

    t = risk.decisions(spark, data).cache()
    a = final_alerts(t)
    for k in (0, 1, 2, 1):
        part = F.crc32("transaction_id") % 3 == k
        job.summarise_batch(t.where(part), a.where(part), k, f"{tmp_path}/s")
    for name in storage.SUMMARIES:
        got = storage.finished(spark.read.parquet(f"{tmp_path}/s/{name}"), name)
        want = dashboards.summary(a if name == "alerts_by_type" else t, name).select(got.columns)
        shown = lambda rows: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows.collect())
        assert shown(got) == shown(want) and want.count()
    t.unpersist()


def test_runs_cut_by_batch_edges(spark, messages, tmp_path):
    from tidemark.operators.rules import latest_rules
    from tidemark.plans.risk import assess
    from tidemark.sources.transactions import parse_rules

    lines = sorted((r.value for r in read_json(spark, f"{messages}/in").collect()), key=lambda v: (json.loads(v)["timestamp"], v))
    (tmp_path / "in").mkdir()
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "a.json").write_text("\n".join(map(json.dumps, RULES)))
    step = len(lines) // 3 + 1
    out = f"{tmp_path}/out"

    def run(files):
        for k in files:
            (tmp_path / "in" / f"{k}.txt").write_text("\n".join(lines[k * step : (k + 1) * step]))
        raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
        job.run_decisions(spark, raw, f"{tmp_path}/rules", out, f"{tmp_path}/check", Config(), trigger={"availableNow": True}).awaitTermination()

    run([0, 2])
    # every transaction of the second run breaks a new rule; those of the first keep what their own rules said
    more = {"rule_id": "ZZZ", "rule_name": "Any", "field": "amount", "operator": "GREATER_THAN", "threshold": -1.0, "severity": "HIGH", "version": 1}
    (tmp_path / "rules" / "b.json").write_text(json.dumps(more))
    run([1])
    tx, _ = parse_transactions(read_json(spark, f"{tmp_path}/in"))
    tx = tx.withColumn("decided_ms", F.lit(0).cast("long"))
    made = {}
    for names in ("a.json", "*.json"):
        found = assess(tx, latest_rules(parse_rules(spark.read.text(f"{tmp_path}/rules/{names}"))), Config()).collect()
        made[names] = {r.transaction_id: (r.decision, r.decision_source, r.rule_triggered, round(r.combined_score, 6)) for r in found}
    late = {json.loads(v)["transaction_id"] for v in lines[step : 2 * step]}
    want = {i: made["*.json" if i in late else "a.json"][i] for i in made["a.json"]}
    got = job.current_decisions(spark, out).collect()
    assert {r.transaction_id: (r.decision, r.decision_source, r.rule_triggered, round(r.combined_score, 6)) for r in got} == want and len(got) == len(want)
    stored = spark.read.parquet(f"{out}/decisions")
    assert stored.select("batch").distinct().count() == 3 and stored.count() > len(want)
    alerts = job.current_alerts(spark, out).collect()
    assert sorted(r.transaction_id for r in alerts) == sorted(i for i, w in want.items() if w[0] != "APPROVE")


def test_history_covers_the_windows():
    assert job.history_ms(Config()) == 25 * 3_600_000
    assert job.history_ms(Config(takeover_ms=7 * 86_400_000)) == 7 * 86_400_000


def test_summaries_and_days_of_the_stream(spark, messages, tmp_path):
    """Over several batches that revise each other: summaries are those of the latest decisions, and reads by day touch no other."""
    lines = sorted((r.value for r in read_json(spark, f"{messages}/in").collect()), key=lambda v: (json.loads(v)["timestamp"], v))
    lines.append(json.dumps({"transaction_id": "UNTIMED", "account_id": "U", "amount": 20000}))
    (tmp_path / "in").mkdir()
    step = len(lines) // 4 + 1
    for k in (2, 0, 3, 1):
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(lines[k * step : (k + 1) * step]))
        os.utime(tmp_path / "in" / f"{k}.txt", (1_700_000_000 + (k * 3) % 7, 1_700_000_000 + (k * 3) % 7))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    job.run_decisions(spark, raw, f"{messages}/rules", out, f"{tmp_path}/check", Config(), trigger={"availableNow": True}).awaitTermination()
    now, alerts = job.current_decisions(spark, out).cache(), job.current_alerts(spark, out)
    assert now.count() == len(lines) == now.select("transaction_id").distinct().count() and now.where("transaction_id = 'UNTIMED'").count() == 1
    assert spark.read.parquet(f"{out}/decisions").count() > len(lines)  # some were revised
    for name in storage.SUMMARIES:
        got = job.current_summary(spark, out, name)
        from tidemark.operators.decisions import final_alerts

        rows = final_alerts(now.drop("event_date")) if name == "alerts_by_type" else now
        want = storage.finished(storage.partials(rows, name), name).select(got.columns)
        shown = lambda rows: sorted(str([round(x, 4) + 0.0 if isinstance(x, float) else x for x in r]) for r in rows.collect())
        assert shown(got) == shown(want) and (want.count() or name.startswith("latency"))
    assert alerts.count() == now.where("decision <> 'APPROVE'").count()
    day = now.where("event_date > '1971-01-01'").agg(F.min("event_date")).first()[0]
    now.unpersist()
    files = job.current_decisions(spark, out, day, day).inputFiles()
    assert files and all(f"day={day}" in f or "HIVE_DEFAULT" in f for f in files)


def test_merged_stream_equals_batch(spark, messages, tmp_path):
    """Transactions with their alerts from one operator, over batches with events up to five seconds out of order: the last row of each
    transaction has the alerts that a batch attaches, and what came after the first row is marked late."""
    lines = [r.value for r in read_json(spark, f"{messages}/in").collect()]
    first = min(json.loads(v)["timestamp"] for v in lines)
    lines += [json.dumps({"transaction_id": f"SLOW{k}", "account_id": "SLOW", "timestamp": first + 40_000 + k * 25_000, "amount": 5, "event_type": "PAYMENT", "merchant_id": "M"}) for k in range(6)]  # runs over several batches
    order = {v: json.loads(v)["timestamp"] + random.Random(i).randint(0, 4900) for i, v in enumerate(lines)}
    lines.sort(key=lambda v: order[v])
    last = max(json.loads(v)["timestamp"] for v in lines) + 10**9
    end = [json.dumps({"transaction_id": f"END{k}", "account_id": "END", "timestamp": last + k * 10**8, "amount": 150, "event_type": "LOGIN"}) for k in (0, 1)]
    step = len(lines) // 9 + 1
    (tmp_path / "in").mkdir()
    for k, part in enumerate([*(lines[i : i + step] for i in range(0, len(lines), step)), end[:1], end[1:]]):
        file = tmp_path / "in" / f"{k}.txt"
        file.write_text("\n".join(part))
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    tx, _ = parse_transactions(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in"))
    q = job.merged_alerts(tx, Config()).writeStream.format("memory").queryName("merged").outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.table("merged").where("account_id <> 'END'").collect()
    still = parse_transactions(read_json(spark, f"{tmp_path}/in"))[0].where("account_id <> 'END'")
    told = lambda alerts: sorted((a.alert_type, a.severity, round(a.score, 9)) for a in alerts)
    want = {r.transaction_id: (told(r.cep_alerts), r.amount, r.merchant_id) for r in P.attach(still, P.detect(still, Config())).collect()}
    assert {r.transaction_id for r in rows if r.revision == 0} == set(want) and len([r for r in rows if r.revision == 0]) == len(want)
    final = {r.transaction_id: r for r in sorted(rows, key=lambda r: r.revision)}
    assert {i: (told(r.cep_alerts), r.amount, r.merchant_id) for i, r in final.items()} == want
    assert all(r.late_alert == (r.revision > 0) for r in rows)
    assert {r.transaction_id for r in rows if r.late_alert} >= {f"SLOW{k}" for k in range(4)}


def test_late_rows_have_no_features_and_no_score(spark, messages, tmp_path):
    """An event behind the watermark of the batches before is decided without a score, and counts for nobody's features."""
    from tidemark.operators.scoring import TreeScorer

    at = 1_700_000_000_000
    say = lambda i, ms, amount=50: json.dumps({"transaction_id": i, "account_id": "A", "timestamp": at + ms, "produced_at": at + ms, "amount": amount, "event_type": "PAYMENT", "location": json.dumps({"latitude": 10, "longitude": 106})})
    (tmp_path / "in").mkdir()
    batches = [[say("first", 0), say("second", 60_000)], [say("late", 1_000), say("near", 58_000), say("merchant", 1_500, 20_000)], [say("last", 120_000)]]
    for k, part in enumerate(batches):
        file = tmp_path / "in" / f"{k}.txt"
        file.write_text("\n".join(part))
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in")
    # a score of .9 for the third and later transactions of an hour, else .6
    scorer = TreeScorer([("tx_frequency_1h", 1.0, 0.6, 0.9)])
    job.run_decisions(spark, raw, f"{messages}/rules", f"{tmp_path}/out", f"{tmp_path}/check", Config(), scorer, trigger={"availableNow": True}).awaitTermination()
    history = {r.transaction_id: r.late for r in spark.read.parquet(f"{tmp_path}/out/history").collect()}
    assert history == {"first": False, "second": False, "late": True, "near": False, "merchant": True, "last": False}
    got = {r.transaction_id: (r.ml_score, r.decision, r.decision_source) for r in job.current_decisions(spark, f"{tmp_path}/out").collect()}
    assert got["late"] == (0.0, "APPROVE", "NONE") and got["merchant"] == (0.0, "ALERT", "RULES_ENGINE")
    # before `near` stands first alone, before `second` first and near, before `last` all three: the late ones are not counted
    assert (got["first"][0], got["near"][0], got["second"][0], got["last"][0]) == (0.6, 0.6, 0.9, 0.9)


def test_sql_over_what_the_stream_wrote(spark, messages):
    """Views over stored decisions, alerts and summaries; the time of a panel is a parameter."""
    from tidemark.plans import views

    out = f"{messages}/out"  # of the first test
    if not os.path.exists(out):
        pytest.skip("needs test_decisions_stream_equals_batch")
    views.register_stored(spark, out)
    last = spark.sql("SELECT max(event_time) FROM transactions").first()[0]
    n = views.ask(spark, "SELECT count(*) FROM transactions WHERE event_time > :as_of - INTERVAL 1 MINUTE AND amount > :low", last, low=10).first()[0]
    assert n == job.current_decisions(spark, out).where((F.col("event_time") > F.lit(last).cast("timestamp_ntz") - F.expr("interval 1 minute")) & (F.col("amount") > 10)).count() > 0
    assert spark.sql("SELECT sum(tx_count) FROM mv_tx_throughput").first()[0] == spark.table("transactions").count()
    assert views.panel(spark, "per_minute", last).agg(F.sum("detected_fraud")).first()[0] == spark.table("fraud_alerts").count() > 0
