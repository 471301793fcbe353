"""Tables of versions: latest rows, expiry, merging, pruning, retries and readers that began before."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import storage, versions
from tidemark.operators.ranking import ranking_metrics
from tidemark.operators.versions import VersionedTable

ROWS = "k string, v long, x double, tags array<string>, d date"


def rows_of(spark, rows):
    return spark.createDataFrame([(k, v, x, [k], date(2024, 1, day) if day else None) for k, v, x, day in rows], ROWS)


def table(spark, path, **more):
    return VersionedTable(spark, str(path), "d", lambda df: storage.latest(df, "k", "v"), **more)


def test_versions_over_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MANIFESTS", 3)
    t, rng, want = table(spark, tmp_path, deltas=4), random.Random(1), {}
    assert t.last_batch() == -1
    for batch in range(14):
        keys = rng.sample(range(30), 5)
        added = [(f"k{k}", batch, rng.random(), k % 3 + 1) for k in keys]
        t.append(rows_of(spark, added), batch)
        want |= {a[0]: a[:3] for a in added}
    assert {r.k: (r.k, r.v, r.x) for r in t.read().collect()} == want and t.last_batch() == 13
    held = t._manifest()["days"]
    assert all(len(f) <= 4 for f in held.values()) and set(held) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    files = [p for p in tmp_path.rglob("*.parquet")]
    assert len(files) <= 3 * 4 * 4 * 3 and len(list(tmp_path.glob("_manifest/0*.json"))) == 3
    second = t.read(date(2024, 1, 2), date(2024, 1, 2))
    assert {r.k for r in second.collect()} == {k for k in want if int(k[1:]) % 3 == 1}
    assert all("day=2024-01-02" in f for f in second.inputFiles())


def test_retries_and_earlier_readers(spark, tmp_path):
    t = table(spark, tmp_path, deltas=2)
    t.append(rows_of(spark, [("a", 1, 1.0, 1)]), 0)
    early = t.read()
    t.append(rows_of(spark, [("a", 2, 2.0, 1), ("n", 1, 0.0, None)]), 1)
    t.append(rows_of(spark, [("a", 9, 9.0, 1)]), 1)  # was added whole already
    t.append(rows_of(spark, [("a", 3, 3.0, 1)]), 2)
    assert {(r.k, r.v) for r in early.collect()} == {("a", 1)}  # its folder is still there after the merge
    assert {(r.k, r.v) for r in t.read().collect()} == {("a", 3), ("n", 1)}
    assert {(r.k, r.v) for r in t.read(date(2024, 5, 1)).collect()} == {("n", 1)}


def test_days_expire(spark, tmp_path):
    t = table(spark, tmp_path, keep_days=10)
    t.append(rows_of(spark, [("a", 1, 1.0, 1), ("b", 1, 1.0, 12)]), 0)
    t.append(rows_of(spark, [("c", 1, 1.0, 15)]), 1)
    assert {r.k for r in t.read().collect()} == {"b", "c"}


def test_latest_combines_before_the_shuffle(spark):
    plan = storage.latest(rows_of(spark, [("a", 1, 1.0, 1)]), "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("max_by") == 2


@pytest.mark.parametrize("n, values", [(400, 7), (400, 100_000), (1, 1), (0, 1)])
def test_ranking_metrics(spark, n, values):
    rng = random.Random(n + values)
    rows = [(rng.randrange(values) / values, int(rng.random() < 0.3)) for _ in range(n)] + [(None, 1), (float("nan"), 0), (0.5, None), (0.5, 2)]
    kept = rows[:n]
    got = ranking_metrics(spark.createDataFrame(rows, "ml_score double, label int")).first()
    p, q = [s for s, y in kept if y], [s for s, y in kept if not y]
    assert (got.positives, got.negatives) == (len(p), len(q))
    if not p or not q:
        assert got.auc is None
        return
    assert got.auc == pytest.approx(sum((a > b) + (a == b) / 2 for a in p for b in q) / len(p) / len(q), rel=1e-12)
    steps = [(sum(s == t for s in p), sum(s >= t for s in p), sum(s >= t for s in q)) for t in {s for s, _ in kept}]
    assert got.average_precision == pytest.approx(sum(m / len(p) * a / (a + b) for m, a, b in steps), rel=1e-12)


def test_sketch_keeps_its_bound(spark):
    rng = random.Random(6)
    rows = [(k, int(math.exp(rng.uniform(-1, 12)))) for k in range(3) for _ in range(700)] + [(3, 0), (4, 5)]
    frame = spark.createDataFrame(rows, "m int, ms long").select(F.timestamp_seconds(F.col("m") * 60).cast("timestamp_ntz").alias("window_start"), "ms")
    parts = [frame.where(F.pmod(F.hash("ms"), F.lit(3)) == k).groupBy("window_start", storage.latency_bucket(F.col("ms")).alias("bucket")).agg(F.count("*").alias("n")) for k in range(3)]
    got = storage.finished(parts[0].unionByName(parts[1]).unionByName(parts[2]), "latency_sketch").orderBy("window_start").collect()
    assert len(got) == 5
    for k, r in enumerate(got):
        own = sorted(ms for m, ms in rows if m == k)
        for q, found in ((0.95, r.p95_latency_ms), (0.99, r.p99_latency_ms)):
            exact = own[math.ceil(q * len(own)) - 1]
            assert abs(found - exact) <= storage.SKETCH_ERROR * exact * (1 + 1e-9)


def test_revised_rows_are_taken_out(spark, data):
    """New versions of some decisions, in two rounds: merged partials equal those of the latest versions."""
    from tidemark.operators.decisions import final_alerts
    from tidemark.plans import risk

    t = storage.stored_decisions(risk.decisions(spark, data)).cache()
    change = lambda df, k: df.withColumns({"amount": F.col("amount") + k, "is_fraud": 1 - F.col("is_fraud"), "decision": F.when(F.col("is_fraud") == 1, "APPROVE").otherwise("ALERT"), "decided_at": F.col("decided_at") + F.make_dt_interval(secs=F.lit(k))})
    some = lambda k: F.pmod(F.crc32("transaction_id"), F.lit(5)) < k
    once, twice = change(t.where(some(3)), 7).cache(), change(change(t.where(some(1)), 7), 100).cache()
    last = t.where(~some(3)).unionByName(once.where(~some(1))).unionByName(twice).cache()
    none = t.where("false")
    for name in storage.SUMMARIES:
        of = (lambda df: final_alerts(df.drop("event_date"))) if name == "alerts_by_type" else (lambda df: df)
        steps = ((t, none), (once, t.where(some(3))), (twice, once.where(some(1))))
        parts = [storage.revised(of(new), of(old), name) for new, old in steps]
        got = storage.finished(parts[0].unionByName(parts[1]).unionByName(parts[2]), name)
        want = storage.finished(storage.partials(of(last), name), name).select(got.columns)
        shown = lambda rows: sorted(str([round(x, 5) + 0.0 if isinstance(x, float) else x for x in r]) for r in rows.collect())
        assert shown(got) == shown(want) and want.count()
