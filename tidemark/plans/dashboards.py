"""Monitoring queries over decisions (t) and alerts (a). Relative times are relative to an as_of column or value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import start_of_minute
from tidemark.operators.storage import TIMED, finished, latency, partials

def n() -> Column:
    return F.count("*")


def true_fraud() -> Column:
    return F.col("ground_truth_is_fraud") == 1


def found() -> Column:
    return F.col("is_fraud") == 1



def percent(part: Column, whole: Column) -> Column:
    """100 * rows of part / rows of whole, half-even to 2 decimals, 0 / 0 being 0."""
    return F.bround(F.count_if(part) * 100.0 / F.greatest(F.count_if(whole), F.lit(1)), 2)


def since(df: DataFrame, time: str, span: str) -> DataFrame:
    """Rows of the last `span` before the latest `time` of the table."""
    edge = df.agg(F.max(time).alias("_edge"))
    return df.crossJoin(F.broadcast(edge)).where(F.col(time) >= F.col("_edge") - F.expr(f"interval {span}")).drop("_edge")  # one row


def total(t):
    return t.agg(n().alias("total"))


def fraud_detected(t):
    return t.where(found()).agg(n().alias("fraud"))


def ground_truth_rate(t):
    return t.agg(F.bround(F.count_if(true_fraud()) * 100.0 / n(), 2).alias("fraud_rate"))


def blocked(t):
    return t.where("decision = 'BLOCK'").agg(n().alias("blocked"))


def average_score(t):
    return t.where("ml_score > 0").agg(F.bround(F.avg("ml_score"), 4).alias("avg_ml"))


def total_alerts(a):
    return a.agg(F.count_distinct("alert_id").alias("alerts"))


def throughput(t):
    return since(t, "decided_at", "1 minute").agg(F.bround(n() / 60.0, 1).alias("events_per_sec"))


def detection_rate(t):
    return t.agg(percent(true_fraud() & found(), true_fraud()).alias("fdr"))


def false_positive_rate(t):
    return t.agg(percent(~true_fraud() & found(), ~true_fraud()).alias("fpr"))


def average_latency(t):
    return since(t, "decided_at", "5 minutes").where(TIMED).agg(F.bround(F.avg(latency()), 0).alias("avg_latency_ms"))


def per_minute(t):
    return since(t, "event_time", "1 hour").groupBy(start_of_minute(F.col("event_time")).alias("time")).agg(
        n().alias("transactions"), F.count_if(found()).alias("detected_fraud"), F.count_if(true_fraud()).alias("ground_truth_fraud")
    ).orderBy("time")


def latency_over_time(t):
    q = lambda p: F.bround(F.percentile(latency(), p), 0)
    return since(t.where(TIMED), "decided_at", "1 hour").groupBy(start_of_minute(F.col("decided_at")).alias("time")).agg(
        F.bround(F.avg(latency()), 0).alias("avg_latency_ms"), q(0.95).alias("p95_latency_ms"), q(0.99).alias("p99_latency_ms")
    ).orderBy("time")


def alerts_by(a, column: str, count: str, limit: int | None = None):
    last = a.groupBy("alert_id").agg(F.max_by(column, F.struct("alert_time", column)).alias(column))
    out = last.groupBy(column).agg(n().alias(count)).orderBy(F.desc(count), column)
    return out.limit(limit) if limit else out


def decision_breakdown(t):
    return t.groupBy("decision").agg(n().alias("cnt"))


def fraud_by_hour(t):
    return t.where(true_fraud()).groupBy(F.hour("event_time").cast("string").alias("hour")).agg(n().alias("fraud_count")).orderBy("hour")


def score_distribution(t):
    return t.where("ml_score > 0").orderBy("ml_score", "transaction_id").limit(5000).select("ml_score", F.col("ground_truth_is_fraud").alias("is_fraud"))


def top_accounts(t):
    return t.where(true_fraud()).groupBy("account_id").agg(F.sum("amount").alias("total_fraud_amount"), n().alias("fraud_count")).orderBy(F.desc("total_fraud_amount"), "account_id").limit(15)


def source_breakdown(t):
    return t.where("decision_source not in ('', 'NONE')").groupBy("decision_source").agg(n().alias("cnt")).orderBy(F.desc("cnt"), "decision_source")


def rates_over_time(t):
    return since(t, "event_time", "1 hour").groupBy(start_of_minute(F.col("event_time")).alias("time")).agg(
        percent(true_fraud() & found(), true_fraud()).alias("fdr_pct"), percent(~true_fraud() & found(), ~true_fraud()).alias("fpr_pct")
    ).orderBy("time")


def recent_alerts(a):
    row = F.max_by(F.struct("alert_type", "alert_source", "severity", "account_id", "transaction_id", "score", "details"), F.struct("alert_time", "score", "details"))
    last = a.groupBy("alert_id").agg(F.max("alert_time").alias("alert_time"), row.alias("r"))
    return last.orderBy(F.desc("alert_time"), "alert_id").limit(50).select(
        "alert_time", "r.alert_type", "r.alert_source", "r.severity", "r.account_id", "r.transaction_id", F.bround("r.score", 3).alias("score"), "r.details"
    )


def summary(rows, name: str):
    """A whole summary table; storage.partials() makes and merges the same from parts."""
    return finished(partials(rows, name), name)


def by_source(t):
    return t.groupBy("decision_source").agg(n().alias("cnt"))


def overall_latency(t):
    return t.where("produced_at > timestamp_ntz'1970-01-02'").agg(F.avg(latency()).alias("avg_latency"))
