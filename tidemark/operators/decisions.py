"""Decisions by priority, and the alerts that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.scalars import from_millis, non_blank


def has_critical() -> Column:
    """Any critical rule or pattern alert on the row."""
    critical = lambda a: a["severity"] == "CRITICAL"
    return F.exists("rule_alerts", critical) | F.exists("cep_alerts", critical)


def set_aside(columns: list[str]) -> Column:
    """Rows that get no features and no score and are no history to others: those with a critical alert, and those marked `late`."""
    return has_critical() | F.coalesce(F.col("late"), F.lit(False)) if "late" in columns else has_critical()


def decide(scored: DataFrame, config: Config) -> DataFrame:
    """One decision a row from rule_alerts, cep_alerts and ml_score. Priority: critical rule, critical pattern, any pattern,
    high score, raised score, any rule, else approve. The strict score limits and the label never mix."""
    critical = lambda a: a["severity"] == "CRITICAL"
    ml = F.coalesce("ml_score", F.lit(0.0))
    cases = [
        (F.exists("rule_alerts", critical), "BLOCK", "RULES_ENGINE"), (F.exists("cep_alerts", critical), "BLOCK", "CEP_ENGINE"), (F.size("cep_alerts") > 0, "ALERT", "CEP_ENGINE"),
        (ml > config.block_score, "BLOCK", "ML_SCORING"), (ml > config.alert_score, "ALERT", "ML_SCORING"), (F.size("rule_alerts") > 0, "ALERT", "RULES_ENGINE"),
    ]
    pick = lambda k: F.coalesce(*(F.when(c[0], F.lit(c[k])) for c in cases), F.lit("APPROVE" if k == 1 else "NONE"))
    best = lambda name: F.coalesce(F.array_max(F.transform(name, lambda a: a["score"])), F.lit(0.0))
    out = scored.withColumns({"decision": pick(1), "decision_source": pick(2)})
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return out.select(
        "transaction_id", "account_id", text("card_id"), from_millis(F.col("ts_ms")).alias("event_time"), "amount", "event_type", text("channel"), "latitude", "longitude", text("merchant_id"),
        F.lit("COMPLETED").alias("status"), ml.alias("ml_score"), F.array_join(F.transform("rule_alerts", lambda r: r["rule_id"]), ", ").alias("rule_triggered"),
        (F.col("decision") != "APPROVE").cast("int").alias("is_fraud"), F.col("label").alias("ground_truth_is_fraud"), "decision", "decision_source",
        F.greatest(ml, best("cep_alerts"), best("rule_alerts")).alias("combined_score"), from_millis(F.col("produced_ms")).alias("produced_at"), from_millis(F.col("decided_ms")).alias("decided_at"),
    )


def final_alerts(decisions: DataFrame) -> DataFrame:
    """An alert for every ALERT or BLOCK decision."""
    source = non_blank(F.col("decision_source"), "DECISION_ENGINE")
    details = F.format_string(
        "Final decision=%s, source=%s, combined_score=%.4f, ml_score=%.4f, triggered_rules=%s", "decision", source, "combined_score", "ml_score", non_blank(F.col("rule_triggered"), "none")
    )
    return decisions.where(F.col("decision").isin("ALERT", "BLOCK")).select(
        F.concat(F.lit("FINAL_"), non_blank(F.col("transaction_id"), "UNKNOWN")).alias("alert_id"), "transaction_id", "account_id", F.concat(F.lit("FINAL_"), "decision").alias("alert_type"),
        F.when(source == "CEP_ENGINE", "CEP").otherwise(source).alias("alert_source"), F.when(F.col("decision") == "BLOCK", "CRITICAL").otherwise("HIGH").alias("severity"),
        F.col("combined_score").alias("score"), details.alias("details"), F.lit("Decision Engine priority: Rules > CEP > ML").alias("matched_events"), "event_time", F.col("decided_at").alias("alert_time"),
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON messages in the column `value`."""
    names = {"alert_id": "alertId", "transaction_id": "transactionId", "account_id": "accountId", "alert_type": "alertType", "alert_source": "alertSource", "severity": "severity", "score": "score",
             "details": "details", "matched_events": "matchedEvents"}
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("event_time")).alias("eventTime")
    return alerts.select(F.to_json(F.struct(*(F.col(a).alias(b) for a, b in names.items()), ms)).alias("value"))
