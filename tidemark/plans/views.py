"""Decisions, alerts and summaries as named SQL views, and panels asked in SQL with the time they stand at.

`ask` runs any query over the views; `:as_of` in it is the given time, so a filter on event or decision times is a literal that
reaches the scan of a stored table, where the panels of `dashboards` look the latest time up first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import storage
from tidemark.operators.decisions import final_alerts

TABLES = {"tx_throughput": "mv_tx_throughput", "alerts_by_type": "mv_alerts_by_type", "fraud_by_geo": "mv_fraud_by_geo", "latency_stats": "mv_latency_stats", "latency_sketch": "mv_latency_quantiles"}

#: panels that look back from a time
PANELS = {
    "throughput": "SELECT bround(count(*) / 60.0D, 1) AS events_per_sec FROM transactions WHERE decided_at >= :as_of - INTERVAL 1 MINUTE AND decided_at <= :as_of",
    "average_latency": f"SELECT bround(avg(timestampdiff(MILLISECOND, produced_at, decided_at)), 0) AS avg_latency_ms FROM transactions WHERE {storage.TIMED} AND decided_at >= :as_of - INTERVAL 5 MINUTES AND decided_at <= :as_of",
    "per_minute": """SELECT CAST(date_trunc('MINUTE', event_time) AS TIMESTAMP_NTZ) AS time, count(*) AS transactions, count_if(is_fraud = 1) AS detected_fraud, count_if(ground_truth_is_fraud = 1) AS ground_truth_fraud
        FROM transactions WHERE event_time >= :as_of - INTERVAL 1 HOUR AND event_time <= :as_of GROUP BY 1""",
    "rates_over_time": """SELECT CAST(date_trunc('MINUTE', event_time) AS TIMESTAMP_NTZ) AS time, bround(count_if(ground_truth_is_fraud = 1 AND is_fraud = 1) * 100.0D / greatest(count_if(ground_truth_is_fraud = 1), 1), 2) AS fdr_pct,
        bround(count_if(ground_truth_is_fraud = 0 AND is_fraud = 1) * 100.0D / greatest(count_if(ground_truth_is_fraud = 0), 1), 2) AS fpr_pct
        FROM transactions WHERE event_time >= :as_of - INTERVAL 1 HOUR AND event_time <= :as_of GROUP BY 1""",
    "top_accounts": "SELECT account_id, sum(amount) AS total_fraud_amount, count(*) AS fraud_count FROM transactions WHERE ground_truth_is_fraud = 1 AND event_time <= :as_of GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
}


def register(decisions: DataFrame, alerts: DataFrame | None = None, summaries: dict[str, DataFrame] | None = None) -> None:
    """Makes views of this session: transactions, fraud_alerts (those that follow from the decisions, if not given) and a view a summary."""
    spark = decisions.sparkSession
    decisions.createOrReplaceTempView("transactions")
    alerts = final_alerts(decisions.drop("event_date")) if alerts is None else alerts
    alerts.createOrReplaceTempView("fraud_alerts")
    for name, view in TABLES.items():
        made = (summaries or {}).get(name)
        if made is None:
            made = storage.finished(storage.partials(spark.table("fraud_alerts" if name == "alerts_by_type" else "transactions"), name), name)
        made.createOrReplaceTempView(view)


def register_stored(spark: SparkSession, out: str) -> None:
    """The same views over what the stream of run_decisions() has written to `out`, as it stands now."""
    from tidemark.streaming import job

    register(job.current_decisions(spark, out), job.current_alerts(spark, out), {name: job.current_summary(spark, out, name) for name in storage.SUMMARIES})


def ask(spark: SparkSession, query: str, as_of: datetime | None = None, **values) -> DataFrame:
    """A SQL query over the views, with named parameters; :as_of is a time without zone."""
    given = {k: F.lit(v) for k, v in values.items()}
    if as_of is not None:
        given["as_of"] = F.expr(f"TIMESTAMP_NTZ '{as_of.replace(tzinfo=None).isoformat(sep=' ')}'")
    return spark.sql(query, args=given)


def panel(spark: SparkSession, name: str, as_of: datetime) -> DataFrame:
    return ask(spark, PANELS[name], as_of)
