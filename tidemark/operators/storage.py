"""Tables of decisions and alerts: files by day, latest versions, summaries, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, TimestampNTZType

from tidemark.functions.scalars import start_of_minute


def stored_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions as they are stored: money to 2 decimals, places and scores to 6, and the day they are filed under."""
    to = lambda c, n: F.round(c, n).alias(c)
    rounded = {"amount": 2, "latitude": 6, "longitude": 6, "ml_score": 6, "combined_score": 6}
    return decisions.select(*(to(c, rounded[c]) if c in rounded else F.col(c) for c in decisions.columns)).withColumn("event_date", F.to_date("event_time"))


def stored_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("score", F.round("score", 4)).withColumn("event_date", F.to_date("event_time"))


def _time_text(time: Column) -> Column:
    """UTC with milliseconds; the present where there is no time."""
    given = F.when(time > F.lit("1970-01-01").cast("timestamp_ntz"), time).otherwise(F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(given, "yyyy-MM-dd HH:mm:ss.SSS")


_DIGITS = {"amount": 2, "latitude": 6, "longitude": 6, "ml_score": 6, "combined_score": 6, "score": 4}


def json_rows(df: DataFrame) -> DataFrame:
    """Decisions or alerts as JSON texts in the column `value`: numbers with fixed decimals, times as text, nulls as blanks."""

    def shown(f: StructField) -> Column:
        if f.name in _DIGITS:
            return F.coalesce(F.col(f.name), F.lit(0.0)).cast(f"decimal(38,{_DIGITS[f.name]})")
        if isinstance(f.dataType, TimestampNTZType):
            return _time_text(F.coalesce(F.col(f.name), F.lit("1970-01-01").cast("timestamp_ntz")))
        return F.coalesce(F.col(f.name), F.lit("")) if isinstance(f.dataType, StringType) else F.col(f.name)

    return df.select(F.to_json(F.struct(*(shown(f).alias(f.name) for f in df.schema))).alias("value"))


def append(df: DataFrame, path: str) -> None:
    """Add rows under their day; readers take the latest version of each key."""
    df.write.mode("append").partitionBy("event_date").parquet(path)


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row of the greatest version of each key; of rows of equal versions the greatest by its other columns. Versions are
    compared before rows are shuffled, so a key with many sends one row a task."""
    kinds = dict(df.dtypes)
    order = [version, *(c for c in df.columns if c not in (key, version) and kinds[c][:3] not in ("map",))]
    last = df.groupBy(key).agg(F.max_by(F.struct(*(c for c in df.columns if c != key)), F.struct(*order)).alias("_last"))
    return last.select(*(key if c == key else F.col(f"_last.{c}").alias(c) for c in df.columns))


def unexpired(df: DataFrame, time: str, days: int, as_of: Column) -> DataFrame:
    return df.where(F.col(time) >= as_of - F.make_dt_interval(F.lit(days)))


def with_ground_truth(df: DataFrame) -> DataFrame:
    """Rows of the older layout get ground_truth_is_fraud 0."""
    return df.withColumn("ground_truth_is_fraud", F.coalesce("ground_truth_is_fraud", F.lit(0)) if "ground_truth_is_fraud" in df.columns else F.lit(0))


# Partial aggregates: sums and counts that can be added up later, so that a row that is revised is taken out by adding
# its old contribution with the sign turned. A greatest value cannot be taken out of a maximum, so latencies are kept as counts of each value.
SUMMARIES = {
    "tx_throughput": (["window_start"], ["tx_count", "total_amount", "fraud_count"]),
    "alerts_by_type": (["alert_date", "alert_type", "alert_source"], ["alert_count", "score_sum"]),
    "fraud_by_geo": (["geo_date", "lat_bucket", "lon_bucket"], ["fraud_count", "total_amount"]),
    "latency_stats": (["window_start", "latency_ms"], ["n"]),
    "latency_sketch": (["window_start", "bucket"], ["n"]),
}
COUNTS = {"tx_throughput": "tx_count", "alerts_by_type": "alert_count", "fraud_by_geo": "fraud_count", "latency_stats": "n", "latency_sketch": "n"}
#: buckets of the latency sketch grow by this factor, so a quantile of it is within 1 % of the exact one
GROWTH = 1.02
SKETCH_ERROR = (GROWTH - 1) / (GROWTH + 1)

TIMED = "produced_at > timestamp_ntz'1970-01-02' and decided_at > timestamp_ntz'1970-01-02'"


def latency() -> Column:
    return F.timestamp_diff("MILLISECOND", F.col("produced_at"), F.col("decided_at"))


def latency_bucket(ms: Column) -> Column:
    """The bucket b of latencies in (GROWTH ** (b - 1), GROWTH ** b]; -1 for none or less."""
    return F.when(ms > 0, F.ceil(F.log(ms.cast("double")) / F.log(F.lit(GROWTH)))).otherwise(-1).cast("int")


def partials(rows: DataFrame, summary: str) -> DataFrame:
    """Partial rows of a summary from some decisions (from some alerts, for alerts_by_type)."""
    n = F.count("*")
    if summary == "tx_throughput":
        found = F.sum(F.when(F.col("is_fraud") == 1, 1).otherwise(0))
        return rows.groupBy(start_of_minute(F.col("event_time")).alias("window_start")).agg(n.alias("tx_count"), F.sum("amount").alias("total_amount"), found.alias("fraud_count"))
    if summary == "alerts_by_type":
        return rows.groupBy(F.to_date("alert_time").alias("alert_date"), "alert_type", "alert_source").agg(n.alias("alert_count"), F.sum("score").alias("score_sum"))
    if summary == "fraud_by_geo":
        bucket = lambda c: (F.bround(c, 0) + 0.0).alias(f"{c[:3]}_bucket")
        return rows.where("is_fraud = 1").groupBy(F.to_date("event_time").alias("geo_date"), bucket("latitude"), bucket("longitude")).agg(n.alias("fraud_count"), F.sum("amount").alias("total_amount"))
    if summary in ("latency_stats", "latency_sketch"):
        of = latency().alias("latency_ms") if summary == "latency_stats" else latency_bucket(latency()).alias("bucket")
        return rows.where(TIMED).groupBy(start_of_minute(F.col("decided_at")).alias("window_start"), of).agg(n.alias("n"))
    raise ValueError(f"no summary {summary}")


def revised(new: DataFrame, old: DataFrame, summary: str) -> DataFrame:
    """Partial rows that add `new` rows and take `old` versions of them out."""
    keys, states = SUMMARIES[summary]
    gone = partials(old, summary).select(*keys, *((-F.col(c)).alias(c) for c in states))
    return merge_partials(partials(new, summary).unionByName(gone), summary)


def merge_partials(partials: DataFrame, summary: str) -> DataFrame:
    """Partial rows of a summary added up by its keys; what has been taken out wholly is gone."""
    keys, states = SUMMARIES[summary]
    return partials.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in states)).where(" or ".join(f"{c} <> 0" for c in states))


def finished(partials: DataFrame, summary: str) -> DataFrame:
    """A summary from its partial rows: merged, with averages in place of sums, and quantiles in place of buckets."""
    merged = merge_partials(partials, summary).where(f"{COUNTS[summary]} > 0")
    if summary == "alerts_by_type":
        return merged.withColumn("avg_score", F.col("score_sum") / F.col("alert_count")).drop("score_sum")
    if summary == "latency_stats":
        n, ms = F.col("n"), F.col("latency_ms")
        return merged.groupBy("window_start").agg(F.max(ms).cast("double").alias("max_latency_ms"), F.sum("n").alias("tx_count"), (F.sum(ms * n) / F.sum(n)).alias("avg_latency_ms"))
    if summary == "latency_sketch":
        return sketch_quantiles(merged)
    return merged


def sketch_quantiles(buckets: DataFrame, shares: tuple[float, ...] = (0.95, 0.99)) -> DataFrame:
    """(window_start, tx_count, p95_latency_ms, ...) of merged buckets: the middle of the bucket that holds the smallest value with at
    least that share at or below it, within SKETCH_ERROR of that value. A window has some hundred buckets."""
    whole, upto = Window.partitionBy("window_start"), Window.partitionBy("window_start").orderBy("bucket")
    counted = buckets.withColumns({"total": F.sum("n").over(whole), "seen": F.sum("n").over(upto)})
    middle = F.when(F.col("bucket") < 0, 0.0).otherwise(2 * F.pow(F.lit(GROWTH), F.col("bucket")) / (GROWTH + 1))
    reached = lambda q: F.min(F.when(F.col("seen") >= F.ceil(F.col("total") * q), middle)).alias(f"p{q * 100:.0f}_latency_ms")
    return counted.groupBy("window_start").agg(F.max("total").alias("tx_count"), *(reached(q) for q in shares))
