"""Transactions and rules: schemas, JSON parsing, and the adapter from the `events` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import to_millis

WIRE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("transaction_id", "account_id", "card_id", "timestamp", "produced_at", "amount", "event_type", "channel", "location", "status", "merchant_id", "is_fraud")]
)
RULE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("rule_id", "rule_name", "field", "operator", "threshold", "severity")]
    + [T.StructField("version", T.IntegerType()), T.StructField("active", T.BooleanType()), T.StructField("start_hour", T.IntegerType()), T.StructField("end_hour", T.IntegerType())]
)

# fixed values: cities of the synthetic traffic; accounts live in the first three
CITIES = [
    ("Ho Chi Minh", 10.8231, 106.6297),
    ("Hanoi", 21.0285, 105.8542),
    ("Da Nang", 16.0544, 108.2022),
    ("Singapore", 1.3521, 103.8198),
    ("Tokyo", 35.6762, 139.6503),
    ("New York", 40.7128, -74.0060),
    ("London", 51.5074, -0.1278),
    ("Sydney", -33.8688, 151.2093),
    ("Dubai", 25.2048, 55.2708),
    ("Seoul", 37.5665, 126.9780),
]
HOMES = 3

COLUMNS = ["transaction_id", "account_id", "card_id", "ts_ms", "produced_ms", "amount", "event_type", "channel", "latitude", "longitude", "merchant_id", "status", "label"]


def _number(name: str, kind: str) -> Column:
    return F.coalesce(F.expr(f"try_cast(t.{name} as {kind})"), F.lit(0).cast(kind))


def _coordinate(name: str) -> Column:
    return F.coalesce(F.expr(f"try_cast(get_json_object(t.location, '$.{name}') as double)"), F.lit(0.0))


def parse_transactions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions, rejected) from a column `value` with one JSON object a row, batch or stream.

    Unknown fields are ignored, missing or unreadable numbers are 0, coordinates come from the JSON text in `location`.
    Rows that are no JSON object, or lack a transaction or account id, are rejected with their text.
    """
    parsed = raw.select(F.col("value").cast("string").alias("value")).withColumn("t", F.from_json("value", WIRE))
    good = F.col("t.transaction_id").isNotNull() & F.col("t.account_id").isNotNull()
    whole = lambda name: F.coalesce(F.expr(f"try_cast(try_cast(t.{name} as double) as bigint)"), F.lit(0).cast("long"))
    transactions = parsed.where(good).select(
        "t.transaction_id", "t.account_id", "t.card_id", whole("timestamp").alias("ts_ms"), whole("produced_at").alias("produced_ms"), _number("amount", "double").alias("amount"),
        "t.event_type", "t.channel", _coordinate("latitude").alias("latitude"), _coordinate("longitude").alias("longitude"), "t.merchant_id", "t.status", _number("is_fraud", "int").alias("label"),
    )
    return transactions, parsed.where(~F.coalesce(good, F.lit(False))).select("value")


def parse_rules(raw: DataFrame) -> DataFrame:
    """Rules from a column `value` of JSON; `threshold` stays JSON text, as it may be a number, a string or a list. A column
    `arrival` stays, which orders the messages."""
    v = F.col("value").cast("string")
    get = lambda path: F.get_json_object(v, f"$.{path}")
    hour = lambda name: F.expr(f"try_cast(get_json_object(cast(value as string), '$.time_window.{name}') as int)")
    windowed = get("time_window").isNotNull()
    return raw.select(
        get("rule_id").alias("rule_id"), get("rule_name").alias("rule_name"), get("field").alias("field"), get("operator").alias("operator"), get("threshold").alias("threshold"), get("severity").alias("severity"),
        F.coalesce(F.expr("try_cast(get_json_object(cast(value as string), '$.version') as int)"), F.lit(0)).alias("version"),
        F.coalesce(F.expr("try_cast(get_json_object(cast(value as string), '$.active') as boolean)"), F.lit(True)).alias("active"),
        F.when(windowed, F.coalesce(hour("start_hour"), F.lit(0))).alias("start_hour"), F.when(windowed, F.coalesce(hour("end_hour"), F.lit(24))).alias("end_hour"), *(["arrival"] if "arrival" in raw.columns else []),
    ).where("rule_id is not null")


def from_events(events: DataFrame) -> DataFrame:
    """The `events` table as transactions, by fixed arithmetic on its columns."""
    i, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    city = F.when(k >= 90, HOMES + k % 7).otherwise(k % HOMES)
    kinds = {"error": "LOGIN_FAILED", "signup": "LOGIN_SUCCESS", "purchase": "PAYMENT", "click": "TRANSFER", "view": "WITHDRAWAL"}
    kind = F.coalesce(*(F.when(F.col("event_type") == a, F.lit(b)) for a, b in kinds.items()))
    padded = lambda prefix, column, width: F.concat(F.lit(prefix), F.lpad(column.cast("string"), width, "0"))
    at = to_millis(F.col("ts"))
    pick = lambda values, index: F.get(F.array(*(F.lit(v) for v in values)), index.cast("int"))
    return events.select(
        padded("TX-", i, 8).alias("transaction_id"), padded("ACC-", F.col("user_id"), 6).alias("account_id"), padded("CARD-", F.col("user_id"), 8).alias("card_id"),
        at.alias("ts_ms"), (at + i % 50).alias("produced_ms"), F.col("value").alias("amount"), kind.alias("event_type"), pick(("ATM", "ONLINE", "POS", "MOBILE"), i % 4).alias("channel"),
        pick([c[1] for c in CITIES], city).alias("latitude"), pick([c[2] for c in CITIES], city).alias("longitude"), padded("MERCH-", i % 200 + 1, 4).alias("merchant_id"),
        F.lit("PENDING").alias("status"), F.when(k >= 97, 1).otherwise(0).alias("label"), (at + i % 50 + 20 + i * 7 % 400).alias("decided_ms"),
    )


def read_messages(spark: SparkSession, kind: str = "text", streaming: bool = False, **options: str) -> DataFrame:
    """Messages of any source Spark reads, as the column `value`: lines of text files, or what a connector on the class path
    delivers, with its own options (kafka: subscribe, startingOffsets, ...)."""
    found = (spark.readStream if streaming else spark.read).format(kind).options(**options).load()
    return found.select(F.col("value").cast("string").alias("value"))


def read_json(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of text files as the column `value`."""
    return read_messages(spark, "text", streaming, path=path)


def read_rule_log(spark: SparkSession, path: str) -> DataFrame:
    """Rules from lines of text files, with `arrival`: files by time and name, lines in order."""
    lines = spark.read.format("text").load(path)
    arrival = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))
    return parse_rules(lines.select("value", arrival.alias("arrival")))
