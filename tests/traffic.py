"""Seeded synthetic traffic: ordinary transactions and five kinds of fraud sequences, as DataFrames of JSON messages.

Every row is computed from hashes of its number, so any partition can be made anywhere and again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.transactions import CITIES, HOMES

ACCOUNTS, MERCHANTS = 500, 200
START_MS = 1_700_000_000_000
# fixed values: shares of the kinds of fraud
MIX = [("takeover", 0.25), ("rapid", 0.20), ("travel", 0.20), ("amount", 0.10), ("micro", 0.25)]


def _u(seed: int, key: Column, what: str) -> Column:
    """Uniform in [0, 1), the same for the same row and purpose."""
    return F.pmod(F.xxhash64(key, F.lit(f"{seed}:{what}")), F.lit(1 << 40)) / float(1 << 40)


def _normal(seed: int, key: Column, what: str) -> Column:
    radius = F.sqrt(-2 * F.log(1 - _u(seed, key, what + ":r")))
    return radius * F.cos(2 * math.pi * _u(seed, key, what + ":a"))


def _between(u: Column, low: float, high: float) -> Column:
    return F.round(low + u * (high - low), 2)


def _city(index: Column, k: int) -> Column:
    return F.get(F.array(*(F.lit(c[k]) for c in CITIES)), index.cast("int"))


def generate(spark: SparkSession, sequences: int, fraud_ratio: float = 0.03, seed: int = 42, gap_ms: int = 1000) -> DataFrame:
    """(value, account_id, kind): JSON messages of `sequences` sequences, of which about fraud_ratio are fraudulent.

    takeover: 3 to 5 failed logins, a login and a transfer of 5,000 to 50,000, 500 ms apart, the transfer labelled. rapid: 3 to 6 transfers or
    payments of 100 to 2,000, 500 ms apart. micro: 5 to 8 of .50 to 9.99, 500 ms apart. travel: at home, then a far city 2 s
    later, the second labelled. amount: one of 10,000 to 100,000. Others: one lognormal amount around the account's mean.
    """
    i = F.col("id")
    u = lambda what: _u(seed, i, what)
    kind, edge = F.lit("ordinary"), 0.0
    for name, share in MIX:
        kind = F.when((u("fraud") < fraud_ratio) & (u("kind") >= edge) & (u("kind") < edge + share), name).otherwise(kind)
        edge += share
    base = spark.range(sequences).select(
        i.alias("seq"), kind.alias("kind"), (F.floor(u("account") * ACCOUNTS) + 1).cast("int").alias("account"), (F.lit(START_MS) + i * gap_ms).alias("at"), u("length").alias("length")
    ).withColumn("kind", F.coalesce("kind", F.lit("ordinary")))
    size = (
        F.when(F.col("kind") == "takeover", F.floor(F.col("length") * 3) + 5).when(F.col("kind") == "rapid", F.floor(F.col("length") * 4) + 3)
        .when(F.col("kind") == "micro", F.floor(F.col("length") * 4) + 5).when(F.col("kind") == "travel", 2).otherwise(1).cast("int")
    )
    rows = base.withColumn("size", size).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    key = F.concat_ws(":", "seq", "step")
    v = lambda what: _u(seed, key, what)
    is_kind = lambda *names: F.col("kind").isin(*names)
    last = F.col("step") == F.col("size") - 1
    login = is_kind("takeover") & ~last
    event = (
        F.when(is_kind("takeover") & last, "TRANSFER").when(is_kind("takeover") & (F.col("step") == F.col("size") - 2), "LOGIN_SUCCESS").when(is_kind("takeover"), "LOGIN_FAILED")
        .when(is_kind("rapid", "micro"), F.when(v("type") < 0.5, "TRANSFER").otherwise("PAYMENT")).when(is_kind("travel", "amount"), "TRANSFER")
        .otherwise(F.when(v("type") < 0.3, "TRANSFER").when(v("type") < 0.7, "PAYMENT").when(v("type") < 0.9, "WITHDRAWAL").otherwise("LOGIN"))
    )
    mean = F.greatest(F.lit(1.0), 500 + 200 * _normal(seed, F.col("account"), "mean"))
    amount = (
        F.when(login, 0.0).when(is_kind("takeover"), _between(v("amount"), 5000, 50000)).when(is_kind("rapid"), _between(v("amount"), 100, 2000)).when(is_kind("micro"), _between(v("amount"), 0.5, 9.99))
        .when(is_kind("amount"), _between(v("amount"), 10000, 100000)).otherwise(F.round(mean * F.exp(0.5 * _normal(seed, key, "amount")), 2))
    )
    home = F.pmod(F.col("account"), F.lit(HOMES))
    away = is_kind("travel") & last
    city = F.when(away, HOMES + F.floor(v("city") * (len(CITIES) - HOMES))).otherwise(home)
    place = F.format_string('{"latitude":%.6f,"longitude":%.6f}', *(_city(city, k) + F.when(is_kind("ordinary"), 0.01 * _normal(seed, key, f"place{k}")).otherwise(0.0) for k in (1, 2)))
    labelled = is_kind("rapid", "micro", "amount") | (is_kind("takeover", "travel") & last)
    at = F.col("at") + F.col("step") * F.when(is_kind("travel"), 2000).otherwise(500)
    padded = lambda prefix, n, width: F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))
    account = padded("ACC-", F.col("account"), 6)
    message = F.struct(
        F.format_string("TX-%010d-%02d", "seq", "step").alias("transaction_id"), account.alias("account_id"), padded("CARD-", F.col("account"), 8).alias("card_id"), at.alias("timestamp"), at.alias("produced_at"),
        amount.alias("amount"), event.alias("event_type"), F.get(F.array(*map(F.lit, ("ATM", "ONLINE", "POS", "MOBILE"))), F.floor(v("channel") * 4).cast("int")).alias("channel"), place.alias("location"),
        F.lit("PENDING").alias("status"), F.when(login, "").otherwise(padded("MERCH-", F.floor(v("merchant") * MERCHANTS) + 1, 4)).alias("merchant_id"), labelled.cast("int").alias("is_fraud"),
    )
    return rows.select(F.to_json(message).alias("value"), account.alias("account_id"), "kind")
