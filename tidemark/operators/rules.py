"""Rules as data: latest versions, or those in force at a time, compiled to one array expression, or indexed if too many to compile."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import local_hour
from tidemark.operators.rule_index import indexed_violations
from tidemark.sources.transactions import RULE

FIELDS = ("amount", "event_type", "channel", "merchant_id", "status", "card_id", "account_id")
OPERATORS = ("GREATER_THAN", "LESS_THAN", "EQUALS", "IN", "NOT_IN")
MOST_COMPILED = 500  # rules in one expression
MOST_TIMED = 30  # versions of rules in one expression, each with its time

# fixed values: the rules that a new deployment starts with
SEED_RULES = [
    ("RULE_001", "High Amount Transaction", "amount", "GREATER_THAN", "10000.0", "HIGH", 1, True, None, None),
    ("RULE_002", "Blacklisted Merchant", "merchant_id", "IN", '["MERCH-0199","MERCH-0198","MERCH-0197"]', "CRITICAL", 1, True, None, None),
    ("RULE_003", "Off-hours Transaction", "amount", "GREATER_THAN", "5000.0", "MEDIUM", 1, True, 0, 5),
]


def seed_rules(spark: SparkSession, high: float = 10000.0, off_hours: float = 5000.0) -> DataFrame:
    """The seed rules with their two amounts set."""
    rows = [list(r) for r in SEED_RULES]
    rows[0][4], rows[2][4] = str(high), str(off_hours)
    return spark.createDataFrame([tuple(r) for r in rows], RULE)


def latest_rules(log: DataFrame, arrival: str | None = None) -> DataFrame:
    """The row of the highest version of each rule id; of equal versions the first to arrive (or the least by threshold)."""
    order = Window.partitionBy("rule_id").orderBy(F.desc("version"), *([arrival] if arrival else ["threshold", "operator", "field", "severity"]))
    return log.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def _threshold(text: str | None) -> tuple[float, str, list[str]]:
    """A JSON threshold as number (0 where it is none), as text and as list."""
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        value = text
    items = value if isinstance(value, list) else [] if value is None else [value]
    shown = [x if isinstance(x, str) else text if x is value else json.dumps(x) for x in items]
    try:
        number = float(value)
    except (TypeError, ValueError):
        number = 0.0
    return number, text if not isinstance(value, str) else value, shown


def condition(rule: dict) -> Column:
    """Whether a transaction matches; false, never null, for unknown fields or operators and null values."""
    field, operator = rule["field"], rule["operator"]
    if field not in FIELDS or operator not in OPERATORS:
        return F.lit(False)
    value, (number, text, items) = F.col(field), _threshold(rule["threshold"])
    numeric = value if field == "amount" else value.try_cast("double")
    if operator == "GREATER_THAN":
        match = numeric > number
    elif operator == "LESS_THAN":
        match = numeric < number
    elif operator == "EQUALS":
        match = F.abs(numeric - number) < 1e-6 if field == "amount" else value == text
    elif field == "amount":
        inside = F.lit(False)
        for x in items:
            try:
                inside = inside | (F.abs(value - float(x)) < 1e-6)
            except ValueError:
                continue
        match = inside if operator == "IN" else ~inside
    else:
        match = value.isin(items) if operator == "IN" else ~value.isin(items)
    match = F.coalesce(value.isNotNull() & match, F.lit(False))
    if rule.get("start_hour") is not None or rule.get("end_hour") is not None:
        start, end = rule.get("start_hour") or 0, 24 if rule.get("end_hour") is None else rule["end_hour"]
        hour = local_hour(F.col("ts_ms"))
        inside = (hour >= start) & (hour < end) if start <= end else (hour >= start) | (hour < end)
        match = match & ((F.col("ts_ms") <= 0) | inside)
    return match


def violation(rule: dict) -> Column:
    """rule_id, rule_name, severity, score and details of a match."""
    score = 0.8 if rule["severity"] == "CRITICAL" else 0.6  # fixed values, as the words of details
    shown = F.col(rule["field"]).cast("string") if rule["field"] in FIELDS else F.lit("")
    told = " ".join("null" if rule[k] is None else rule[k] for k in ("field", "operator", "threshold"))
    head = F.lit(f"Rule {rule['rule_id']}: {told} (actual: ")
    return F.struct(
        F.lit(rule["rule_id"]).alias("rule_id"), F.lit(rule["rule_name"]).alias("rule_name"), F.lit(rule["severity"]).alias("severity"), F.lit(score).alias("score"),
        F.concat(head, shown, F.lit(")")).alias("details"),
    )


NO_VIOLATIONS = "array<struct<rule_id:string,rule_name:string,severity:string,score:double,details:string>>"


def compile_rules(rules: list[dict]) -> Column:
    """An array of the violations of active rules, by rule id: one projection, no join and no shuffle."""
    active = sorted((r for r in rules if r.get("active") is not False), key=lambda r: r["rule_id"])
    if not active:
        return F.array().cast(NO_VIOLATIONS)
    return F.filter(F.array(*(F.when(condition(r), violation(r)) for r in active)), lambda v: v.isNotNull()).cast(NO_VIOLATIONS)


def apply_rules(tx: DataFrame, rules: DataFrame) -> DataFrame:
    """tx with `rule_alerts`; every row stays. Up to MOST_COMPILED rules are compiled, more are looked up in an index, with the same results."""
    held = [r.asDict() for r in rules.limit(MOST_COMPILED + 1).collect()]
    if len(held) <= MOST_COMPILED:
        return tx.withColumn("rule_alerts", compile_rules(held))
    return look_up_rules(tx, rules)


def _parsed(text: str | None) -> tuple[float, str, list[str], list[float]]:
    number, shown, items = _threshold(text)
    numbers = []
    for x in items:
        try:
            numbers.append(float(x))
        except ValueError:
            continue
    return number, shown, items, numbers


def look_up_rules(tx: DataFrame, rules: DataFrame) -> DataFrame:
    """As apply_rules, for rule sets of any size, through an index of the rules by field, operator and value."""
    return indexed_violations(tx, rules, FIELDS, _parsed, NO_VIOLATIONS)


def in_force(log: DataFrame) -> DataFrame:
    """Rows of a rule log (RULE, arrived_ms) with the time they hold for: from `since` to before `until` (null: still). A row takes
    effect where its version is above all that arrived before it, or at the same time but first by its content."""
    order = Window.partitionBy("rule_id").orderBy("arrived_ms", F.desc("version"), "threshold", "operator", "field", "severity")
    before = F.max("version").over(order.rowsBetween(Window.unboundedPreceding, -1))
    effective = log.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("version") > F.col("_before")))
    return effective.withColumns({"since": F.col("arrived_ms"), "until": F.lead("arrived_ms").over(order)}).drop("_before")


def apply_rules_as_of(tx: DataFrame, log: DataFrame, arrived: str = "produced_ms") -> DataFrame:
    """tx with `rule_alerts` of the rules in force when each arrived, so a replay gives what the first run gave; every row stays, and
    one that has no arrival meets no rule.

    A version holds from its arrival until the next that takes effect, so the as-of join of transactions and versions is a
    condition beside a rule's own: few versions are compiled with it, many are indexed with it, and rows are neither shuffled nor
    multiplied.
    """
    forced = in_force(log)
    most = min(MOST_COMPILED, MOST_TIMED)
    rows = [r.asDict() for r in forced.limit(most + 1).collect()]
    if len(rows) > most:
        return indexed_violations(tx, forced, FIELDS, _parsed, NO_VIOLATIONS, arrived)
    at = F.col(arrived)
    now = lambda r: (at >= r["since"]) & (at < r["until"] if r["until"] is not None else F.lit(True))
    held = sorted((r for r in rows if r.get("active") is not False), key=lambda r: (r["rule_id"], r["since"]))
    found = F.filter(F.array(*(F.when(now(r) & condition(r), violation(r)) for r in held)), lambda v: v.isNotNull()) if held else F.array()
    return tx.withColumn("rule_alerts", found.cast(NO_VIOLATIONS))


def rule_alerts(applied: DataFrame) -> DataFrame:
    """One row a violation, as an alert."""
    return applied.select("transaction_id", "account_id", "ts_ms", F.explode("rule_alerts").alias("r")).select(
        "transaction_id", "account_id", "ts_ms", F.coalesce("r.rule_name", F.lit("RULE_VIOLATION")).alias("alert_type"), F.lit("RULES_ENGINE").alias("alert_source"),
        F.col("r.rule_id").alias("rule_id"), "r.severity", "r.score", "r.details", F.concat_ws("|", "r.rule_id", "transaction_id").alias("alert_id"),
    )
