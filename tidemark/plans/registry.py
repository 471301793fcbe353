"""Named queries of the library and the DuckDB SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DAY, SPARSE, Config
from tidemark.functions import scalars as S
from tidemark.operators import decisions as D
from tidemark.operators import patterns as P
from tidemark.operators import rules as R
from tidemark.operators import storage
from tidemark.operators.features import FEATURES, rolling_features
from tidemark.operators.ranking import ranking_metrics
from tidemark.operators.scoring import INPUTS, SMALL_FOREST, TreeScorer, inputs
from tidemark.plans import dashboards as B
from tidemark.plans import oracle as O
from tidemark.plans import risk, views
from tidemark.sources.transactions import COLUMNS, from_events, parse_rules, parse_transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def _tx(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: make(risk.events(spark, d))


def _t(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: make(risk.decisions(spark, d))


def _a(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: make(D.final_alerts(risk.decisions(spark, d)))


def _rule(name: str, field: str, operator: str, threshold: str, sql: str, hours: tuple[int, int] | None = None) -> None:
    start, end = hours or (None, None)
    rule = {"rule_id": name, "rule_name": name, "field": field, "operator": operator, "threshold": threshold, "severity": "HIGH", "start_hour": start, "end_hour": end}
    add(f"d_rule_{name}", _tx(lambda tx: tx.where(R.condition(rule)).select("transaction_id", "account_id")), O.with_tx(f"SELECT transaction_id, account_id FROM tx WHERE {sql}"))


# sources and projections
add("a_events_adapter", _tx(lambda tx: tx.select(*COLUMNS, "decided_ms")), O.with_tx(f"SELECT {', '.join(COLUMNS)}, decided_ms FROM tx"))
add("c_financial", _tx(lambda tx: tx.where(F.col("event_type").isin(*P.FINANCIAL)).select("transaction_id", "amount")), O.with_tx(f"SELECT transaction_id, amount FROM tx WHERE {O.FINANCIAL}"))
add(
    "c_foreign",
    _tx(lambda tx: tx.groupBy(S.is_foreign(F.col("latitude"), F.col("longitude")).alias("is_foreign")).agg(F.count("*").alias("n"))),
    O.with_tx("SELECT CASE WHEN latitude BETWEEN 8.0 AND 23.5 AND longitude BETWEEN 102.0 AND 110.0 THEN 0 ELSE 1 END AS is_foreign, count(*) AS n FROM tx GROUP BY 1"),
)
add("c_final_alerts", _a(lambda a: a.withColumn("score", F.round("score", 6))), O.over_decisions("SELECT * REPLACE (round(score, 6) AS score) FROM a"))
add(
    "k_scalars",
    _tx(lambda tx: tx.select(
        "transaction_id", F.round(S.haversine_km(F.lit(10.8231), F.lit(106.6297), F.col("latitude"), F.col("longitude")), 3).alias("km"), S.local_hour(F.col("ts_ms")).alias("local_hour"),
        S.start_of_minute(S.from_millis(F.col("ts_ms"))).alias("minute"), F.date_format(S.from_millis(F.col("ts_ms")), "yyyyMMdd").alias("day"), F.bround("amount", 0).alias("even"), S.round_half_up(F.col("amount"), 1).alias("half_up"),
    )),
    O.with_tx(f"""SELECT transaction_id, round({O.km("10.8231", "106.6297", "latitude", "longitude")}, 3) AS km, CAST({O.HOUR} AS INT) AS local_hour, date_trunc('minute', make_timestamp(ts_ms * 1000)) AS minute,
        strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS day, round_even(amount, 0) AS even, floor(amount * 10.0 + 0.5) / 10.0 AS half_up FROM tx"""),
)

# rule operators
_rule("greater_than", "amount", "GREATER_THAN", "100.0", "amount > 100.0")
_rule("less_than", "amount", "LESS_THAN", "5", "amount < 5")
_rule("equals_number", "amount", "EQUALS", "50.0", "abs(amount - 50.0) < 1e-6")
_rule("equals_text", "channel", "EQUALS", '"ATM"', "channel = 'ATM'")
_rule("in", "merchant_id", "IN", '["MERCH-0199","MERCH-0198","MERCH-0197"]', O.R2)
_rule("not_in", "channel", "NOT_IN", '["ATM","POS"]', "channel NOT IN ('ATM', 'POS')")
_rule("time_window", "amount", "GREATER_THAN", "50.0", O.R3, (0, 5))
_rule("night_window", "amount", "GREATER_THAN", "50.0", f"amount > 50.0 AND ({O.HOUR} >= 22 OR {O.HOUR} < 4)", (22, 4))
_rule("bad_threshold", "amount", "GREATER_THAN", '"many"', "amount > 0.0")
_rule("unknown_operator", "amount", "LIKE", "1", "false")

_VIOLATIONS = "SELECT transaction_id, unnest([CASE WHEN {} THEN 'RULE_001' END, CASE WHEN {} THEN 'RULE_002' END, CASE WHEN {} THEN 'RULE_003' END]) AS rule_id, amount, merchant_id FROM tx".format(O.R1, O.R2, O.R3)
_VIOLATION_SQL = O.with_tx(f"""SELECT transaction_id, rule_id, CASE rule_id WHEN 'RULE_001' THEN 'HIGH' WHEN 'RULE_002' THEN 'CRITICAL' ELSE 'MEDIUM' END AS severity,
    CASE rule_id WHEN 'RULE_002' THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS score, 'Rule ' || rule_id || ': ' || CASE rule_id WHEN 'RULE_001' THEN 'amount GREATER_THAN 100.0' WHEN 'RULE_002' THEN 'merchant_id IN ["MERCH-0199","MERCH-0198","MERCH-0197"]' ELSE 'amount GREATER_THAN 50.0' END
    || ' (actual: ' || CASE rule_id WHEN 'RULE_002' THEN merchant_id ELSE CAST(amount AS VARCHAR) END || ')' AS details FROM ({_VIOLATIONS}) WHERE rule_id IS NOT NULL""")
_shown = lambda applied: R.rule_alerts(applied).select("transaction_id", "rule_id", "severity", "score", "details")
add("d_violations", lambda s, d: _shown(R.apply_rules(risk.events(s, d), R.latest_rules(risk.demo_rules(s)))), _VIOLATION_SQL)
add("d_violations_join", lambda s, d: _shown(R.look_up_rules(risk.events(s, d), R.latest_rules(risk.demo_rules(s)))), _VIOLATION_SQL)

# patterns
DEFAULT = Config()
_alerts = lambda df: df.select("transaction_id", "account_id", "ts_ms", "alert_type", "severity", F.round("score", 6).alias("score"), "details", "matched_events")
for _name, _find, _sql in (("micro", P.micro_transactions, O.micro), ("velocity", P.velocity, O.velocity), ("takeover", P.account_takeover, O.takeover), ("travel", P.impossible_travel, O.travel)):
    for _kind, _config in (("", SPARSE), ("_default", DEFAULT)):
        add(f"e_{_name}{_kind}", _tx(lambda tx, f=_find, c=_config: _alerts(f(tx, c))), O.with_tx(f"SELECT {O.ALERT_COLS} FROM {_name}", _sql(_config)))
add(
    "e_travel_candidates",
    _tx(lambda tx: P.travel_candidates(tx, SPARSE).withColumn("km", F.round("km", 3))),
    O.with_tx(f"""SELECT x.account_id, x.transaction_id AS first_id, y.transaction_id AS second_id, round({O.km("x.latitude", "x.longitude", "y.latitude", "y.longitude")}, 3) AS km
        FROM tx x JOIN tx y ON x.account_id = y.account_id AND y.ts_ms - x.ts_ms < {SPARSE.travel_ms} AND (y.ts_ms > x.ts_ms OR (y.ts_ms = x.ts_ms AND y.transaction_id > x.transaction_id))
        WHERE x.{O.FINANCIAL} AND y.{O.FINANCIAL} AND {O.km("x.latitude", "x.longitude", "y.latitude", "y.longitude")} >= {SPARSE.travel_km}"""),
)
add("e_detect", _tx(lambda tx: _alerts(P.detect(tx, SPARSE))), O.with_tx(" UNION ALL ".join(f"SELECT {O.ALERT_COLS} FROM {n}" for n in ("takeover", "micro", "velocity", "travel")), O._cep(SPARSE)))
add(
    "f_attach",
    _tx(lambda tx: P.attach(tx, P.detect(tx, SPARSE)).select("transaction_id", F.size("cep_alerts").cast("long").alias("n_alerts"), F.array_join("cep_alerts.alert_type", ",").alias("types"))),
    O.with_tx("SELECT transaction_id, count(alert_type) AS n_alerts, coalesce(string_agg(alert_type, ',' ORDER BY alert_type), '') AS types FROM tx LEFT JOIN ("
              + " UNION ALL ".join(f"SELECT transaction_id, alert_type FROM {n}" for n in ("takeover", "micro", "velocity", "travel")) + ") USING (transaction_id) GROUP BY 1", O._cep(SPARSE)),
)
add("h_features", _tx(lambda tx: rolling_features(tx).select("transaction_id", *FEATURES)), O.with_tx("SELECT * FROM featured", O.features()))

# decisions, tables, monitoring
add("m_decision", _t(lambda t: t.withColumn("combined_score", F.round("combined_score", 6))), O.over_decisions("SELECT * REPLACE (round(combined_score, 6) AS combined_score) FROM t"))
add(
    "j_latest_version",
    _t(lambda t: storage.latest(t.select("transaction_id", "decision", "decided_at").unionByName(t.select("transaction_id", F.lit("OLD").alias("decision"), (F.col("decided_at") - F.expr("interval 1 second")).alias("decided_at"))), "transaction_id", "decided_at")),
    O.over_decisions("SELECT transaction_id, decision, decided_at FROM t"),
)
_agg = lambda select, rest="": O.over_decisions(f"SELECT {select} FROM t {rest}")
_trees = TreeScorer()
_ml = lambda spark, d: risk.assess(risk.events(spark, d), risk.demo_rules(spark), SPARSE, _trees)
_m = lambda make: lambda spark, d: make(_ml(spark, d))
_over_ml = lambda query: O.over_decisions(query, O.forest(SMALL_FOREST), *O.masked_features())
_agg_ml = lambda select, rest="": _over_ml(f"SELECT {select} FROM t {rest}")
_minutes = f"date_trunc('minute', event_time) AS time"
add("p01_total", _t(B.total), _agg("count(*) AS total"))
add("p02_fraud_detected", _t(B.fraud_detected), _agg("count(*) AS fraud", "WHERE is_fraud = 1"))
add("p03_ground_truth_rate", _t(B.ground_truth_rate), _agg(f"round_even(count(*) FILTER ({O.GT}) * 100.0::DOUBLE / count(*), 2) AS fraud_rate"))
add("p04_blocked", _t(B.blocked), _agg("count(*) AS blocked", "WHERE decision = 'BLOCK'"))
# the two panels on scores
add("p05_average_score", _m(B.average_score), _agg_ml("round_even(avg(ml_score), 4) AS avg_ml", "WHERE ml_score > 0"))
add("p06_total_alerts", _a(B.total_alerts), O.over_decisions("SELECT count(DISTINCT alert_id) AS alerts FROM a"))
add("p07_throughput", _t(B.throughput), _agg("round_even(count(*) / 60.0::DOUBLE, 1) AS events_per_sec", f"WHERE {O.since('decided_at', '1 MINUTE')}"))
add("p08_detection_rate", _t(B.detection_rate), _agg(f"{O.percent(f'{O.GT} AND {O.FOUND}', O.GT)} AS fdr"))
add("p09_false_positive_rate", _t(B.false_positive_rate), _agg(f"{O.percent(f'NOT {O.GT} AND {O.FOUND}', f'NOT {O.GT}')} AS fpr"))
add("p10_average_latency", _t(B.average_latency), _agg(f"round_even(avg({O.LATENCY}), 0) AS avg_latency_ms", f"WHERE {O.TIMED} AND {O.since('decided_at', '5 MINUTE')}"))
add("p11_per_minute", _t(B.per_minute), _agg(f"{_minutes}, count(*) AS transactions, count(*) FILTER ({O.FOUND}) AS detected_fraud, count(*) FILTER ({O.GT}) AS ground_truth_fraud", f"WHERE {O.since('event_time', '1 HOUR')} GROUP BY 1"))
add("p12_latency_over_time", _t(B.latency_over_time), _agg(
    f"date_trunc('minute', decided_at) AS time, round_even(avg({O.LATENCY}), 0) AS avg_latency_ms, round_even(quantile_cont(CAST({O.LATENCY} AS DOUBLE), 0.95), 0) AS p95_latency_ms, round_even(quantile_cont(CAST({O.LATENCY} AS DOUBLE), 0.99), 0) AS p99_latency_ms",
    f"WHERE {O.TIMED} AND {O.since('decided_at', '1 HOUR')} GROUP BY 1"))
add("p13_alerts_by_source", _a(lambda a: B.alerts_by(a, "alert_source", "cnt")), O.over_decisions("SELECT alert_source, count(*) AS cnt FROM (SELECT alert_id, arg_max(alert_source, alert_time) AS alert_source FROM a GROUP BY 1) GROUP BY 1"))
add("p14_alerts_by_type", _a(lambda a: B.alerts_by(a, "alert_type", "count", 10)), O.over_decisions("SELECT alert_type, count(*) AS count FROM (SELECT alert_id, arg_max(alert_type, alert_time) AS alert_type FROM a GROUP BY 1) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"))
add("p15_decision_breakdown", _t(B.decision_breakdown), _agg("decision, count(*) AS cnt", "GROUP BY 1"))
add("p16_fraud_by_hour", _t(B.fraud_by_hour), _agg("CAST(hour(event_time) AS VARCHAR) AS hour, count(*) AS fraud_count", f"WHERE {O.GT} GROUP BY 1"))
add("p17_score_distribution", _m(B.score_distribution), _agg_ml("ml_score, ground_truth_is_fraud AS is_fraud", "WHERE ml_score > 0 ORDER BY ml_score, transaction_id LIMIT 5000"))
add("p18_top_accounts", _t(lambda t: B.top_accounts(t).withColumn("total_fraud_amount", F.round("total_fraud_amount", 4))), _agg("account_id, round(sum(amount), 4) AS total_fraud_amount, count(*) AS fraud_count", f"WHERE {O.GT} GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 15"))
add("p19_source_breakdown", _t(B.source_breakdown), _agg("decision_source, count(*) AS cnt", "WHERE decision_source NOT IN ('', 'NONE') GROUP BY 1"))
add("p20_rates_over_time", _t(B.rates_over_time), _agg(f"{_minutes}, {O.percent(f'{O.GT} AND {O.FOUND}', O.GT)} AS fdr_pct, {O.percent(f'NOT {O.GT} AND {O.FOUND}', f'NOT {O.GT}')} AS fpr_pct", f"WHERE {O.since('event_time', '1 HOUR')} GROUP BY 1"))
add("p21_recent_alerts", _a(lambda a: B.recent_alerts(a)), O.over_decisions("SELECT alert_time, alert_type, alert_source, severity, account_id, transaction_id, round_even(score, 3) AS score, details FROM a ORDER BY alert_time DESC, alert_id LIMIT 50"))
add("p22_tx_throughput", _t(lambda t: B.summary(t, "tx_throughput").withColumn("total_amount", F.round("total_amount", 4))), _agg("date_trunc('minute', event_time) AS window_start, count(*) AS tx_count, round(sum(amount), 4) AS total_amount, CAST(sum(is_fraud) AS BIGINT) AS fraud_count", "GROUP BY 1"))
add("p23_alerts_by_type", _a(lambda a: B.summary(a, "alerts_by_type").withColumn("avg_score", F.round("avg_score", 6))), O.over_decisions("SELECT CAST(alert_time AS DATE) AS alert_date, alert_type, alert_source, count(*) AS alert_count, round(avg(score), 6) AS avg_score FROM a GROUP BY 1, 2, 3"))
add("p24_fraud_by_geo", _t(lambda t: B.summary(t, "fraud_by_geo").withColumn("total_amount", F.round("total_amount", 4))), _agg("CAST(event_time AS DATE) AS geo_date, round_even(latitude, 0) + 0.0 AS lat_bucket, round_even(longitude, 0) + 0.0 AS lon_bucket, count(*) AS fraud_count, round(sum(amount), 4) AS total_amount", "WHERE is_fraud = 1 GROUP BY 1, 2, 3"))
add("p25_latency_stats", _t(lambda t: B.summary(t, "latency_stats").withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))), _agg(f"date_trunc('minute', decided_at) AS window_start, round(avg({O.LATENCY}), 6) AS avg_latency_ms, CAST(max({O.LATENCY}) AS DOUBLE) AS max_latency_ms, count(*) AS tx_count", f"WHERE {O.TIMED} GROUP BY 1"))
add("p26_by_source", _t(B.by_source), _agg("decision_source, count(*) AS cnt", "GROUP BY 1"))
add("p26_overall_latency", _t(lambda t: B.overall_latency(t).withColumn("avg_latency", F.round("avg_latency", 6))), _agg(f"round(avg({O.LATENCY}), 6) AS avg_latency", "WHERE produced_at > TIMESTAMP '1970-01-02'"))

# scores of a forest given as data, features as the scorer sees them
add("m_decision_ml", _m(lambda t: t.withColumn("combined_score", F.round("combined_score", 6))), _over_ml("SELECT * REPLACE (round(combined_score, 6) AS combined_score) FROM t"))
add("n_forest_score", _m(lambda t: t.select("transaction_id", "ml_score")), _over_ml("SELECT transaction_id, ml_score FROM t"))
add(
    "n_forest_inputs",
    lambda spark, d: inputs(_marked(spark, d)).select("transaction_id", *(F.col(f"inputs.{n}").cast("double").alias(n) for n in INPUTS)),
    O.with_tx(f"""SELECT transaction_id, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount, CAST({O.HOUR} AS DOUBLE) AS hour_of_day, CASE WHEN latitude BETWEEN 8.0 AND 23.5 AND longitude BETWEEN 102.0 AND 110.0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS is_foreign,
        CAST(tx_count_1h AS DOUBLE) AS tx_frequency_1h, CAST(CAST(distance_km AS FLOAT) AS DOUBLE) AS distance_km FROM marked JOIN masked USING (transaction_id)""", O.marked(), *O.masked_features()),
)
add("h_features_masked", lambda spark, d: _marked(spark, d).select("transaction_id", *FEATURES), O.with_tx("SELECT * FROM masked", O.marked(), *O.masked_features()))
_NOW = 1_900_000_000_000
_remainder = lambda k: F.pmod(F.substring("transaction_id", 4, 8).cast("long"), F.lit(k))
add(
    "h_features_untimed",
    _tx(lambda tx: rolling_features(tx.withColumn("ts_ms", F.when(_remainder(10) == 0, 0).otherwise(F.col("ts_ms"))), now=F.lit(_NOW)).select("transaction_id", *FEATURES)),
    O.with_tx("SELECT * FROM featured", f"placed AS (SELECT * REPLACE (CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 10 = 0 THEN {_NOW} ELSE ts_ms END AS ts_ms) FROM tx)", O.features("placed")),
)
add(
    "c_critical",
    lambda spark, d: risk.enrich(risk.events(spark, d), risk.demo_rules(spark), SPARSE).groupBy(D.has_critical().alias("critical")).agg(F.count("*").alias("n")),
    O.with_tx("SELECT rule_crit OR cep_crit AS critical, count(*) AS n FROM marked GROUP BY 1", O.marked()),
)


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return rolling_features(risk.enrich(risk.events(spark, d), risk.demo_rules(spark), SPARSE), D.has_critical())


# messages: some are no JSON, some lack an account, some have unreadable numbers or no place


def _messages(tx: DataFrame) -> DataFrame:
    number = _remainder(50)
    place = F.when(number != 3, F.to_json(F.struct("latitude", "longitude")))
    fields = F.struct(
        "transaction_id", F.when(number != 1, F.col("account_id")).alias("account_id"), "card_id", F.col("ts_ms").alias("timestamp"), F.col("produced_ms").alias("produced_at"),
        F.when(number == 2, F.lit("much")).otherwise(F.col("amount").cast("string")).alias("amount"), "event_type", "channel", place.alias("location"), "merchant_id", "status", F.col("label").alias("is_fraud"), F.lit(1).alias("unknown"),
    )
    return tx.select(F.when(number == 0, F.concat(F.lit("{broken "), "transaction_id")).otherwise(F.to_json(fields)).alias("value"))


_N = "CAST(substr(transaction_id, 4) AS BIGINT) % 50"
add(
    "a_parse_json",
    _tx(lambda tx: parse_transactions(_messages(tx))[0].select(*COLUMNS)),
    O.with_tx(f"""SELECT {", ".join(COLUMNS)} FROM (SELECT * REPLACE (CASE WHEN {_N} = 2 THEN 0.0 ELSE amount END AS amount, CASE WHEN {_N} = 3 THEN 0.0 ELSE latitude END AS latitude, CASE WHEN {_N} = 3 THEN 0.0 ELSE longitude END AS longitude)
        FROM tx WHERE {_N} > 1)"""),
)
add("a_rejected", _tx(lambda tx: parse_transactions(_messages(tx))[1].agg(F.count("*").alias("n"), F.count_if(F.col("value").startswith("{broken")).alias("broken"))), O.with_tx(f"SELECT count(*) AS n, count(*) FILTER ({_N} = 0) AS broken FROM tx WHERE {_N} <= 1"))


def _limits(events: DataFrame) -> DataFrame:
    """A log of rule messages that the events make: at the end of each day its limits are set anew, under the day's number; `arrival` is that time."""
    tx = from_events(events).withColumn("day", F.floor(F.col("ts_ms") / DAY))
    by_merchant = tx.groupBy("day", "merchant_id").agg(F.count("*").alias("n"))
    busiest = by_merchant.groupBy("day").agg(F.max_by("merchant_id", F.struct("n", "merchant_id")).alias("busiest"))
    days = tx.groupBy("day").agg(F.max("amount").alias("most")).join(busiest, "day")
    made = lambda rule, field, operator, threshold, **more: F.to_json(F.struct(F.lit(rule).alias("rule_id"), F.lit(rule.lower()).alias("rule_name"), F.lit(field).alias("field"), F.lit(operator).alias("operator"), threshold.alias("threshold"), F.lit("HIGH").alias("severity"), F.col("day").alias("version"), *(v.alias(k) for k, v in more.items())))
    night = F.struct(F.lit(22).alias("start_hour"), F.lit(4).alias("end_hour"))
    rules = F.array(
        made("AMOUNT", "amount", "GREATER_THAN", F.floor(F.col("most") / 2)), made("BUSY", "merchant_id", "IN", F.array("busiest")), made("NIGHT", "amount", "GREATER_THAN", F.floor(F.col("most") / 4), time_window=night),
        made("SOME", "channel", "EQUALS", F.lit("ATM"), active=F.pmod("day", F.lit(3)) != 0), F.lit('{"rule_name": "no id"}'),
    )
    return parse_rules(days.select(F.explode(rules).alias("value"), ((F.col("day") + 1) * DAY).alias("arrival")))


_DAYS = f"""days AS (SELECT ts_ms // {DAY} AS day, max(amount) AS most FROM tx GROUP BY 1),
    visits AS (SELECT ts_ms // {DAY} AS day, merchant_id, count(*) AS n FROM tx GROUP BY ALL),
    busy AS (SELECT day, merchant_id AS busiest FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, merchant_id DESC) AS r FROM visits) WHERE r = 1),
    limits AS (SELECT day, CAST(floor(most / 2) AS BIGINT) AS high, CAST(floor(most / 4) AS BIGINT) AS night, busiest, day % 3 <> 0 AS live, (day + 1) * {DAY} AS arrival FROM days JOIN busy USING (day))"""
_last = O.with_tx(
    """SELECT rule_id, lower(rule_id) AS rule_name, CASE rule_id WHEN 'BUSY' THEN 'merchant_id' WHEN 'SOME' THEN 'channel' ELSE 'amount' END AS field, CASE rule_id WHEN 'BUSY' THEN 'IN' WHEN 'SOME' THEN 'EQUALS' ELSE 'GREATER_THAN' END AS operator,
        CASE rule_id WHEN 'BUSY' THEN '["' || busiest || '"]' WHEN 'SOME' THEN 'ATM' WHEN 'AMOUNT' THEN CAST(high AS VARCHAR) ELSE CAST(night AS VARCHAR) END AS threshold, 'HIGH' AS severity, CAST(day AS INT) AS version,
        rule_id <> 'SOME' OR live AS active, CASE WHEN rule_id = 'NIGHT' THEN 22 ELSE -1 END AS start_hour, CASE WHEN rule_id = 'NIGHT' THEN 4 ELSE -1 END AS end_hour
        FROM limits, (VALUES ('AMOUNT'), ('BUSY'), ('NIGHT'), ('SOME')) AS r(rule_id) WHERE day = (SELECT max(day) FROM limits)""", _DAYS)  # fmt: skip
_log = lambda spark, d: _limits(spark.read.parquet(f"{d}/events.parquet"))
_judged = "[CASE WHEN amount > high THEN 'AMOUNT' END, CASE WHEN merchant_id = busiest THEN 'BUSY' END, CASE WHEN amount > night AND (hour >= 22 OR hour < 4) THEN 'NIGHT' END, CASE WHEN channel = 'ATM' AND live THEN 'SOME' END]"
_by_limits = lambda join: O.with_tx(f"SELECT transaction_id, unnest(list_filter({_judged}, lambda x: x IS NOT NULL)) AS rule_id FROM (SELECT *, {O.HOUR} AS hour FROM tx) t {join}", _DAYS)
add("a_rule_log", lambda spark, d: R.latest_rules(_log(spark, d), "arrival").drop("arrival").withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("start_hour", "end_hour")}), _last)
for _how in (R.apply_rules, R.look_up_rules):
    add(
        f"d_versions_{_how.__name__}", lambda spark, d, f=_how: R.rule_alerts(f(risk.events(spark, d), R.latest_rules(_log(spark, d), "arrival"))).select("transaction_id", "rule_id"),
        _by_limits("JOIN limits ON day = (SELECT max(day) FROM limits)"),
    )
add(
    "d_rules_as_of",
    lambda spark, d: R.rule_alerts(R.apply_rules_as_of(risk.events(spark, d), _log(spark, d).withColumnRenamed("arrival", "arrived_ms"))).select("transaction_id", "rule_id"),
    _by_limits("ASOF JOIN limits ON t.produced_ms >= limits.arrival"),
)

# stored forms
_when = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"
add(
    "b_json_rows",
    _t(lambda t: storage.json_rows(t)),
    O.over_decisions(f"""SELECT printf('{{"transaction_id":"%s","account_id":"%s","card_id":"%s","event_time":"%s","amount":%.2f,"event_type":"%s","channel":"%s","latitude":%.6f,"longitude":%.6f,"merchant_id":"%s","status":"%s","ml_score":%.6f,"rule_triggered":"%s","is_fraud":%d,"ground_truth_is_fraud":%d,"decision":"%s","decision_source":"%s","combined_score":%.6f,"produced_at":"%s","decided_at":"%s"}}',
        transaction_id, account_id, card_id, {_when("event_time")}, amount, event_type, channel, latitude, longitude, merchant_id, status, ml_score, rule_triggered, is_fraud, ground_truth_is_fraud, decision, decision_source, combined_score, {_when("produced_at")}, {_when("decided_at")}) AS value FROM t"""),
)
add("b_stored_alerts", _a(lambda a: storage.stored_alerts(a).select("alert_id", "score", "event_date")), O.over_decisions("SELECT alert_id, round(score, 4) AS score, CAST(event_time AS DATE) AS event_date FROM a"))
add("b_alert_messages", _a(lambda a: D.alert_messages(a).select(F.get_json_object("value", "$.alertId").alias("alert_id"), F.get_json_object("value", "$.eventTime").cast("long").alias("event_ms"), F.get_json_object("value", "$.details").alias("details"))),
    O.over_decisions("SELECT alert_id, epoch_ms(event_time) AS event_ms, details FROM a"))
add("b_unexpired", _t(lambda t: storage.unexpired(t, "event_time", 7, F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")).select("transaction_id")), _agg("transaction_id", "WHERE event_time >= TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 7 DAY"))
add("b_older_layout", _t(lambda t: storage.with_ground_truth(t.drop("ground_truth_is_fraud")).select("transaction_id", "ground_truth_is_fraud")), _agg("transaction_id, 0 AS ground_truth_is_fraud"))


def _in_parts(summary: str, rows: DataFrame) -> DataFrame:
    """A summary from partial rows of three parts of its table."""
    part = lambda k: storage.partials(rows.where(F.pmod(F.crc32("transaction_id"), F.lit(3)) == k), summary)
    return storage.finished(part(0).unionByName(part(1)).unionByName(part(2)), summary)


for _panel, _summary, _column in (("p22", "tx_throughput", "total_amount"), ("p23", "alerts_by_type", "avg_score"), ("p24", "fraud_by_geo", "total_amount"), ("p25", "latency_stats", "avg_latency_ms")):
    _shape = lambda df, s=_summary, c=_column: _in_parts(s, df).withColumn(c, F.round(c, 4 if c == "total_amount" else 6))
    add(f"g_partials_{_summary}", (_a if _summary == "alerts_by_type" else _t)(_shape), ORACLE[f"{_panel}_{_summary}"])


def _sketched(t: DataFrame) -> DataFrame:
    """Quantiles of merged sketches by hour, and whether they keep the bound against the exact ones."""
    timed = t.where(storage.TIMED).withColumn("window_start", F.date_trunc("HOUR", "decided_at").cast("timestamp_ntz"))
    part = lambda k: timed.where(F.pmod(F.crc32("transaction_id"), F.lit(3)) == k).groupBy("window_start", storage.latency_bucket(storage.latency()).alias("bucket")).agg(F.count("*").alias("n"))
    made = storage.finished(part(0).unionByName(part(1)).unionByName(part(2)), "latency_sketch")
    exact = timed.groupBy("window_start").agg(*(F.expr(f"percentile_disc({q}) within group (order by {_MS})").alias(f"e{q * 100:.0f}") for q in (0.95, 0.99)))
    near = lambda p: F.abs(F.col(f"p{p}_latency_ms") - F.col(f"e{p}")) <= storage.SKETCH_ERROR * F.col(f"e{p}") * (1 + 1e-9)
    return made.join(exact, "window_start").select("window_start", "tx_count", *(F.round(f"p{p}_latency_ms", 6).alias(f"p{p}_latency_ms") for p in (95, 99)), (near(95) & near(99)).alias("within"))


_MS = "timestampdiff(MILLISECOND, produced_at, decided_at)"
_reached = lambda p: f"round(min(CASE WHEN seen >= ceil(total * 0.{p}) THEN CASE WHEN bucket < 0 THEN 0.0::DOUBLE ELSE 2 * pow({storage.GROWTH}::DOUBLE, bucket) / {storage.GROWTH + 1}::DOUBLE END END), 6) AS p{p}_latency_ms"
add("g_quantile_sketch", _t(_sketched), O.over_decisions(f"""SELECT window_start, CAST(max(total) AS BIGINT) AS tx_count, {_reached(95)}, {_reached(99)}, true AS within FROM (
    SELECT *, sum(n) OVER (PARTITION BY window_start) AS total, sum(n) OVER (PARTITION BY window_start ORDER BY bucket) AS seen FROM (
        SELECT date_trunc('hour', decided_at) AS window_start, CASE WHEN {O.LATENCY} > 0 THEN ceil(ln(CAST({O.LATENCY} AS DOUBLE)) / ln({storage.GROWTH}::DOUBLE)) ELSE -1 END AS bucket, count(*) AS n FROM t WHERE {O.TIMED} GROUP BY ALL)) GROUP BY 1"""))

add(
    "n_ranking_metrics",
    _m(lambda t: ranking_metrics(t, "ml_score", "ground_truth_is_fraud").select(F.round("auc", 9).alias("auc"), F.round("average_precision", 9).alias("average_precision"), "positives", "negatives")),
    _over_ml("""SELECT round(sum(pos * (2 * neg_low + neg)) / (2.0::DOUBLE * max(p) * max(n)), 9) AS auc, round(sum(pos * ((p - pos_low) / CAST(p - pos_low + n - neg_low AS DOUBLE))) / max(p), 9) AS average_precision,
        CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives FROM (
        SELECT *, coalesce(sum(pos) OVER below, 0) AS pos_low, coalesce(sum(neg) OVER below, 0) AS neg_low, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM (
            SELECT ml_score, count(*) FILTER (ground_truth_is_fraud = 1) AS pos, count(*) FILTER (ground_truth_is_fraud = 0) AS neg FROM t GROUP BY 1)
        WINDOW below AS (ORDER BY ml_score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""),
)


def _asked(query: str, time: str):
    """A panel in SQL, as of the latest `time` of the decisions."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        t = risk.decisions(spark, d)
        views.register(t)
        return views.ask(spark, query, t.agg(F.max(time)).first()[0])

    return run


for _name, _panel, _time in (("throughput", "p07_throughput", "decided_at"), ("average_latency", "p10_average_latency", "decided_at"), ("per_minute", "p11_per_minute", "event_time"), ("rates_over_time", "p20_rates_over_time", "event_time")):
    add(f"q_{_name}", _asked(views.PANELS[_name], _time), ORACLE[_panel])
add("q_alerts_by_source", _asked("SELECT alert_source, count(DISTINCT alert_id) AS cnt FROM fraud_alerts WHERE alert_time <= :as_of GROUP BY 1", "decided_at"), ORACLE["p13_alerts_by_source"])
add(
    "q_summary_by_day",
    _asked("SELECT to_date(window_start) AS day, sum(tx_count) AS n, sum(fraud_count) AS found FROM mv_tx_throughput GROUP BY 1", "event_time"),
    _agg("CAST(event_time AS DATE) AS day, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS found", "GROUP BY 1"),
)
