"""DuckDB SQL for the registered queries, from shared common table expressions."""

from __future__ import annotations

from tidemark.config import SPARSE, Config
from tidemark.sources.transactions import CITIES, HOMES


def _list(values) -> str:
    return "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values) + "]"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    return f"(2 * 6371.0 * atan2(sqrt({a}), sqrt(1 - ({a}))))"


TX = f"""raw AS (
    SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k, epoch_us(ts) // 1000 AS ms FROM events
), tx AS (
    SELECT 'TX-' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS transaction_id, 'ACC-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_id,
           'CARD-' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS card_id, ms AS ts_ms, ms + event_id % 50 AS produced_ms,
           ms + event_id % 50 + 20 + (event_id * 7) % 400 AS decided_ms, value AS amount,
           CASE event_type WHEN 'error' THEN 'LOGIN_FAILED' WHEN 'signup' THEN 'LOGIN_SUCCESS' WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'WITHDRAWAL' END AS event_type,
           ['ATM', 'ONLINE', 'POS', 'MOBILE'][event_id % 4 + 1] AS channel,
           CAST({_list(c[1] for c in CITIES)}[CASE WHEN k >= 90 THEN {HOMES} + k % 7 ELSE k % {HOMES} END + 1] AS DOUBLE) AS latitude,
           CAST({_list(c[2] for c in CITIES)}[CASE WHEN k >= 90 THEN {HOMES} + k % 7 ELSE k % {HOMES} END + 1] AS DOUBLE) AS longitude,
           'MERCH-' || lpad(CAST(event_id % 200 + 1 AS VARCHAR), 4, '0') AS merchant_id, 'PENDING' AS status, CASE WHEN k >= 97 THEN 1 ELSE 0 END AS label
    FROM raw
)"""

FINANCIAL = "event_type IN ('TRANSFER', 'PAYMENT', 'WITHDRAWAL')"
HOUR = "((ts_ms // 3600000 + 7) % 24)"
R1, R2, R3 = "amount > 100.0", "merchant_id IN ('MERCH-0199', 'MERCH-0198', 'MERCH-0197')", f"(amount > 50.0 AND {HOUR} >= 0 AND {HOUR} < 5)"


def _runs(name: str, where: str, n: int, window: int) -> str:
    w = "OVER (PARTITION BY account_id ORDER BY ts_ms, transaction_id"
    return f"""{name}_q AS (
    SELECT transaction_id, account_id, ts_ms, row_number() {w}) AS rn, lead(ts_ms, {n - 1}) {w}) - ts_ms AS span,
           list(merchant_id) {w} ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS merchants, sum(amount) {w} ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS total
    FROM tx WHERE {where}
), {name}_run AS (
    SELECT r.transaction_id, r.account_id, r.ts_ms, arg_min(s.span, s.rn) AS span, arg_min(len(list_distinct(s.merchants)), s.rn) AS m, arg_min(s.total, s.rn) AS total
    FROM {name}_q r JOIN {name}_q s ON r.account_id = s.account_id AND s.rn BETWEEN r.rn - {n - 1} AND r.rn AND s.span < {window}
    GROUP BY ALL
)"""


def micro(c: Config) -> str:
    return _runs("micro", f"{FINANCIAL} AND amount < {c.micro_amount}", c.micro_count, c.micro_ms) + f""", micro AS (
    SELECT transaction_id, account_id, ts_ms, 'MICRO_TRANSACTIONS' AS alert_type,
           CASE WHEN {c.micro_count} >= 10 OR m >= 3 THEN 'CRITICAL' WHEN m <= 1 THEN 'MEDIUM' ELSE 'HIGH' END AS severity, least(0.98::DOUBLE, 0.75 + {c.micro_count} * 0.03::DOUBLE) AS score,
           printf('{c.micro_count} small transactions under ${c.micro_amount:.0f} in {c.micro_ms // 60_000} mins, total: $%.2f, distinct merchants: %d (score=%.2f)', total, m, score) AS details,
           'TRANSFER/PAYMENT < ${c.micro_amount:.0f} x{c.micro_count} within {c.micro_ms // 60_000} minutes' AS matched_events FROM micro_run
)"""


def velocity(c: Config) -> str:
    where = f"event_type IN ('TRANSFER', 'PAYMENT') AND amount BETWEEN {c.velocity_low} AND {c.velocity_high}"
    return _runs("vel", where, c.velocity_count, c.velocity_ms) + f""", velocity AS (
    SELECT transaction_id, account_id, ts_ms, 'VELOCITY_ATTACK' AS alert_type, CASE WHEN {c.velocity_count} >= 5 OR span <= 1000 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           least(0.95::DOUBLE, 0.70 + {c.velocity_count} * 0.05::DOUBLE) AS score,
           printf('{c.velocity_count} rapid medium-value transactions in %d.%02ds, total: $%.2f (amount range ${c.velocity_low:.0f}-${c.velocity_high:.0f}, score=%.2f)', (span + 5) // 1000, (span + 5) // 10 % 100, total, score) AS details,
           'TRANSFER/PAYMENT ${c.velocity_low:.0f}-${c.velocity_high:.0f} x{c.velocity_count} within {c.velocity_ms // 1000} seconds' AS matched_events FROM vel_run
)"""


def _order(name: str, where: str) -> str:
    return f"{name}_ev AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY ts_ms, transaction_id) AS rn FROM tx WHERE {where})"


def takeover(c: Config) -> str:
    kind = "STRUCT(s BIGINT, n INT, done BOOLEAN)[]"
    return _order("take", "event_type IN ('LOGIN_FAILED', 'LOGIN_SUCCESS', 'TRANSFER')") + f""", take_fold(account_id, rn, opens, hit, ts_ms, transaction_id, amount) AS (
    SELECT DISTINCT account_id, CAST(0 AS BIGINT), CAST([] AS {kind}), CAST(NULL AS INT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM take_ev
    UNION ALL
    SELECT account_id, rn, CAST(CASE WHEN k = 'LOGIN_FAILED' THEN list_append(list_transform(live, lambda o: struct_pack(s := o.s, n := CASE WHEN NOT o.done AND o.n < {c.takeover_most} THEN o.n + 1 ELSE o.n END, done := o.done)), struct_pack(s := ts_ms, n := 1, done := false))
                WHEN k = 'LOGIN_SUCCESS' THEN list_transform(live, lambda o: struct_pack(s := o.s, n := o.n, done := o.done OR o.n >= {c.takeover_failures}))
                WHEN len(list_filter(live, lambda o: o.done)) > 0 THEN [] ELSE live END AS {kind}),
           CASE WHEN k = 'TRANSFER' THEN list_filter(live, lambda o: o.done)[1].n END, ts_ms, transaction_id, amount
    FROM (SELECT e.account_id, e.rn, e.event_type AS k, e.ts_ms, e.transaction_id, e.amount, list_filter(f.opens, lambda o: e.ts_ms - o.s < {c.takeover_ms}) AS live
          FROM take_fold f JOIN take_ev e ON e.account_id = f.account_id AND e.rn = f.rn + 1)
), takeover AS (
    SELECT transaction_id, account_id, ts_ms, 'ACCOUNT_TAKEOVER' AS alert_type, CASE WHEN hit >= 7 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           least(0.99::DOUBLE, 0.80 + hit * 0.03::DOUBLE) AS score,
           printf('Brute force: %d failed logins followed by transfer of $%.2f (score=%.2f)', hit, amount, score) AS details, printf('LOGIN_FAILED x%d -> LOGIN_SUCCESS -> TRANSFER', hit) AS matched_events FROM take_fold WHERE hit IS NOT NULL
)"""


def travel(c: Config) -> str:
    kind = "STRUCT(s BIGINT, la DOUBLE, lo DOUBLE)[]"
    return _order("trav", f"{FINANCIAL} AND NOT (latitude = 0 AND longitude = 0)") + f""", trav_fold(account_id, rn, opens, d, ts_ms, transaction_id, la1, lo1, la2, lo2) AS (
    SELECT DISTINCT account_id, CAST(0 AS BIGINT), CAST([] AS {kind}), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM trav_ev
    UNION ALL
    SELECT account_id, rn, CAST(CASE WHEN len(far) > 0 THEN [] ELSE list_append(live, struct_pack(s := ts_ms, la := latitude, lo := longitude)) END AS {kind}),
           {km("far[1].la", "far[1].lo", "latitude", "longitude")}, ts_ms, transaction_id, far[1].la, far[1].lo, latitude, longitude
    FROM (SELECT *, list_filter(live, lambda o: {km("o.la", "o.lo", "latitude", "longitude")} >= {c.travel_km}) AS far
          FROM (SELECT e.account_id, e.rn, e.ts_ms, e.transaction_id, e.latitude, e.longitude, list_filter(f.opens, lambda o: e.ts_ms - o.s < {c.travel_ms}) AS live
                FROM trav_fold f JOIN trav_ev e ON e.account_id = f.account_id AND e.rn = f.rn + 1))
), travel AS (
    SELECT transaction_id, account_id, ts_ms, 'IMPOSSIBLE_TRAVEL' AS alert_type, CASE WHEN d >= 2000.0 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           least(0.99::DOUBLE, 0.80 + d / 10000.0) AS score,
           printf('Location jump of %.0f km from [%.4f,%.4f] to [%.4f,%.4f] (score=%.2f)', d, la1, lo1, la2, lo2, score) AS details,
           printf('GEO_ANOMALY: %.0f km location jump within {c.travel_ms // 60_000} minutes', d) AS matched_events FROM trav_fold WHERE d IS NOT NULL
)"""


ALERT_COLS = "transaction_id, account_id, ts_ms, alert_type, severity, round(score, 6) AS score, details, matched_events"


def _cep(c: Config) -> str:
    parts = [takeover(c), micro(c), velocity(c), travel(c)]
    union = " UNION ALL ".join(f"SELECT transaction_id, severity, score FROM {n}" for n in ("takeover", "micro", "velocity", "travel"))
    return ", ".join(parts) + f", cep AS (SELECT transaction_id, bool_or(severity = 'CRITICAL') AS crit, max(score) AS best FROM ({union}) GROUP BY transaction_id)"


def marked() -> str:
    """tx with its rule and pattern alerts."""
    return f"""{_cep(SPARSE)}, marked AS (
    SELECT tx.*, coalesce(cep.crit, false) AS cep_crit, cep.transaction_id IS NOT NULL AS cep_any, coalesce(cep.best, 0.0) AS cep_best,
           {R2} AS rule_crit, ({R1} OR {R2} OR {R3}) AS rule_any, list_filter([CASE WHEN {R1} THEN 'RULE_001' END, CASE WHEN {R2} THEN 'RULE_002' END, CASE WHEN {R3} THEN 'RULE_003' END], lambda x: x IS NOT NULL) AS rules
    FROM tx LEFT JOIN cep USING (transaction_id)
)"""


def decisions(scored: str) -> str:
    """Decisions t and alerts a, with scores from a query of (transaction_id, ml)."""
    return f"""scored AS ({scored}), judged AS (
    SELECT m.*, ml, CASE WHEN rule_crit OR cep_crit THEN 'BLOCK' WHEN cep_any THEN 'ALERT' WHEN ml > {SPARSE.block_score} THEN 'BLOCK' WHEN ml > {SPARSE.alert_score} OR rule_any THEN 'ALERT' ELSE 'APPROVE' END AS decision,
           CASE WHEN rule_crit THEN 'RULES_ENGINE' WHEN cep_any THEN 'CEP_ENGINE' WHEN ml > {SPARSE.alert_score} THEN 'ML_SCORING' WHEN rule_any THEN 'RULES_ENGINE' ELSE 'NONE' END AS decision_source
    FROM marked m JOIN scored USING (transaction_id)
), t AS (
    SELECT transaction_id, account_id, card_id, make_timestamp(ts_ms * 1000) AS event_time, amount, event_type, channel, latitude, longitude, merchant_id, 'COMPLETED' AS status,
           CAST(ml AS DOUBLE) AS ml_score, array_to_string(rules, ', ') AS rule_triggered, CASE WHEN decision <> 'APPROVE' THEN 1 ELSE 0 END AS is_fraud, label AS ground_truth_is_fraud, decision, decision_source,
           greatest(CAST(ml AS DOUBLE), cep_best, CASE WHEN rule_crit THEN 0.8 WHEN rule_any THEN 0.6 ELSE 0.0 END) AS combined_score,
           make_timestamp(produced_ms * 1000) AS produced_at, make_timestamp(decided_ms * 1000) AS decided_at
    FROM judged
), a AS (
    SELECT 'FINAL_' || transaction_id AS alert_id, transaction_id, account_id, 'FINAL_' || decision AS alert_type, CASE WHEN decision_source = 'CEP_ENGINE' THEN 'CEP' ELSE decision_source END AS alert_source,
           CASE WHEN decision = 'BLOCK' THEN 'CRITICAL' ELSE 'HIGH' END AS severity, combined_score AS score,
           printf('Final decision=%s, source=%s, combined_score=%.4f, ml_score=%.4f, triggered_rules=%s', decision, decision_source, combined_score, ml_score, CASE WHEN rule_triggered = '' THEN 'none' ELSE rule_triggered END) AS details,
           'Decision Engine priority: Rules > CEP > ML' AS matched_events, event_time, decided_at AS alert_time
    FROM t WHERE decision <> 'APPROVE'
)"""


UNSCORED = "SELECT transaction_id, 0.0::DOUBLE AS ml FROM tx"


def with_tx(query: str, *ctes: str) -> str:
    return f"WITH RECURSIVE {', '.join([TX, *ctes])} {query}"


def over_decisions(query: str, scored: str = UNSCORED, *ctes: str) -> str:
    return with_tx(query, marked(), *ctes, decisions(scored))


def percent(part: str, whole: str) -> str:
    return f"round_even(count(*) FILTER ({part}) * 100.0::DOUBLE / greatest(count(*) FILTER ({whole}), 1), 2)"


GT, FOUND = "ground_truth_is_fraud = 1", "is_fraud = 1"
LATENCY = "(epoch_ms(decided_at) - epoch_ms(produced_at))"
TIMED = "produced_at > TIMESTAMP '1970-01-02' AND decided_at > TIMESTAMP '1970-01-02'"


def since(time: str, span: str, table: str = "t") -> str:
    return f"{time} >= (SELECT max({time}) FROM {table}) - INTERVAL {span}"


def features(source: str = "tx") -> str:
    """`featured`: rolling features of a table by a range self-join, apart from the window form that the library uses."""
    return f"""day AS (SELECT b.transaction_id, count(*) AS n24, count(*) FILTER (b.ts_ms - p.ts_ms <= 3600000) AS n1, round(sum(p.amount), 6) AS s, round(sum(p.amount * p.amount), 6) AS q
        FROM {source} b JOIN {source} p ON p.account_id = b.account_id AND b.ts_ms - p.ts_ms BETWEEN 0 AND 86400000 AND (p.ts_ms < b.ts_ms OR p.transaction_id < b.transaction_id) GROUP BY b.transaction_id),
        prev AS (SELECT transaction_id, lag(ts_ms) OVER w AS l_ms, lag(latitude) OVER w AS la, lag(longitude) OVER w AS lo FROM {source} WINDOW w AS (PARTITION BY account_id ORDER BY ts_ms, transaction_id)),
        base AS (SELECT x.*, coalesce(n1, 0) AS n1, coalesce(n24, 0) AS n24, coalesce(s / n24, 0) AS mean, CASE WHEN n24 > 1 THEN sqrt(greatest(0, q / n24 - (s / n24) * (s / n24))) ELSE 0 END AS std, l_ms, la, lo
                 FROM {source} x LEFT JOIN day USING (transaction_id) JOIN prev USING (transaction_id)),
        featured AS (SELECT transaction_id, n1 AS tx_count_1h, n24 AS tx_count_24h, floor(mean * 100 + 0.5) / 100 AS avg_amount_24h,
            floor(CASE WHEN std > 0 THEN (amount - mean) / std ELSE 0 END * 10000 + 0.5) / 10000 AS amount_deviation, CAST(coalesce(ts_ms - l_ms, 0) AS BIGINT) AS time_since_last_ms,
            floor(CASE WHEN la IS NOT NULL THEN {km("la", "lo", "latitude", "longitude")} ELSE 0 END * 100 + 0.5) / 100 AS distance_km FROM base)"""


def masked_features() -> list[str]:
    """`masked`: features where rows with a critical alert get zeros and are no history to others."""
    zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("tx_count_1h", "tx_count_24h", "avg_amount_24h", "amount_deviation", "time_since_last_ms", "distance_km"))
    return ["counted AS (SELECT * FROM marked WHERE NOT (rule_crit OR cep_crit))", features("counted"), f"masked AS (SELECT transaction_id, {zeros} FROM marked LEFT JOIN featured USING (transaction_id))"]


def forest(trees: list) -> str:
    """Scores (transaction_id, ml) of trees given as data over marked and masked."""
    single = lambda x: f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
    inputs = {
        "amount": single("amount"), "hour_of_day": single(HOUR), "is_foreign": single("CASE WHEN latitude BETWEEN 8.0 AND 23.5 AND longitude BETWEEN 102.0 AND 110.0 THEN 0 ELSE 1 END"),
        "tx_frequency_1h": single("tx_count_1h"), "distance_km": single("distance_km"),
    }

    def value(tree) -> str:
        return f"CASE WHEN {inputs[tree[0]]} <= {tree[1]} THEN {value(tree[2])} ELSE {value(tree[3])} END" if isinstance(tree, tuple) else f"{tree}::DOUBLE"

    mean = f"({' + '.join(['0.0::DOUBLE', *map(value, trees)])}) / {len(trees)}"
    return f"SELECT transaction_id, CASE WHEN rule_crit OR cep_crit THEN 0.0 ELSE floor({mean} * 1000000 + 0.5) / 1000000 END AS ml FROM marked JOIN masked USING (transaction_id)"
