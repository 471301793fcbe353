"""Four behavioural patterns over an account's events in time order.

Accounts are cut into slices of time that reach back by a halo, so one exchange and one sort serve all patterns and a busy
account spreads over many tasks; `matching` works on whole slices. Ties in time go by transaction id. An alert row names the transaction it is raised on. The words of
details and matched_events are fixed values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.scalars import haversine_km, valid_coordinates
from tidemark.operators import matching as M
from tidemark.operators.slices import over_slices, sliced

FINANCIAL = ("TRANSFER", "PAYMENT", "WITHDRAWAL")
LOGINS = ("LOGIN_FAILED", "LOGIN_SUCCESS", "TRANSFER")  # kinds 1, 2, 3
ALERT = ["transaction_id", "account_id", "ts_ms", "alert_type", "severity", "score", "details", "matched_events"]
TAKEOVER, MICRO, VELOCITY, TRAVEL = PATTERNS = ("ACCOUNT_TAKEOVER", "MICRO_TRANSACTIONS", "VELOCITY_ATTACK", "IMPOSSIBLE_TRAVEL")
SLICE_HALOS = 4  # halos in a slice: a fifth of what tasks read are copies

_MATCH = """account_id string, slice long, pattern string, transaction_id string, ts_ms long, lo int, hi int, n int, amount double, total double, span long,
    merchants int, lat1 double, lon1 double, lat2 double, lon2 double"""
_STEP = "account_id string, slice long, pattern string, bounds array<int>, outs array<int>"
_COLUMNS = ["account_id", "slice", "own", "ts_ms", "transaction_id", "login", "located", "micro", "fast", "amount", "latitude", "longitude", "merchant_id"]


def _halo(config: Config, kinds: tuple[str, ...]) -> int:
    """How far a slice reads back. The runs that hold an event are told apart within two windows."""
    return max({TAKEOVER: config.takeover_ms, MICRO: 2 * config.micro_ms, VELOCITY: 2 * config.velocity_ms, TRAVEL: config.travel_ms}[k] for k in kinds)


def _relevant(tx: DataFrame, config: Config, kinds: tuple[str, ...]) -> DataFrame:
    """The events that patterns look at, in slices, with what each is to them."""
    financial, amount = F.col("event_type").isin(*FINANCIAL), F.col("amount")
    login = F.coalesce(*(F.when(F.col("event_type") == k, i) for i, k in enumerate(LOGINS, 1)), F.lit(0)) if TAKEOVER in kinds else F.lit(0)
    marks = {
        "located": (TRAVEL, financial & valid_coordinates(F.col("latitude"), F.col("longitude"))), "micro": (MICRO, financial & (amount < config.micro_amount)),
        "fast": (VELOCITY, F.col("event_type").isin("TRANSFER", "PAYMENT") & amount.between(config.velocity_low, config.velocity_high)),
    }
    marked = {name: F.coalesce(mark, F.lit(False)) if kind in kinds else F.lit(False) for name, (kind, mark) in marks.items()}
    rows = tx.select("account_id", "ts_ms", "transaction_id", login.alias("login"), *(m.alias(c) for c, m in marked.items()), "amount", "latitude", "longitude", "merchant_id")
    halo = _halo(config, kinds)
    rows = rows.where((F.col("login") > 0) | F.col("located") | F.col("micro") | F.col("fast"))
    # the columns behind the id order only rows that repeat one
    cut = sliced(rows, "ts_ms", halo, SLICE_HALOS * halo, ["ts_ms", "transaction_id", "login", "amount", "latitude", "longitude", "merchant_id", "located", "micro", "fast"])
    return cut.select(_COLUMNS)


class _Slices:
    """The events of whole slices, and what the patterns find in them."""

    def __init__(self, table: pa.Table, number: np.ndarray, config: Config):
        self.table, self.config = table.combine_chunks(), config
        self.events = M.Events(number, self.get("own"), self.get("ts_ms"))

    def get(self, name: str) -> np.ndarray:  # no closure over self: a cycle would keep the table until the collector runs
        return self.table.column(name).to_numpy()

    def takeover(self) -> tuple[np.ndarray, M.Chain, np.ndarray]:
        c, rows = self.config, np.flatnonzero(self.get("login") > 0)
        return rows, *M.takeover(self.events.take(rows), self.get("login")[rows], c.takeover_failures, c.takeover_most, c.takeover_ms)

    def travel(self) -> tuple[np.ndarray, M.Chain]:
        rows = np.flatnonzero(self.get("located"))
        return rows, M.travel(self.events.take(rows), self.get("latitude")[rows], self.get("longitude")[rows], self.config.travel_km, self.config.travel_ms)

    def runs(self, mark: str, n: int, window_ms: int) -> tuple[np.ndarray, dict]:
        """Events in runs, and what is told of the runs."""
        rows = np.flatnonzero(self.get(mark))
        found = M.runs(self.events.take(rows), n, window_ms)
        amount, at = self.get("amount")[rows], self.events.at[rows]
        total = np.zeros(len(found.event))
        for k in range(n):
            total = total + amount[found.start + k]
        codes = self.table.column("merchant_id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[rows]
        held = np.sort(codes[found.start[:, None] + np.arange(n)], axis=1)
        merchants = (held >= 0).sum(axis=1) - ((held[:, 1:] == held[:, :-1]) & (held[:, 1:] >= 0)).sum(axis=1)
        return rows[found.event], {"n": np.full(len(total), n), "total": total, "span": at[found.start + n - 1] - at[found.start], "merchants": merchants}

    def matches(self, kinds: tuple[str, ...]) -> Iterator[tuple[str, np.ndarray, dict]]:
        """(pattern, rows, what is told of each)."""
        c = self.config
        if TAKEOVER in kinds:
            rows, found, n = self.takeover()
            at = rows[found.event]
            yield TAKEOVER, at, {"lo": found.lo, "hi": found.hi, "n": n, "amount": self.get("amount")[at]}
        if MICRO in kinds:
            yield MICRO, *self.runs("micro", c.micro_count, c.micro_ms)
        if VELOCITY in kinds:
            yield VELOCITY, *self.runs("fast", c.velocity_count, c.velocity_ms)
        if TRAVEL in kinds:
            rows, found = self.travel()
            at, start, lat, lon = rows[found.event], rows[found.start], self.get("latitude"), self.get("longitude")
            yield TRAVEL, at, {"lo": found.lo, "hi": found.hi, "lat1": lat[start], "lon1": lon[start], "lat2": lat[at], "lon2": lon[at]}

    def table_of(self, kinds: tuple[str, ...]) -> pa.RecordBatch:
        """Matches as rows of _MATCH."""
        parts = list(self.matches(kinds))
        at = np.concatenate([rows for _, rows, _ in parts])
        out = {k: self.table.column(k).combine_chunks().take(pa.array(at)) for k in ("account_id", "slice", "transaction_id", "ts_ms")}
        out["pattern"] = pa.array([p for p, rows, _ in parts for _ in range(len(rows))], pa.string())
        for name, kind, default in (("lo", pa.int32(), 0), ("hi", pa.int32(), M.NONE), ("n", pa.int32(), 0), ("span", pa.int64(), 0), ("merchants", pa.int32(), 0), *((c, pa.float64(), 0.0) for c in ("amount", "total", "lat1", "lon1", "lat2", "lon2"))):
            out[name] = pa.array(np.concatenate([told.get(name, np.full(len(rows), default)) for _, rows, told in parts]), kind)
        names = [f.split()[0] for f in _MATCH.split(",")]
        return pa.RecordBatch.from_arrays([out[n] for n in names], names)

    def steps_of(self, kinds: tuple[str, ...]) -> pa.RecordBatch:
        """Steps of the chained patterns as rows of _STEP."""
        found = []
        for pattern, work in ((TAKEOVER, self.takeover), (TRAVEL, self.travel)):
            if pattern in kinds:
                rows, made = work()[:2]
                own = self.events.take(rows)
                found += [(int(rows[own.begin[g]]), pattern, bounds, outs) for g, bounds, outs in made.steps]
        at, patterns, bounds, outs = zip(*found) if found else ((), (), (), ())
        rows = pa.array(at, pa.int64())
        lists = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [self.table.column("account_id").combine_chunks().take(rows), self.table.column("slice").combine_chunks().take(rows), pa.array(patterns, pa.string()), pa.array(bounds, lists), pa.array(outs, lists)],
            ["account_id", "slice", "pattern", "bounds", "outs"],
        )


def _entries(steps: DataFrame) -> DataFrame:
    """(account_id, pattern, slice, back): the last match before a slice, where the slice before has one. A row a slice is read in
    order for each account; only the row before is kept."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, back = None, M.NONE
        for batch in batches:
            out = []
            for account, at, pattern, bounds, outs in zip(*(c.to_pylist() for c in batch.columns)):
                if before != (account, pattern, at - 1):
                    back = M.NONE
                if back != M.NONE:
                    out.append((account, at, pattern, back))
                back = next((o for b, o in zip(bounds, outs) if b < back), M.NONE)
                before = (account, pattern, at)
            rows = zip(*out) if out else ((), (), (), ())
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["account_id", "slice", "pattern", "back"])

    ordered = steps.repartition("account_id", "pattern").sortWithinPartitions("account_id", "pattern", "slice")
    return ordered.mapInArrow(walk, "account_id string, slice long, pattern string, back int")


def _matches(tx: DataFrame, config: Config, kinds: tuple[str, ...]) -> DataFrame:
    """The matches of some patterns, as rows of _MATCH."""
    cut = _relevant(tx, config, kinds)
    found = over_slices(cut, lambda table, number: _Slices(table, number, config).table_of(kinds), _MATCH)
    if not {TAKEOVER, TRAVEL} & set(kinds):
        return found
    steps = over_slices(cut, lambda table, number: _Slices(table, number, config).steps_of(kinds), _STEP)
    entries = _entries(steps).select(F.col("account_id").alias("_account"), F.col("pattern").alias("_pattern"), F.col("slice").alias("_slice"), "back")
    same = F.col("account_id").eqNullSafe(F.col("_account")) & (F.col("pattern") == F.col("_pattern")) & (F.col("slice") == F.col("_slice"))
    back = F.coalesce("back", F.lit(M.NONE))
    return found.join(entries, same, "left").where((F.col("lo") < back) & (back <= F.col("hi"))).select(found.columns)


def detect(tx: DataFrame, config: Config, kinds: tuple[str, ...] = PATTERNS) -> DataFrame:
    """The alerts of all four patterns, or of some.

    ACCOUNT_TAKEOVER: takeover_failures or more LOGIN_FAILED (takeover_most at most), then LOGIN_SUCCESS, then TRANSFER, all within takeover_ms: one alert,
    on the transfer. The earliest open attempt wins, and a match ends all others.
    MICRO_TRANSACTIONS: every run of micro_count consecutive small financial events within micro_ms: an alert on each of its events.
    VELOCITY_ATTACK: every run of velocity_count consecutive medium transfers or payments within velocity_ms, likewise.
    IMPOSSIBLE_TRAVEL: a located financial event, then one travel_km or more away within travel_ms: one alert, on the second. The earliest open
    start wins; a match uses up all open starts and its own event.
    """
    n, total, merchants, c = F.col("n"), F.col("total"), F.col("merchants"), config
    km = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    found = _matches(tx, config, kinds).withColumn("km", F.when(F.col("pattern") == TRAVEL, km).otherwise(0.0))
    capped = lambda most, score: F.least(F.lit(most), score)
    score = {TAKEOVER: capped(0.99, 0.80 + n * 0.03), MICRO: capped(0.98, 0.75 + n * 0.03), VELOCITY: capped(0.95, 0.70 + n * 0.05), TRAVEL: capped(0.99, 0.80 + F.col("km") / 10000.0)}
    severity = {
        TAKEOVER: F.when(n >= 7, "CRITICAL").otherwise("HIGH"), MICRO: F.when((n >= 10) | (merchants >= 3), "CRITICAL").when(merchants <= 1, "MEDIUM").otherwise("HIGH"),
        VELOCITY: F.when((n >= 5) | (F.col("span") <= 1000), "CRITICAL").otherwise("HIGH"), TRAVEL: F.when(F.col("km") >= 2000.0, "CRITICAL").otherwise("HIGH"),
    }
    details = {
        TAKEOVER: F.format_string("Brute force: %d failed logins followed by transfer of $%.2f (score=%.2f)", n, "amount", score[TAKEOVER]),
        MICRO: F.format_string(f"%d small transactions under ${c.micro_amount:.0f} in {c.micro_ms // 60_000} mins, total: $%.2f, distinct merchants: %d (score=%.2f)", n, total, merchants, score[MICRO]),
        VELOCITY: F.format_string(
            f"%d rapid medium-value transactions in %.2fs, total: $%.2f (amount range ${c.velocity_low:.0f}-${c.velocity_high:.0f}, score=%.2f)", n, F.col("span") / 1000.0, total, score[VELOCITY]
        ),
        TRAVEL: F.format_string("Location jump of %.0f km from [%.4f,%.4f] to [%.4f,%.4f] (score=%.2f)", "km", "lat1", "lon1", "lat2", "lon2", score[TRAVEL]),
    }
    matched = {
        TAKEOVER: F.format_string("LOGIN_FAILED x%d -> LOGIN_SUCCESS -> TRANSFER", n),
        MICRO: F.lit(f"TRANSFER/PAYMENT < ${c.micro_amount:.0f} x{c.micro_count} within {c.micro_ms // 60_000} minutes"),
        VELOCITY: F.lit(f"TRANSFER/PAYMENT ${c.velocity_low:.0f}-${c.velocity_high:.0f} x{c.velocity_count} within {c.velocity_ms // 1000} seconds"),
        TRAVEL: F.format_string(f"GEO_ANOMALY: %.0f km location jump within {c.travel_ms // 60_000} minutes", "km"),
    }
    pick = lambda of: F.coalesce(*(F.when(F.col("pattern") == k, of[k]) for k in kinds))
    made = {"severity": severity, "score": score, "details": details, "matched_events": matched}
    alert_id = F.concat_ws("|", "pattern", "transaction_id").alias("alert_id")
    return found.select("transaction_id", "account_id", "ts_ms", F.col("pattern").alias("alert_type"), *(pick(of).alias(name) for name, of in made.items()), alert_id)


def account_takeover(tx: DataFrame, config: Config) -> DataFrame:
    return detect(tx, config, (TAKEOVER,))


def micro_transactions(tx: DataFrame, config: Config) -> DataFrame:
    return detect(tx, config, (MICRO,))


def velocity(tx: DataFrame, config: Config) -> DataFrame:
    return detect(tx, config, (VELOCITY,))


def impossible_travel(tx: DataFrame, config: Config) -> DataFrame:
    return detect(tx, config, (TRAVEL,))


def travel_candidates(tx: DataFrame, config: Config) -> DataFrame:
    """All pairs that could be an impossible travel if no event were used up: a range self-join in time slices of travel_ms."""
    located = tx.where(F.col("event_type").isin(*FINANCIAL) & valid_coordinates(F.col("latitude"), F.col("longitude"))).withColumn("slice", F.floor(F.col("ts_ms") / config.travel_ms))
    a = located.select("account_id", F.explode(F.array(F.col("slice"), F.col("slice") + 1)).alias("slice"), F.col("transaction_id").alias("first_id"), F.col("ts_ms").alias("first_ms"), F.col("latitude").alias("lat1"), F.col("longitude").alias("lon1"))
    gap, km = F.col("ts_ms") - F.col("first_ms"), haversine_km(F.col("lat1"), F.col("lon1"), F.col("latitude"), F.col("longitude"))
    later = (gap > 0) | ((gap == 0) & (F.col("transaction_id") > F.col("first_id")))
    return located.join(a, ["account_id", "slice"]).where(later & (gap < config.travel_ms)).withColumn("km", km).where(F.col("km") >= config.travel_km).select("account_id", "first_id", F.col("transaction_id").alias("second_id"), "km")


NO_ALERTS = "array<struct<alert_type:string,severity:string,score:double,details:string>>"


def attach(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """tx with `cep_alerts`, the alerts of each transaction by type; every row stays. An alert belongs to the transaction of its
    id, account and time, so a repeated id gets no alerts of the other."""
    same = ["transaction_id", "account_id", "ts_ms"]
    rows = alerts.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("alert_type", "severity", "score", "details"))).alias("cep_alerts"))
    return tx.join(rows, same, "left").withColumn("cep_alerts", F.coalesce("cep_alerts", F.array().cast(NO_ALERTS)))
