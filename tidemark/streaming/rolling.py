"""Transactions judged in one stateful operator: pattern alerts and rolling features without a scan of history.

An account's windows of 1 h and 24 h slide with its events: running totals take in what comes and give back what leaves. What
leaves is read from the events of single minutes, kept under their minute, so an event is written once and read twice (when it
leaves either window), however many its windows hold.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

import tidemark.config
from tidemark.config import DAY, HOUR, MINUTE, Config
from tidemark.operators.decisions import decide
from tidemark.operators.features import MADE, finished, has_place
from tidemark.operators.rules import apply_rules
from tidemark.operators.scoring import Scorer, no_model
from tidemark.operators.storage import stored_decisions
from tidemark.streaming import job

EXACT = 1074  # any finite double is a whole number of 2 ** -EXACT
_PACKED = np.dtype([("ms", "<i8"), ("amount", "<f8")])
_TOTALS = (
    "left_hour long, left_day long, n_hour long, n_day long, total string, odd long, squares string, odd_squares long, "
    "last_ms long, place_ms long, lat double, lon double, minutes binary, timer long"
)
_WAITING = job._EVENT + ", aside boolean, known boolean, placed boolean, payload string"
_JUDGED = "payload string, cep_alerts array<struct<alert_type:string,severity:string,score:double>>, late boolean, _ms long, _counted boolean, " + ", ".join(f"{c} {k}" for c, k in MADE)
_JUDGED_NAMES = ["payload", "cep_alerts", "late", "_ms", "_counted", *(c for c, _ in MADE)]
NONE = -1  # in place of a time


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


class Total:
    """A sum of doubles that takes any of them out again without an error: a whole number of 2 ** -EXACT. Values that are not
    finite are counted, and while there are any the sum is NaN."""

    def __init__(self, whole: int = 0, odd: int = 0):
        self.whole, self.odd = whole, odd

    def add(self, value: float, sign: int) -> None:
        if math.isfinite(value):
            above, below = value.as_integer_ratio()
            self.whole += sign * (above << (EXACT + 1 - below.bit_length()))
        else:
            self.odd += sign

    def value(self) -> float:
        if self.odd:
            return math.nan
        try:
            return self.whole / (1 << EXACT)
        except OverflowError:
            return math.copysign(math.inf, self.whole)


class Rolling:
    """An account's windows, from its state: `totals`, one row, and `minutes`, the events of each minute of the last day."""

    def __init__(self, totals, minutes, keep_ms: int | None):
        self.totals, self.minutes, self.keep_ms = totals, minutes, keep_ms
        row = dict(zip(_names(_TOTALS), totals.get())) if totals.exists() else None
        at = row or {"left_hour": 0, "left_day": 0, "n_hour": 0, "n_day": 0, "total": "0", "odd": 0, "squares": "0", "odd_squares": 0, "last_ms": NONE, "place_ms": NONE, "lat": 0.0, "lon": 0.0, "minutes": b"", "timer": NONE}
        self.left, self.n = [int(at["left_hour"]), int(at["left_day"])], [int(at["n_hour"]), int(at["n_day"])]
        self.total, self.squares = Total(int(at["total"], 16), int(at["odd"])), Total(int(at["squares"], 16), int(at["odd_squares"]))
        self.last_ms, self.place_ms, self.lat, self.lon, self.timer = int(at["last_ms"]), int(at["place_ms"]), float(at["lat"]), float(at["lon"]), int(at["timer"])
        self.present = np.frombuffer(bytes(at["minutes"]), "<i8").tolist()
        self.read: dict[int, np.ndarray] = {}

    def _minute(self, minute: int) -> np.ndarray:
        if minute not in self.read:
            self.read[minute] = np.frombuffer(bytes(self.minutes.getValue((minute,))[0]), _PACKED)
        return self.read[minute]

    def _stored(self, low: int, high: int) -> list[tuple[int, float]]:
        """Events from low to before high, in order; of the minutes between, the two at the edges are read in part."""
        out = []
        for minute in self.present:
            if minute * MINUTE < high and (minute + 1) * MINUTE > low:
                rows = self._minute(minute)
                a, b = np.searchsorted(rows["ms"], (low, high), "left")
                out += zip(rows["ms"][a:b].tolist(), rows["amount"][a:b].tolist())
        return out

    def take(self, events: list[tuple]) -> list[tuple]:
        """Values of MADE for events (ms, counted, known, placed, amount, latitude, longitude) in order, none before those taken
        earlier: what came before each of them. Those that count are then history to others."""
        out, fresh, spans, at = [], [], (HOUR, DAY), [0, 0]
        leaving = [self._stored(left, events[-1][0] - span) for left, span in zip(self.left, spans)] if events else []
        for ms, counted, known, placed, amount, lat, lon in events:
            for w, span in enumerate(spans):
                queue, edge = leaving[w], ms - span
                while at[w] < len(queue) and queue[at[w]][0] < edge:
                    self.n[w] -= 1
                    if span == DAY:
                        gone = queue[at[w]][1]
                        self.total.add(gone, -1)
                        self.squares.add(gone * gone, -1)
                    at[w] += 1
                self.left[w] = max(self.left[w], edge)
            reach = ms - self.keep_ms if self.keep_ms is not None else 0
            last = self.last_ms if self.last_ms != NONE and self.last_ms >= reach else None
            lies = self.place_ms != NONE and self.place_ms >= reach
            out.append((self.n[0], self.n[1], self.total.value(), self.squares.value(), last, self.lat if lies else None, self.lon if lies else None))
            if not counted:
                continue
            self.last_ms = ms
            if placed:
                self.place_ms, self.lat, self.lon = ms, lat, lon
            if known:
                self.n = [n + 1 for n in self.n]
                self.total.add(amount, 1)
                self.squares.add(amount * amount, 1)
                fresh.append((ms, amount))
                for queue in leaving:
                    queue.append((ms, amount))
        self._write(fresh)
        return out

    def _write(self, fresh: list[tuple[int, float]]) -> None:
        rows = np.array(fresh, _PACKED)
        rows = rows[rows["ms"] >= self.left[1]]
        minute = rows["ms"] // MINUTE
        for m in np.unique(minute).tolist():
            new = rows[minute == m]
            if m in self.present:
                new = np.concatenate((self._minute(m), new))
            else:
                self.present.append(m)
            self.minutes.updateValue((m,), (new.tobytes(),))
        self._forget(self.left[1])

    def _forget(self, before: int) -> None:
        """Drops minutes that end before a time."""
        gone = [m for m in self.present if (m + 1) * MINUTE <= before]
        for m in gone:
            self.minutes.removeKey((m,))
        self.present = [m for m in self.present if (m + 1) * MINUTE > before]

    def lasting(self) -> int | None:
        """When all of the state that expires will have; None if there is none."""
        if self.keep_ms is None:
            return (self.present[-1] + 1) * MINUTE + DAY if self.present else None
        return self.last_ms + max(DAY, self.keep_ms) + 1 if self.last_ms != NONE else None

    def settle(self, frontier: int) -> None:
        """Saves the state, less what no event at `frontier` or later reads."""
        end = self.lasting()
        if end is not None and frontier >= end:
            self._forget(frontier)
            self.n, self.total, self.squares = [0, 0], Total(), Total()
            if self.keep_ms is not None:
                self.last_ms = self.place_ms = NONE
        if self.last_ms == NONE:
            self.totals.clear()
            return
        self.totals.update((
            *self.left, *self.n, f"{self.total.whole:x}", self.total.odd, f"{self.squares.whole:x}", self.squares.odd, self.last_ms, self.place_ms, self.lat, self.lon,
            np.array(self.present, "<i8").tobytes(), self.timer,
        ))


class Judging(job.Merging):
    """Transactions with their alerts and features, each given out once: when the watermark has passed the longest run that
    could still raise an alert on it, so that what is critical is known and no history to others. Without patterns the
    watermark need only pass the transaction. Events behind the watermark are given out at once, marked late, without either."""

    def __init__(self, config: Config, patterns: bool, keep_ms: int | None):
        super().__init__(config)
        self.keep_ms = keep_ms
        self.patterns = self.patterns if patterns else []
        self.wait_ms = max(config.micro_ms, config.velocity_ms) if patterns else 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.open, self.recent = handle.getListState("waiting", _WAITING), handle.getListState("open", self.opens), handle.getListState("recent", _WAITING + ", alerts string")
        self.totals, self.minutes = handle.getValueState("totals", _TOTALS), handle.getMapState("minutes", "minute long", "events binary")

    def window_ms(self) -> int:
        return max((p.window_ms() for p in self.patterns), default=0)

    def _advance(self, key, events: list[tuple], now: int) -> pd.DataFrame:
        names = _names(_WAITING)
        out, timers = [], []
        due, later = sorted((e for e in events if e[0] < now), key=lambda e: e[:2]), [e for e in events if e[0] >= now]
        held: list[list[list]] = [[] for _ in self.patterns]
        for pattern, _, rest in self.open.get() if self.open.exists() else ():
            held[pattern].append(json.loads(rest))
        recent = {(int(r[0]), r[1]): (tuple(r[:-1]), json.loads(r[-1])) for r in (self.recent.get() if self.recent.exists() else ())}
        for e in due:
            recent[e[0], e[1]] = (e, [])
            for transaction, at, alert in self._match(dict(zip(names, e)), held):
                if (at, transaction) in recent:
                    recent[at, transaction][1].append(alert)
        settled = sorted(k for k in recent if k[0] + self.wait_ms < now)
        rolling, taken = Rolling(self.totals, self.minutes, self.keep_ms), []
        for k in settled:
            e, alerts = recent.pop(k)
            row = dict(zip(names, e))
            counted = not row["aside"] and all(a[1] != "CRITICAL" for a in alerts)
            taken.append((k[0], counted, counted and row["known"], counted and row["placed"], row["amount"], row["latitude"], row["longitude"]))
            out.append([row["payload"], [dict(zip(("alert_type", "severity", "score"), a)) for a in alerts], False, k[0], counted])
        for row, made in zip(out, rolling.take(taken)):
            row += made
        open_rows = self._opened(held, now)
        for state, rows in ((self.waiting, later), (self.open, open_rows), (self.recent, [(*e, json.dumps(a)) for e, a in recent.values()])):
            state.put(rows) if rows else state.clear()
        if later:
            timers.append(min(e[0] for e in later) + 1)
        if recent:
            timers.append(min(recent)[0] + self.wait_ms + 1)
        elif open_rows and not later:
            timers.append(max(at for _, at, _ in open_rows) + self.window_ms())
        end = rolling.lasting()
        if end is not None and rolling.timer <= now < end + self.wait_ms:  # one at a time: when it is there, the next is set
            rolling.timer = end + self.wait_ms
            timers.append(rolling.timer)
        rolling.settle(now - self.wait_ms)
        for at in timers:
            self.handle.registerTimer(int(at))
        return pd.DataFrame(out, columns=_JUDGED_NAMES)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        new = [(int(e[0]), e[1], e[2], float(e[3]), e[4], float(e[5]), float(e[6]), bool(e[7]), bool(e[8]), bool(e[9]), e[10]) for e in pd.concat(list(rows))[_names(_WAITING)].itertuples(index=False)]
        behind = [e for e in new if e[0] <= 0 or e[0] < now]
        if behind:
            yield pd.DataFrame([[e[-1], [], e[0] > 0, e[0], False, 0, 0, 0.0, 0.0, None, None, None] for e in behind], columns=_JUDGED_NAMES)
        old = [tuple(e) for e in self.waiting.get()] if self.waiting.exists() else []
        yield self._advance(key, old + [e for e in new if e[0] > 0 and e[0] >= now], now)


def _judged(tx: DataFrame, aside: Column, processor: Judging) -> DataFrame:
    for module in (sys.modules[__name__], job, tidemark.config):
        cloudpickle.register_pickle_by_value(module)
    number = lambda c: F.coalesce(c, F.lit(float("nan"))).alias(c)
    marked = job.with_watermark(tx.withColumn("payload", F.to_json(F.struct(*tx.columns)))).where(F.col("event_ts") > F.lit("0001-01-01").cast("timestamp"))
    # without the watermark's column Spark does not drop late rows before the operator has marked them
    rows = marked.select(
        "account_id", F.col("ts_ms").cast("long").alias("ts_ms"), "transaction_id", "event_type", number("amount"), "merchant_id", number("latitude"), number("longitude"),
        F.coalesce(aside, F.lit(False)).alias("aside"), F.col("amount").isNotNull().alias("known"), has_place().alias("placed"), "payload",
    )
    out = rows.groupBy("account_id").transformWithStateInPandas(statefulProcessor=processor, outputStructType=_JUDGED, outputMode="Append", timeMode="EventTime")
    return out.withColumn("t", F.from_json("payload", tx.schema)).select("t.*", *_JUDGED_NAMES[1:])


def streaming_features(tx: DataFrame, masked: Column | None = None, keep_ms: int | None = 25 * HOUR) -> DataFrame:
    """The stream tx with `late` and the FEATURES that rolling_features() gives with the same masked and keep_ms, each row once the watermark
    has passed it; needs the RocksDB state store.

    The state of an account is at most the times and amounts of a day, by minute, and one row of totals; with keep_ms it is gone that long
    (a day at least) after the last event. Rows behind the watermark are marked late, rows without a time are not; both have zeros and
    are no history. A message that comes again while the first waits counts once. Non-finite amounts make the sums of their day NaN.
    """
    rows = _judged(tx, F.lit(False) if masked is None else masked, Judging(Config(), False, keep_ms))
    return finished(rows.drop("cep_alerts"), [*tx.columns, "late"])


def judged_stream(tx: DataFrame, config: Config, keep_ms: int | None = 25 * HOUR) -> DataFrame:
    """The stream tx (with rule_alerts) with cep_alerts, `late` and FEATURES, as attach() and rolling_features() give them to a batch, each
    row once: after the longest run's window, when no alert can come on it any more. What is critical by a rule or a
    pattern has zeros and is no history. Late rows and rows without a time have rule alerts alone."""
    critical = F.exists("rule_alerts", lambda a: a["severity"] == "CRITICAL") if "rule_alerts" in tx.columns else F.lit(False)
    return finished(_judged(tx, critical, Judging(config, True, keep_ms)), [*tx.columns, "cep_alerts", "late"])


def decided_stream(tx: DataFrame, rules: DataFrame, config: Config, scorer: Scorer = no_model, keep_ms: int | None = 25 * HOUR) -> DataFrame:
    """A decision for every transaction of the stream tx, as assess() gives to a batch, once and without reading history. `rules` are those in
    force (latest_rules()) when the stream starts; run_decisions() reads rules anew for each batch."""
    judged = judged_stream(apply_rules(tx, rules), config, keep_ms)
    return decide(scorer(judged.withColumn("decided_ms", F.unix_millis(F.current_timestamp()))), config)


def run_judged(
    spark: SparkSession, tx: DataFrame, rules: DataFrame, out: str, checkpoint: str, config: Config, scorer: Scorer = no_model, keep_ms: int | None = 25 * HOUR, trigger: dict | None = None
) -> StreamingQuery:
    """Writes decided_stream() to the tables that run_decisions() writes, with their readers (job.current_decisions() and the like). A batch
    costs what its own transactions cost, however much is stored: no history is kept or read, and no decision is revised; the price is
    the wait for the longest run's window. Messages that parse_transactions() rejects are a stream of their own."""
    decisions = job.decisions_table(spark, out)

    def file(batch: DataFrame, number: int) -> None:
        if number <= decisions.last_batch():
            return
        new = stored_decisions(batch).persist()
        job.file_decisions(spark, out, new, new.where("false"), number)
        new.unpersist()

    made = decided_stream(tx, rules, config, scorer, keep_ms)
    return made.writeStream.foreachBatch(file).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
