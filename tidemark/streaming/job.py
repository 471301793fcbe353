"""The pipeline as Structured Streaming jobs: stateful patterns, decisions by micro-batch, running summaries.

Sources and sinks are given as DataFrames and paths; with a Kafka connector on the class path the same functions take
`spark.readStream.format("kafka")` frames, whose `value` column they read.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

import tidemark.config
from tidemark.config import DAY, HOUR, Config
from tidemark.functions.scalars import from_millis
from tidemark.operators import decisions as D
from tidemark.operators import storage
from tidemark.operators.patterns import attach, detect
from tidemark.operators.rules import apply_rules, latest_rules
from tidemark.operators.scoring import Scorer, no_model
from tidemark.operators.versions import VersionedTable
from tidemark.plans.risk import resolve
from tidemark.sources.transactions import parse_transactions, read_rule_log

LATE, LATE_MS = "5 seconds", 5000


def longest_window(config: Config) -> int:
    """How far an event reaches to earlier ones of its account by patterns, in ms."""
    return max(config.takeover_ms, config.micro_ms, config.velocity_ms, config.travel_ms)


def history_ms(config: Config) -> int:
    """History that a transaction is judged with: the 24 h of the features and one more, or the longest pattern window."""
    return max(25 * HOUR, longest_window(config))


def with_watermark(tx: DataFrame) -> DataFrame:
    """tx with its event time as a timestamp under the lateness bound."""
    return tx.withColumn("event_ts", F.timestamp_millis("ts_ms")).withWatermark("event_ts", LATE)


_FINANCIAL = ("TRANSFER", "PAYMENT", "WITHDRAWAL")
_FOUND = "transaction_id string, account_id string, ts_ms long, alert_type string, severity string, score double"
_EVENT = "ts_ms long, transaction_id string, event_type string, amount double, merchant_id string, latitude double, longitude double"


class InOrder(StatefulProcessor):
    """An account's events in event-time order, whatever batches bring them: events wait until the watermark has passed them, so that
    disorder within the lateness bound shows nowhere. `open` holds what later events may complete, until it expires."""

    opens: str  # the schema of an open attempt, whose first field is its time

    def __init__(self, config: Config):
        self.config = config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.open = handle.getListState("waiting", _EVENT), handle.getListState("open", self.opens)

    def window_ms(self) -> int:
        raise NotImplementedError

    def step(self, held: list[list], e: dict) -> tuple[list[list], list[tuple]]:
        """What is open after an event, and the (transaction_id, ts_ms, alert_type, severity, score) that it raises."""
        raise NotImplementedError

    def _advance(self, key, events: list[tuple], now: int) -> pd.DataFrame:
        """Takes the events that the watermark has passed, in order."""
        names = [f.split()[0] for f in _EVENT.split(", ")]
        due, later, found = sorted(e for e in events if e[0] < now), [e for e in events if e[0] >= now], []
        held = [list(o) for o in self.open.get()] if self.open.exists() else []
        for e in due:
            held = [o for o in held if e[0] - o[0] < self.window_ms()]
            held, raised = self.step(held, dict(zip(names, e)))
            found += [(r[0], key[0], *r[1:]) for r in raised]
        held = [o for o in held if now - o[0] < self.window_ms()]
        for state, rows in ((self.waiting, later), (self.open, held)):
            state.put([tuple(r) for r in rows]) if rows else state.clear()
        if later or held:  # the next event to be taken, or the last attempt's end
            self.handle.registerTimer(int(min(e[0] for e in later) + 1 if later else held[-1][0] + self.window_ms()))
        return pd.DataFrame(found, columns=[f.split()[0] for f in _FOUND.split(", ")])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[[f.split()[0] for f in _EVENT.split(", ")]]
        new = [(int(e[0]), e[1], e[2], float(e[3]), e[4], float(e[5]), float(e[6])) for e in new.itertuples(index=False)]
        old = [tuple(e) for e in self.waiting.get()] if self.waiting.exists() else []
        yield self._advance(key, old + new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        old = [tuple(e) for e in self.waiting.get()] if self.waiting.exists() else []
        yield self._advance(key, old, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class Takeover(InOrder):
    opens = "at long, n int, done boolean"

    def window_ms(self) -> int:
        return self.config.takeover_ms

    def step(self, held: list[list], e: dict) -> tuple[list[list], list[tuple]]:
        c, kind = self.config, e["event_type"]
        if kind == "LOGIN_FAILED":
            held = [[at, n + (not done and n < c.takeover_most), done] for at, n, done in held] + [[e["ts_ms"], 1, False]]
        elif kind == "LOGIN_SUCCESS":
            held = [[at, n, done or n >= c.takeover_failures] for at, n, done in held]
        elif ready := [o for o in held if o[2]]:
            n = int(ready[0][1])
            return [], [(e["transaction_id"], e["ts_ms"], "ACCOUNT_TAKEOVER", "CRITICAL" if n >= 7 else "HIGH", min(0.99, 0.80 + n * 0.03))]
        return held, []


class Travel(InOrder):
    opens = "at long, lat double, lon double"

    def window_ms(self) -> int:
        return self.config.travel_ms

    @staticmethod
    def _km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
        from math import atan2, cos, radians, sin, sqrt

        a = sin(radians(lat2 - lat1) / 2) ** 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2
        return 2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a))

    def step(self, held: list[list], e: dict) -> tuple[list[list], list[tuple]]:
        c = self.config
        far = [km for o in held if (km := self._km(o[1], o[2], e["latitude"], e["longitude"])) >= c.travel_km]
        if far:
            return [], [(e["transaction_id"], e["ts_ms"], "IMPOSSIBLE_TRAVEL", "CRITICAL" if far[0] >= 2000.0 else "HIGH", min(0.99, 0.80 + far[0] / 10000.0))]
        return [*held, [e["ts_ms"], e["latitude"], e["longitude"]]], []


class Runs(InOrder):
    """Runs of n consecutive events within a window: an alert on each event of a run, by the earliest run that holds it."""

    opens = "at long, transaction_id string, merchant_id string, told boolean"
    n: int

    def alert(self, run: list[list]) -> tuple[str, str, float]:
        """The type, severity and score of a run."""
        raise NotImplementedError

    def step(self, held: list[list], e: dict) -> tuple[list[list], list[tuple]]:
        run = [*held, [e["ts_ms"], e["transaction_id"], e["merchant_id"], False]][-self.n :]
        if len(run) < self.n:
            return run, []
        kind, severity, score = self.alert(run)
        raised = [(o[1], o[0], kind, severity, score) for o in run if not o[3]]
        return [[*o[:3], True] for o in run], raised


class Micro(Runs):
    def __init__(self, config: Config):
        super().__init__(config)
        self.n = config.micro_count

    def window_ms(self) -> int:
        return self.config.micro_ms

    def alert(self, run: list[list]) -> tuple[str, str, float]:
        merchants = len({o[2] for o in run if o[2] is not None})
        severity = "CRITICAL" if self.n >= 10 or merchants >= 3 else "MEDIUM" if merchants <= 1 else "HIGH"
        return "MICRO_TRANSACTIONS", severity, min(0.98, 0.75 + self.n * 0.03)


class Velocity(Runs):
    def __init__(self, config: Config):
        super().__init__(config)
        self.n = config.velocity_count

    def window_ms(self) -> int:
        return self.config.velocity_ms

    def alert(self, run: list[list]) -> tuple[str, str, float]:
        severity = "CRITICAL" if self.n >= 5 or run[-1][0] - run[0][0] <= 1000 else "HIGH"
        return "VELOCITY_ATTACK", severity, min(0.95, 0.70 + self.n * 0.05)


def stateful_alerts(tx: DataFrame, kind: type[InOrder], config: Config) -> DataFrame:
    """Alerts of Takeover, Travel, Micro or Velocity over a stream of transactions. Needs the RocksDB state store."""
    from tidemark.functions.scalars import valid_coordinates
    from tidemark.operators.patterns import FINANCIAL

    # a stream's workers don't see files added to the context, so the processor travels with its module's code
    for module in (sys.modules[__name__], tidemark.config):
        cloudpickle.register_pickle_by_value(module)
    financial, amount = F.col("event_type").isin(*FINANCIAL), F.col("amount")
    rows = {
        Takeover: F.col("event_type").isin("LOGIN_FAILED", "LOGIN_SUCCESS", "TRANSFER"), Travel: financial & valid_coordinates(F.col("latitude"), F.col("longitude")),
        Micro: financial & (amount < config.micro_amount), Velocity: F.col("event_type").isin("TRANSFER", "PAYMENT") & amount.between(config.velocity_low, config.velocity_high),
    }
    relevant = F.when(F.col("event_ts") > F.lit("0001-01-01").cast("timestamp"), rows[kind])  # reads the watermark's column, so that all events advance it
    return with_watermark(tx).where(relevant).groupBy("account_id").transformWithStateInPandas(statefulProcessor=kind(config), outputStructType=_FOUND, outputMode="Append", timeMode="EventTime")


_RECENT = "ts_ms long, transaction_id string, revision int, alerts string, payload string"
_MERGED = "transaction_id string, account_id string, ts_ms long, cep_alerts array<struct<alert_type:string,severity:string,score:double>>, revision int, late_alert boolean, payload string"


class Merging(InOrder):
    """Transactions with the alerts that their account's events raise on them. An event is given out, with what is known, when the
    watermark has passed it; alerts that later events raise on it, as those that complete a run, give it out again under the
    next revision, marked late. A transaction waits for such alerts as long as the longest run lasts and is then forgotten, as
    is an alert whose transaction is."""

    opens = "pattern int, at long, a string"

    def __init__(self, config: Config):
        super().__init__(config)
        self.patterns = [Takeover(config), Travel(config), Micro(config), Velocity(config)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting, self.open, self.recent = handle.getListState("waiting", _EVENT + ", payload string"), handle.getListState("open", self.opens), handle.getListState("recent", _RECENT)

    def window_ms(self) -> int:
        return max(p.window_ms() for p in self.patterns)

    def _concerned(self, e: dict) -> list[bool]:
        c, financial, amount = self.config, e["event_type"] in _FINANCIAL, e["amount"]
        located = -90 <= e["latitude"] <= 90 and -180 <= e["longitude"] <= 180 and not (e["latitude"] == 0 and e["longitude"] == 0)
        return [e["event_type"] in ("LOGIN_FAILED", "LOGIN_SUCCESS", "TRANSFER"), financial and located, financial and amount < c.micro_amount,
                e["event_type"] in ("TRANSFER", "PAYMENT") and c.velocity_low <= amount <= c.velocity_high]

    def _match(self, e: dict, held: list[list[list]]) -> list[tuple]:
        """The (transaction_id, ts_ms, alert) that an event raises by any pattern; `held`, what is open by pattern, goes on."""
        out = []
        for k, (pattern, mine) in enumerate(zip(self.patterns, self._concerned(e))):
            if mine:
                held[k], raised = pattern.step([o for o in held[k] if e["ts_ms"] - o[0] < pattern.window_ms()], e)
                out += [(transaction, at, alert) for transaction, at, *alert in raised]
        return out

    def _opened(self, held: list[list[list]], now: int) -> list[tuple]:
        """Rows of what is still open."""
        return [(k, int(o[0]), json.dumps([x if isinstance(x, (str, bool, float)) or x is None else int(x) for x in o])) for k, p in enumerate(self.patterns) for o in held[k] if now - o[0] < p.window_ms()]

    def _advance(self, key, events: list[tuple], now: int) -> pd.DataFrame:
        names = [f.split()[0] for f in _EVENT.split(", ")]
        due, later = sorted((e for e in events if e[0] < now), key=lambda e: e[:2]), [e for e in events if e[0] >= now]
        held: list[list[list]] = [[] for _ in self.patterns]
        for pattern, _, rest in self.open.get() if self.open.exists() else ():
            held[pattern].append(json.loads(rest))
        recent = {(r[0], r[1]): [int(r[2]), json.loads(r[3]), r[4]] for r in (self.recent.get() if self.recent.exists() else ())}
        changed: dict[tuple, None] = {}
        for e in due:
            row = dict(zip(names, e))
            recent[e[0], e[1]] = [-1, [], e[-1]]
            changed[e[0], e[1]] = None
            for transaction, at, alert in self._match(row, held):
                if (at, transaction) in recent:
                    recent[at, transaction][1].append(alert)
                    changed[at, transaction] = None
        out = []
        for at, transaction in changed:
            kept = recent[at, transaction]
            kept[0] += 1
            out.append((transaction, key[0], at, [dict(zip(("alert_type", "severity", "score"), a)) for a in kept[1]], kept[0], kept[0] > 0, kept[2]))
        open_rows = self._opened(held, now)
        lasting = max(self.patterns[2].window_ms(), self.patterns[3].window_ms())
        recent_rows = [(at, i, r[0], json.dumps(r[1]), r[2]) for (at, i), r in recent.items() if now - at < lasting]
        for state, rows in ((self.waiting, later), (self.open, open_rows), (self.recent, recent_rows)):
            state.put(rows) if rows else state.clear()
        ends = [min(e[0] for e in later) + 1] if later else [max([at + self.window_ms() for _, at, _ in open_rows] + [r[0] + lasting for r in recent_rows])] if open_rows or recent_rows else []
        for end in ends:  # the next event to be taken, or when all that is kept has expired
            self.handle.registerTimer(int(end))
        return pd.DataFrame(out, columns=[f.split()[0] for f in _MERGED.replace("<struct<alert_type:string,severity:string,score:double>>", "").split(", ")])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[[*(f.split()[0] for f in _EVENT.split(", ")), "payload"]]
        new = [(int(e[0]), e[1], e[2], float(e[3]), e[4], float(e[5]), float(e[6]), e[7]) for e in new.itertuples(index=False)]
        old = [tuple(e) for e in self.waiting.get()] if self.waiting.exists() else []
        yield self._advance(key, old + new, timerValues.getCurrentWatermarkInMs())


def merged_alerts(tx: DataFrame, config: Config) -> DataFrame:
    """The stream tx with cep_alerts, revision and late_alert, without a scan of history: one stateful operator holds what an
    account's later events may concern. Readers keep the greatest revision of each transaction. Needs the RocksDB state store; columns of
    other types than parse_transactions() gives are not carried."""
    for module in (sys.modules[__name__], tidemark.config):
        cloudpickle.register_pickle_by_value(module)
    marked = with_watermark(tx.withColumn("payload", F.to_json(F.struct(*tx.columns))))
    passed = marked.where(F.col("event_ts") > F.lit("0001-01-01").cast("timestamp"))  # reads the watermark's column, so that all events advance it
    out = passed.groupBy("account_id").transformWithStateInPandas(statefulProcessor=Merging(config), outputStructType=_MERGED, outputMode="Append", timeMode="EventTime")
    return out.select(F.from_json("payload", tx.schema).alias("t"), "cep_alerts", "revision", "late_alert").select("t.*", "cep_alerts", "revision", "late_alert")


DECISION_DAYS, ALERT_DAYS = 90, 180  # that decisions and alerts are kept, from the newest on


def decisions_table(spark: SparkSession, out: str) -> VersionedTable:
    return VersionedTable(spark, f"{out}/decisions", "event_date", lambda df: storage.latest(df, "transaction_id", "decided_at"), DECISION_DAYS)


def alerts_table(spark: SparkSession, out: str) -> VersionedTable:
    return VersionedTable(spark, f"{out}/alerts", "event_date", lambda df: storage.latest(df, "alert_id", "alert_time"), ALERT_DAYS)


def summary_table(spark: SparkSession, out: str, summary: str) -> VersionedTable:
    return VersionedTable(spark, f"{out}/summaries/{summary}", "day", lambda df: storage.merge_partials(df, summary).withColumn("day", F.to_date(storage.SUMMARIES[summary][0][0])), DECISION_DAYS)


def _day(ms: int) -> date:
    return date(1970, 1, 1) + timedelta(days=ms // DAY)


def file_decisions(spark: SparkSession, out: str, new: DataFrame, gone: DataFrame, number: int) -> None:
    """Adds a batch's decisions, their alerts and messages, and the summaries that take in `new` and take out `gone`. Decisions are added last,
    so a batch whose decisions are there is done."""
    final, final_old = (D.final_alerts(x.drop("event_date")) for x in (new, gone))
    alerts_table(spark, out).append(storage.stored_alerts(final), number)
    D.alert_messages(final).write.mode("overwrite").text(f"{out}/messages/batch={number}")
    for summary in storage.SUMMARIES:
        rows = (final, final_old) if summary == "alerts_by_type" else (new, gone)
        summary_table(spark, out, summary).append(storage.revised(*rows, summary).withColumn("day", F.to_date(storage.SUMMARIES[summary][0][0])), number)
    decisions_table(spark, out).append(new, number)


def run_decisions(spark: SparkSession, raw: DataFrame, rules_path: str, out: str, checkpoint: str, config: Config, scorer: Scorer = no_model, trigger: dict | None = None) -> StreamingQuery:
    """Decide every transaction of the stream `raw` (column value) and write decisions, final alerts, summaries and rejected messages.

    Rules are read anew for each micro-batch, so an update holds from the next batch on; each transaction keeps the rule
    alerts of its own batch. A batch is judged together with the stored history of its accounts, so patterns and features
    reach back (history_ms). A transaction behind the watermark, the latest time of earlier batches less LATE, is marked `late` in
    the history: rules and patterns judge it, but it has no features and no score and is no history to the features of others. Stored transactions that its events turn out to concern, as those of a run that it completes,
    are written again with a new decided_at where their row changed; current_decisions() and current_alerts() read the
    latest versions, and summaries take the old versions out. All of these are tables of versions by day (VersionedTable): a batch
    reads the days it needs, days are merged as batches pile up and expire. Decisions are added last, so a batch whose decisions
    are there is done, and one tried again before replaces what it had written.
    """
    window, keep = longest_window(config), history_ms(config)
    filed = VersionedTable(spark, f"{out}/history", "event_date", lambda df: storage.latest(df, "transaction_id", "batch"), -(-2 * (window + keep) // DAY) + 1)
    decisions = decisions_table(spark, out)

    def judge(batch: DataFrame, number: int) -> None:
        if number <= decisions.last_batch():
            return
        batch = batch.persist()
        tx, rejected = parse_transactions(batch)
        now = F.lit(int(time.time() * 1000)).cast("long")
        rules = latest_rules(read_rule_log(spark, rules_path), "arrival").drop("arrival")
        ruled = apply_rules(tx, rules)
        mine = tx.select("account_id", "transaction_id", "ts_ms").persist()
        edge, newest = mine.agg(F.coalesce(F.min("ts_ms"), F.lit(0)), F.coalesce(F.max("ts_ms"), F.lit(0))).first()
        high = filed.note().get("high", 0)  # the latest event time of the batches before
        late = (F.col("ts_ms") > 0) & (F.col("ts_ms") < high - LATE_MS)
        filed.append(ruled.withColumns({"late": late, "event_date": F.to_date(from_millis(F.col("ts_ms"))), "batch": F.lit(number)}), number, {"high": max(high, newest)})
        since = mine.groupBy("account_id").agg((F.min("ts_ms") - window).alias("_since"))
        past = filed.read(first=_day(edge - window - keep)).where(F.col("ts_ms") >= edge - window - keep).drop("event_date", "batch")
        stored = past.join(since, "account_id").where(F.col("ts_ms") >= F.col("_since") - keep).withColumn("decided_ms", now)
        concerned = stored.where(F.col("ts_ms") >= F.col("_since")).select("transaction_id")
        stored = stored.drop("_since")
        made = storage.stored_decisions(resolve(attach(stored, detect(stored, config)), config, scorer).join(concerned, "transaction_id", "left_semi")).persist()
        own = mine.select("transaction_id").distinct()
        told = [c for c in made.columns if c != "decided_at"]
        before = decisions.read(first=_day(edge - window)) if decisions.last_batch() >= 0 else made.where("false")
        old = before.join(made.select("transaction_id"), "transaction_id", "left_semi").persist()
        known = old.select("transaction_id", F.struct(*told).alias("_told"), F.lit(True).alias("_known"))
        # a stored transaction that nothing was decided on is one of a batch whose decisions have expired: it is left as it is
        judged = made.withColumn("_now", F.struct(*told)).join(known, "transaction_id", "left").join(own.withColumn("_own", F.lit(True)), "transaction_id", "left")
        new = judged.where(F.col("_own") | (F.col("_known") & ~F.col("_now").eqNullSafe(F.col("_told")))).select(made.columns).persist()
        gone = old.join(new.select("transaction_id"), "transaction_id", "left_semi")
        rejected.write.mode("overwrite").text(f"{out}/rejected/batch={number}")
        file_decisions(spark, out, new, gone, number)
        for held in (mine, made, old, new, batch):
            held.unpersist()

    return raw.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


def current_decisions(spark: SparkSession, out: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The latest version of each decision that run_decisions() wrote, of the days from first to last; no other days are read."""
    return decisions_table(spark, out).read(first, last)


def current_alerts(spark: SparkSession, out: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The alerts of the latest decisions; those of earlier versions are left out."""
    now = current_decisions(spark, out, first, last).select("transaction_id", F.col("decided_at").alias("alert_time"))
    return alerts_table(spark, out).read(first, last).join(now, ["transaction_id", "alert_time"], "left_semi")


def current_summary(spark: SparkSession, out: str, summary: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """A summary of the latest decisions (of their alerts, for alerts_by_type), kept up to date by run_decisions()."""
    return storage.finished(summary_table(spark, out, summary).read(first, last), summary)


def running_throughput(tx: DataFrame) -> DataFrame:
    """Per minute counts and amounts of a stream, updated as rows arrive."""
    minute = F.window("event_ts", "1 minute")
    return with_watermark(tx).groupBy(minute.alias("w")).agg(F.count("*").alias("tx_count"), F.sum("amount").alias("total_amount"), F.sum("label").alias("label_count")).select(
        F.col("w.start").alias("window_start"), "tx_count", "total_amount", "label_count"
    )


def summarise_batch(decisions: DataFrame, alerts: DataFrame, number: int, path: str) -> None:
    """Partial rows of all summaries from a batch's decisions and alerts, filed under its number; a retry replaces them, and
    storage.finished() makes the summaries of all batches."""
    for summary in storage.SUMMARIES:
        part = storage.partials(alerts if summary == "alerts_by_type" else decisions, summary)
        part.write.mode("overwrite").parquet(f"{path}/{summary}/batch={number}")
