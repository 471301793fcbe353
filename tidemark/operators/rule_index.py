"""Many rules at once: an index by field and operator, so that a transaction costs what it matches and the logarithm of the rules.

Texts that EQUALS and IN name are looked up, thresholds of GREATER_THAN and LESS_THAN lie sorted, NOT_IN rules match but for those that list
the value, and hours are bits. The index is broadcast within a bound on its rules' bytes; beyond it, rules are dealt into several indexes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import local_hour
from tidemark.shipping import ship

INDEX_BYTES = 16 << 20  # of the rules' texts behind one index
NEAR = 1e-6  # amounts this close are equal
ALL_DAY = (1 << 24) - 1
SCORES = {"CRITICAL": 0.8}  # fixed values, as the words of details
OTHER_SCORE = 0.6
VIOLATIONS = pa.list_(pa.struct([("rule_id", pa.string()), ("rule_name", pa.string()), ("severity", pa.string()), ("score", pa.float64()), ("details", pa.string())]))


def hours_of(start: int | None, end: int | None) -> int:
    """The hours from start to before end, over midnight if end is smaller, as bits; all without either."""
    if start is None and end is None:
        return ALL_DAY
    start, end = start or 0, 24 if end is None else end
    return sum(1 << h for h in range(24) if (start <= h < end if start <= end else h >= start or h < end))


class _Field:
    """The rules of one field: arrays of rule numbers beside sorted thresholds or by value."""

    def __init__(self, rules: list[tuple[int, dict, tuple]], amount: bool):
        self.amount = amount
        above, below, equal, absent = [], [], [], []
        for number, rule, (value, text, items, numbers) in rules:
            kind = rule["operator"]
            if kind == "GREATER_THAN":
                above.append((value, number))
            elif kind == "LESS_THAN":
                below.append((value, number))
            elif kind in ("EQUALS", "IN"):
                equal += [(x, number) for x in ([value] if kind == "EQUALS" else numbers)] if amount else [(x, number) for x in ([text] if kind == "EQUALS" else items)]
            elif kind == "NOT_IN":
                absent.append((number, numbers if amount else items))
        pairs = lambda held: tuple(np.array(x, t) for x, t in zip(zip(*sorted(held)) if held else ((), ()), (float, np.int64)))
        self.above, self.below = pairs(above), pairs(below)
        self.equal, self.listed = self._lookup(equal), self._lookup([(x, number) for number, values in absent for x in values])
        self.absent = np.array([number for number, _ in absent], np.int64)

    def _lookup(self, held: list[tuple]):
        if self.amount:
            held = sorted(held)
            return np.array([x for x, _ in held], float), np.array([n for _, n in held], np.int64)
        by: dict[str, list[int]] = {}
        for x, number in held:
            by.setdefault(x, []).append(number)
        return {x: np.unique(numbers) for x, numbers in by.items()}

    def _named(self, lookup, text: str, number: float) -> np.ndarray:
        if not self.amount:
            return lookup.get(text, _NONE)
        values, rules = lookup
        low, high = np.searchsorted(values, (number - 2 * NEAR, number + 2 * NEAR))
        return np.unique(rules[low:high][np.abs(values[low:high] - number) < NEAR])

    def matches(self, text: str, number: float | None) -> list[np.ndarray]:
        """Rules that a value matches, its hour aside; number is None where the text is none."""
        out = []
        if number is not None:  # a threshold compares as Spark does: NaN is the greatest
            values, rules = self.above
            out.append(rules[: np.searchsorted(values, number, "left")])
            values, rules = self.below
            out.append(rules[np.searchsorted(values, number, "right") :])
        out.append(self._named(self.equal, text, number))
        if len(self.absent):
            out.append(np.setdiff1d(self.absent, self._named(self.listed, text, number), assume_unique=True))
        return out


_NONE = np.empty(0, np.int64)


class RuleIndex:
    """Rules (dicts) with their parsed thresholds, in order of their id; with `since` and `until` they hold for that time only."""

    def __init__(self, rules: list[dict], fields: tuple[str, ...], parse):
        self.rules = sorted(rules, key=lambda r: (r["rule_id"], r.get("since") or 0))
        self.since = [r.get("since") for r in self.rules]
        self.until = [r.get("until") for r in self.rules]
        self.hours = np.array([hours_of(r["start_hour"], r["end_hour"]) for r in self.rules], np.int64)
        self.heads = [f"Rule {r['rule_id']}: " + " ".join("null" if r[k] is None else r[k] for k in ("field", "operator", "threshold")) + " (actual: " for r in self.rules]
        self.fields = {}
        for k, field in enumerate(fields):
            own = [(n, r, parse(r["threshold"])) for n, r in enumerate(self.rules) if r["field"] == field]
            if own:
                self.fields[k] = _Field(own, field == "amount")

    def holds(self, n: int, at: int | None) -> bool:
        """Whether rule n is in force at a time; without a time only rules that always are."""
        if self.since[n] is None:
            return True
        return at is not None and self.since[n] <= at and (self.until[n] is None or at < self.until[n])

    def violations(self, texts: list[str | None], numbers: list[float | None], hour: int | None, at: int | None) -> list[dict]:
        """The violations of a transaction by rule id: its fields as texts and numbers, its hour if it has a time, its arrival."""
        found = []
        for k, field in self.fields.items():
            if texts[k] is not None:
                found += [(n, k) for part in field.matches(texts[k], numbers[k]) for n in part.tolist()]
        bit = ALL_DAY if hour is None else 1 << hour
        out = []
        for n, k in sorted(found):
            rule = self.rules[n]
            if (hour is None or self.hours[n] & bit) and self.holds(n, at):
                out.append({"rule_id": rule["rule_id"], "rule_name": rule["rule_name"], "severity": rule["severity"], "score": SCORES.get(rule["severity"], OTHER_SCORE), "details": f"{self.heads[n]}{texts[k]})"})
        return out


def indexed_violations(tx: DataFrame, rules: DataFrame, fields: tuple[str, ...], parse, alerts_type: str, at: str | None = None) -> DataFrame:
    """tx with `rule_alerts` of active rules, in force at the column `at` where rules have `since` and `until`. The rules' bytes are counted; those over INDEX_BYTES go to further indexes, one pass of
    transactions each, whose alerts are put together by rule id."""
    ship(tx.sparkSession)
    active = rules.where(F.coalesce("active", F.lit(True)))
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in ("rule_id", "rule_name", "field", "operator", "threshold")), F.lit(64))
    total = active.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    parts = max(1, -(-total // INDEX_BYTES))
    out = tx.withColumn("rule_alerts", F.array().cast(alerts_type))
    for k in range(parts):
        held = [r.asDict() for r in active.where(F.pmod(F.xxhash64("rule_id"), F.lit(parts)) == k).collect()]  # about INDEX_BYTES
        index = tx.sparkSession.sparkContext.broadcast(RuleIndex(held, fields, parse))
        out = _marked(out, index, fields, F.lit(None) if at is None else F.col(at))
    return out if parts == 1 else out.withColumn("rule_alerts", F.array_sort("rule_alerts"))


def _marked(tx: DataFrame, index, fields: tuple[str, ...], at: Column) -> DataFrame:
    n, names = len(fields), tx.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[-2 * n - 2 :]]
            found = [known.violations(row[:n], row[n : 2 * n], *row[-2:]) for row in zip(*columns)]
            before = batch.column(names.index("rule_alerts")).to_pylist()
            made = pa.array([a + b for a, b in zip(before, found)], VIOLATIONS)
            yield pa.RecordBatch.from_arrays([made if c == "rule_alerts" else batch.column(i) for i, c in enumerate(names)], names)

    texts = [F.col(f).cast("string").alias(f"_t{k}") for k, f in enumerate(fields)]
    numbers = [(F.col(f) if f == "amount" else F.col(f).try_cast("double")).alias(f"_n{k}") for k, f in enumerate(fields)]
    hour = F.when(F.col("ts_ms") > 0, local_hour(F.col("ts_ms"))).alias("_hour")
    return tx.select("*", *texts, *numbers, hour, at.cast("long").alias("_at")).mapInArrow(scan, tx.schema)
