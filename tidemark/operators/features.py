"""Rolling features of an account before each transaction.

Accounts are cut into slices of time with a halo of a day. Windows are differences of prefix sums over a slice, so a row costs the same
however many rows its window holds, and a busy account spreads over many tasks. The last event and the last place may lie further back
than the halo: each slice tells its last ones, and a scan over slices carries them on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DAY, HOUR
from tidemark.functions.scalars import haversine_km, round_half_up
from tidemark.operators.slices import dealt, over_slices

FEATURES = ["tx_count_1h", "tx_count_24h", "avg_amount_24h", "amount_deviation", "time_since_last_ms", "distance_km"]
SLICE_HALOS = 2  # halos in a slice: a third of what tasks read are copies, and a month of one account is 15 slices
MADE = [("_n1", "long"), ("_n24", "long"), ("_sum", "double"), ("_sq", "double"), ("_last_ms", "long"), ("_last_lat", "double"), ("_last_lon", "double")]
_CARRY = ["_before_ms", "_before_lat", "_before_lon"]


class PrefixSums:
    """Sums of any range of values, exact but for their last rounding: values are split into two parts that add up as whole
    numbers. A range that holds a value that is not finite has no sum (NaN)."""

    def __init__(self, values: np.ndarray):
        finite = np.isfinite(values)
        held = np.where(finite, values, 0.0)
        bits = int(np.ceil(np.log2(len(held) + 1))) + 1
        top = int(np.frexp(np.abs(held).max(initial=0.0))[1]) + bits  # the sum of all is below 2 ** top
        self.units = [top - 62, top - 62 - 62 + bits]
        self.parts, rest = [], held
        for unit in self.units:
            whole = np.rint(np.ldexp(rest, -unit))
            rest = rest - np.ldexp(whole, unit)
            self.parts.append(np.concatenate(([0], np.cumsum(whole.astype(np.int64)))))
        self.odd = np.concatenate(([0], np.cumsum(~finite)))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Sums of values low .. high - 1."""
        total = sum(np.ldexp((p[high] - p[low]).astype(float), u) for p, u in zip(reversed(self.parts), reversed(self.units)))
        return np.where(self.odd[high] > self.odd[low], np.nan, total)


class _Slice:
    """Whole slices in order: which rows count, which have a place, where slices begin."""

    def __init__(self, table: pa.Table, number: np.ndarray):
        self.table = table.combine_chunks()
        self.own, self.at = self.get("own"), self.get("_ms")
        edge = np.flatnonzero(np.diff(number)) + 1
        self.begin = np.concatenate(([0], edge)).astype(np.int64)[: len(number)]
        self.end = np.concatenate((edge, [len(number)])).astype(np.int64)[: len(self.begin)]
        self.of = np.repeat(np.arange(len(self.begin)), self.end - self.begin)
        self.counted, self.placed = self.get("_counted"), self.get("_placed")

    def get(self, name: str) -> np.ndarray:  # no closure over self: a cycle would keep the table until the collector runs
        return self.table.column(name).to_numpy()

    def since(self, window_ms: int) -> np.ndarray:
        """For each row, the first of its slice that is window_ms before it or less."""
        past = self.at - self.at[self.begin][self.of]
        place = self.of * (int(past.max(initial=0)) + window_ms + 2) + past
        return np.searchsorted(place, place - window_ms, "left")

    def last(self, mark: np.ndarray) -> np.ndarray:
        """For each row and the end of all, the latest marked row before it, in whatever slice; -1 if there is none."""
        rows = np.where(mark, np.arange(len(mark)), -1)
        return np.concatenate(([-1], np.maximum.accumulate(rows))) if len(rows) else np.full(1, -1)


def _summaries(table: pa.Table, number: np.ndarray) -> pa.RecordBatch:
    """A row a slice: the time of its last own row that counts, and the last place."""
    s = _Slice(table, number)
    last, place = (s.last(mark & s.own)[s.end] for mark in (s.counted, s.placed))
    keep = lambda values, rows: pa.array(values[np.maximum(rows, 0)], mask=rows < s.begin)
    columns = [s.table.column(c).combine_chunks().take(pa.array(s.begin)) for c in ("_account", "slice")]
    return pa.RecordBatch.from_arrays([*columns, keep(s.at, last), keep(s.get("latitude"), place), keep(s.get("longitude"), place)], ["_account", "slice", *_CARRY])


def _windows(table: pa.Table, number: np.ndarray, keep_ms: int | None, names: list[str]) -> pa.RecordBatch:
    """Own rows with MADE."""
    s = _Slice(table, number)
    n, here = len(s.at), np.arange(len(s.at))
    amount = s.get("amount").astype(float)
    known = s.counted & ~np.asarray(s.table.column("amount").is_null())
    day, count = s.since(DAY), np.concatenate(([0], np.cumsum(known)))
    value = np.where(known, amount, 0.0)
    made = [count[here] - count[s.since(HOUR)], count[here] - count[day], PrefixSums(value).of(day, here), PrefixSums(value * value).of(day, here)]
    first = s.begin[s.of] if keep_ms is None else s.since(keep_ms)
    for mark, columns in ((s.counted, [("_ms", "_before_ms")]), (s.placed, [("latitude", "_before_lat"), ("longitude", "_before_lon")])):
        last = s.last(mark)[:n]
        inside = last >= first
        for column, before in columns:
            values, gone = s.get(column)[np.maximum(last, 0)], ~inside
            if keep_ms is None:
                carried = s.table.column(before).combine_chunks()
                values = np.where(inside, values, carried.fill_null(0).to_numpy(zero_copy_only=False))
                gone = gone & np.asarray(carried.is_null())
            made.append(pa.array(values, mask=gone))
    own = pa.array(s.own)
    out = [s.table.column(c).combine_chunks().filter(own) for c in names]
    out += [(m if isinstance(m, pa.Array) else pa.array(m)).filter(own) for m in made]
    return pa.RecordBatch.from_arrays(out, [*names, *(c for c, _ in MADE)])


def has_place() -> Column:
    return F.coalesce((F.col("latitude") != 0) & (F.col("longitude") != 0), F.lit(False))


def rolling_features(tx: DataFrame, masked: Column | None = None, now: Column | None = None, keep_ms: int | None = None) -> DataFrame:
    """tx with FEATURES, none of which counts the row itself. Rows without a time (0 or less) stand at `now`, in epoch
    milliseconds: the time of the query if not given.

    Windows are inclusive at exactly 1 h and 24 h, and rows of the same millisecond count where their transaction id is
    smaller. Rows for which `masked` holds get zeros and are no history to others. One unmasked row is one observation;
    sums are rounded to 6 decimals, so that the order of addition does not show; the deviation is 0 for fewer than two or equal amounts; distance is 0 unless both places have latitude and longitude.
    The last event and place are those of all time, or of the last keep_ms (a state that expires, 25 h say; a day or more).
    """
    counted = ~F.coalesce(masked, F.lit(False)) if masked is not None else F.lit(True)
    names = tx.columns
    tx = tx.withColumns({
        "_ms": F.when(F.col("ts_ms") > 0, F.col("ts_ms")).otherwise(F.unix_millis(F.current_timestamp()) if now is None else now).cast("long"),
        "_account": F.coalesce("account_id", F.lit("\0")),  # a key that is never null
        "_counted": counted,
    }).withColumn("_placed", F.col("_counted") & has_place())
    halo = max(DAY, keep_ms or 0) + 1
    cut = dealt(tx, "_ms", halo, SLICE_HALOS * halo, "_account")
    order = ["_account", "slice", "_ms", "transaction_id"]
    if keep_ms is None:
        carry = T.StructType([T.StructField("_account", T.StringType()), T.StructField("slice", T.LongType()), T.StructField("_before_ms", T.LongType()), T.StructField("_before_lat", T.DoubleType()), T.StructField("_before_lon", T.DoubleType())])
        told = over_slices(cut.sortWithinPartitions(*order), _summaries, carry, ("_account", "slice"))
        before = Window.partitionBy("_account").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row a slice
        carried = told.select("_account", "slice", *(F.last(c, ignorenulls=True).over(before).alias(c) for c in _CARRY))
        cut = cut.join(carried, ["_account", "slice"], "left")
    schema = T.StructType([*(tx.schema[c] for c in [*names, "_ms", "_counted"]), *(T.StructField(c, T.LongType() if k == "long" else T.DoubleType()) for c, k in MADE)])
    passed = [*names, "_ms", "_counted"]
    rows = over_slices(cut.sortWithinPartitions(*order), lambda table, number: _windows(table, number, keep_ms, passed), schema, ("_account", "slice"))
    return finished(rows, names)


def finished(rows: DataFrame, names: list[str]) -> DataFrame:
    """names and FEATURES of rows with MADE, the time they stand at (_ms) and whether they count (_counted); a batch's or a stream's."""
    placed = has_place()
    rows = rows.withColumns({c: F.round(c, 6) for c in ("_sum", "_sq")})
    mean = F.when(F.col("_n24") > 0, F.col("_sum") / F.col("_n24")).otherwise(0.0)
    rows = rows.withColumn("_mean", mean).withColumn("_std", F.when(F.col("_n24") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("_sq") / F.col("_n24") - F.col("_mean") * F.col("_mean")))).otherwise(0.0))
    far = F.col("_last_lat").isNotNull() & placed
    made = {
        "tx_count_1h": F.col("_n1").cast("long"), "tx_count_24h": F.col("_n24").cast("long"), "avg_amount_24h": round_half_up(F.col("_mean"), 2),
        "amount_deviation": F.when(F.col("_std") > 0, round_half_up((F.col("amount") - F.col("_mean")) / F.col("_std"), 4)).otherwise(0.0),
        "time_since_last_ms": F.coalesce(F.greatest(F.lit(0), F.col("_ms") - F.col("_last_ms")), F.lit(0)).cast("long"),
        "distance_km": F.when(far, round_half_up(haversine_km(F.col("_last_lat"), F.col("_last_lon"), F.col("latitude"), F.col("longitude")), 2)).otherwise(0.0),
    }
    zero = {n: F.when(F.col("_counted"), c).otherwise(F.lit(0)) for n, c in made.items()}
    return rows.select(*names, *(c.cast("long" if n.startswith(("tx_", "time_")) else "double").alias(n) for n, c in zero.items()))
