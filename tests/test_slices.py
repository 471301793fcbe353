"""Patterns and features over accounts cut into slices, against loops over whole accounts."""

import gc
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.config import SPARSE, Config
from tidemark.operators import features as E
from tidemark.operators import matching as M
from tidemark.operators import patterns as P
from tidemark.operators.features import PrefixSums, rolling_features
from tidemark.operators.slices import whole_slices
from tidemark.sources.transactions import CITIES

TX = "transaction_id string, account_id string, ts_ms long, amount double, event_type string, latitude double, longitude double, merchant_id string"
CONFIG = Config(takeover_ms=40_000, micro_ms=9_000, micro_count=4, velocity_ms=7_000, travel_ms=30_000)
PLACES = [(10.8, 106.6), (21.0, 105.8), (10.9, 106.7), (11.9, 107.2), (12.12, 106.6), (-33.9, 151.2), (0.0, 0.0)]


def km(a, b):
    (la, lo), (lb, mo) = a, b
    x = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(math.radians(mo - lo) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


def accounts(n=60, events=260):
    """Accounts of different habits, some jumping without end, with ties in time and repeated rows, around time 0."""
    rng, rows = random.Random(11), []
    for a in range(n):
        at, habit = rng.randrange(-300_000, 0), a % 6
        for i in range(events):
            at += rng.choice([0, 100, 900, 2_000, 4_000, 4_000, 9_000, 50_000] if habit != 5 else [0, 1, 10])
            kind = rng.choice(["LOGIN_FAILED"] * 5 + ["LOGIN_SUCCESS"] * 2 + ["TRANSFER", "PAYMENT", "WITHDRAWAL", "OTHER"]) if habit < 4 else rng.choice(["TRANSFER", "PAYMENT"])
            place = PLACES[i % 2] if habit == 4 else rng.choice(PLACES[2:5] if habit in (1, 5) else PLACES)
            place = (place[0] + rng.random() / 50, place[1]) if place != (0.0, 0.0) else place
            rows.append((f"T{a:02d}-{rng.randrange(10_000):05d}", None if a == 7 else f"A{a:02d}", at, rng.choice([1.0, 9.99, 10.0, 100.0, 700.5, 2000.0, 2000.5]), kind, *place, rng.choice(["M", "N", "O", "", None])))
            if rng.random() < 0.02:
                rows.append(rows[-1])
    return rows


def loops(rows, c):
    """(pattern, account, time, id, what is told) of each alert."""
    by, out = {}, []
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for account, own in by.items():
        own.sort(key=lambda r: (r[2], r[0], r[3]))
        opens = []
        for r in own:
            opens = [o for o in opens if r[2] - o[0] < c.takeover_ms]
            if r[4] == "LOGIN_FAILED":
                opens = [[a, n + (not d and n < c.takeover_most), d] for a, n, d in opens] + [[r[2], 1, False]]
            elif r[4] == "LOGIN_SUCCESS":
                opens = [[a, n, d or n >= c.takeover_failures] for a, n, d in opens]
            elif r[4] == "TRANSFER" and any(o[2] for o in opens):
                out.append((P.TAKEOVER, account, r[2], r[0], next(o[1] for o in opens if o[2])))
                opens = []
        opens = []
        for r in own:
            if r[4] not in P.FINANCIAL or (r[5] == 0 and r[6] == 0):
                continue
            opens = [o for o in opens if r[2] - o[2] < c.travel_ms]
            far = [d for o in opens if (d := km(o[5:7], r[5:7])) >= c.travel_km]
            if far:
                out.append((P.TRAVEL, account, r[2], r[0], round(far[0], 3)))
            opens = [] if far else [*opens, r]
        for pattern, n, window, ok in (
            (P.MICRO, c.micro_count, c.micro_ms, lambda r: r[4] in P.FINANCIAL and r[3] < c.micro_amount),
            (P.VELOCITY, c.velocity_count, c.velocity_ms, lambda r: r[4] in ("TRANSFER", "PAYMENT") and c.velocity_low <= r[3] <= c.velocity_high),
        ):
            kept, told = [r for r in own if ok(r)], {}
            for k in range(len(kept) - n + 1):
                run = kept[k : k + n]
                if run[-1][2] - run[0][2] < window:
                    for i in range(k, k + n):
                        told.setdefault(i, (round(sum(r[3] for r in run), 6), run[-1][2] - run[0][2], len({r[7] for r in run} - {None})))
            out += [(pattern, account, kept[i][2], kept[i][0], *t) for i, t in told.items()]
    return out


def shown(found):
    out = []
    for r in found.collect():
        told = {P.TAKEOVER: lambda: (r.n,), P.TRAVEL: lambda: (round(km((r.lat1, r.lon1), (r.lat2, r.lon2)), 3),)}.get(r.pattern, lambda: (round(r.total, 6), r.span, r.merchants))()
        out.append((r.pattern, r.account_id, r.ts_ms, r.transaction_id, *told))
    return out


def counted(alerts):
    return sorted(map(repr, alerts))


def test_slices_equal_loops(spark):
    rows = accounts()
    want = loops(rows, CONFIG)
    assert {w[0] for w in want} == set(P.PATTERNS) and len(want) > 2000
    tx = spark.createDataFrame(rows, TX).repartition(7)
    assert counted(shown(P._matches(tx, CONFIG, P.PATTERNS))) == counted(want)
    for kind in P.PATTERNS:  # other halos, so other slices
        assert counted(shown(P._matches(tx, CONFIG, (kind,)))) == counted(w for w in want if w[0] == kind)


@pytest.mark.parametrize("cells", [3, 256])
def test_far_events_by_cells(monkeypatch, cells):
    """Places near the limit, found through cells of several levels and one by one."""
    monkeypatch.setattr(M, "LAGS", 1)
    monkeypatch.setattr(M, "MOST_CELLS", cells)
    rng = np.random.default_rng(3)
    n = 500
    slices = np.sort(rng.integers(0, 3, n))
    at = np.sort(rng.integers(0, 4000, n))
    events = M.Events(slices, np.ones(n, bool), np.concatenate([np.sort(at[slices == s]) for s in range(3)]))
    lat = np.where(rng.random(n) < 0.5, 10.0, 11.3489) + rng.normal(0, 1e-4, n)
    lon = np.where(slices == 1, rng.uniform(-180, 180, n), 106.0 + rng.normal(0, 1e-4, n))
    places, begin, every = M.Places(events, lat, lon, 150.0), events.window_begin(900), np.arange(n)
    far = lambda i, j: km((lat[i], lon[i]), (lat[j], lon[j])) >= 150.0
    latest, earliest = places.nearest(every, begin, every, True), places.nearest(every, begin, every, False)
    for i in range(n):
        own = [j for j in range(i) if slices[j] == slices[i] and events.at[i] - events.at[j] < 900 and far(i, j)]
        assert (earliest[i], latest[i]) == ((own[0], own[-1]) if own else (-1, -1))


def test_whole_slices_over_batches():
    rng = random.Random(4)
    keys = sorted((rng.choice(["a", "b", None]) or "", rng.randrange(5)) for _ in range(200))
    table = pa.table({"account_id": [k[0] or None for k in keys], "slice": [k[1] for k in keys], "x": list(range(200))})
    for size in (1, 3, 50, 1000):
        got, seen = [], []
        for part, number in whole_slices(iter(table.to_batches(max_chunksize=size)), (0, 1)):
            got += part.column("x").to_pylist()
            held = list(zip(part.column("account_id").to_pylist(), part.column("slice").to_pylist()))
            assert [held[i] == held[i - 1] for i in range(1, len(held))] == [number[i] == number[i - 1] for i in range(1, len(held))]
            seen += sorted(set(held), key=str)
        assert got == list(range(200)) and len(seen) == len(set(seen))


def test_one_account_of_a_million_events(spark):
    """No gap longer than a second, at home but for a trip every hour and an attack a day: slices spread the account, and what an
    event costs does not grow with what is open."""
    n = 1_000_000
    i = F.col("id")
    away, attack = i % 3600 == 3599, i % 86_400
    kind = F.when(attack < 4, "LOGIN_FAILED").when(attack == 4, "LOGIN_SUCCESS").when(attack == 5, "TRANSFER").otherwise("PAYMENT")
    noise = lambda k: (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1000)) - 500) / 20_000.0
    tx = spark.range(0, n, 1, 8).select(
        F.format_string("T%07d", i).alias("transaction_id"), F.lit("A").alias("account_id"), (i * 1000).alias("ts_ms"), F.lit(50.0).alias("amount"), kind.alias("event_type"),
        (F.when(away, 21.0).otherwise(10.8) + noise(1)).alias("latitude"), (106.0 + noise(2)).alias("longitude"), F.lit("M").alias("merchant_id"),
    )
    found = {(r.alert_type, r.transaction_id) for r in P.detect(tx, Config()).collect()}
    assert {t for kind, t in found if kind == P.TAKEOVER} == {f"T{k * 86_400 + 5:07d}" for k in range(n // 86_400 + 1)}
    # a trip is far from home, and so is what follows it; the first match uses the trip up
    assert {t for kind, t in found if kind == P.TRAVEL} == {f"T{k * 3600 + 3599:07d}" for k in range(n // 3600)}
    assert not [t for kind, t in found if kind in (P.MICRO, P.VELOCITY)]


def test_detect_reads_events_once(spark, tmp_path):
    """One scan and one exchange of accounts for all four patterns; the steps of slices come from the same exchange."""
    spark.createDataFrame(accounts(12), TX).write.parquet(f"{tmp_path}/tx")
    found = P.detect(spark.read.parquet(f"{tmp_path}/tx"), CONFIG)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert plan.count("ReusedExchange") == 1 and plan.count("REPARTITION_BY_COL") == 2 + 1  # events, their reuse, and a row a slice


HOUR = 3_600_000


def days(n=40, events=150):
    """Accounts over weeks, with ties in time, rows without a time, unknown amounts, repeated rows and long gaps."""
    rng, rows = random.Random(5), []
    for a in range(n):
        at = 1_700_000_000_000 + rng.randrange(HOUR * 100)
        for _ in range(events):
            at += rng.choice([0, 0, 1, 5000, HOUR, HOUR, 24 * HOUR, 5 * HOUR, HOUR // 7, 200 * HOUR if a % 3 == 0 else 0])
            place = rng.choice([(10.0, 106.0), (21.0, 105.0), (0.0, 5.0), (0.0, 0.0), (-33.0, 151.0)])
            rows.append((f"T{a:02d}-{rng.randrange(10_000):05d}", None if a == 3 else f"A{a}", rng.choice([at] * 30 + [0, -5]), rng.choice([None, 0.1, 0.2, 10.0, 1e9, 123.456, 5.0]), "TRANSFER", *place, rng.choice("MMMMC")))
    return rows + rows[::97]


def brute_features(rows, now, keep=None):
    """(id, features) of each row by the definition; the row C is masked."""
    by, out = {}, []
    for r in rows:
        by.setdefault(r[1], []).append((r[2] if r[2] > 0 else now, *r))
    for own in by.values():
        own.sort(key=lambda r: (r[0], r[1]))
        for i, r in enumerate(own):
            if r[8] == "C":
                out.append((r[1], 0, 0, 0.0, 0, None))
                continue
            seen = [x for x in own[:i] if x[8] != "C"]
            day = [x[4] for x in seen if x[4] is not None and r[0] - x[0] <= 24 * HOUR]
            kept = [x for x in seen if keep is None or r[0] - x[0] <= keep]
            places = [x for x in kept if x[6] != 0 and x[7] != 0]
            far = km(places[-1][6:8], r[6:8]) if places and r[6] != 0 and r[7] != 0 else 0.0
            mean = round(math.fsum(day), 6) / len(day) if day else 0.0
            out.append((r[1], sum(r[0] - x[0] <= HOUR for x in seen if x[4] is not None), len(day), math.floor(mean * 100 + 0.5) / 100, r[0] - kept[-1][0] if kept else 0, round(far, 1)))
    return out


@pytest.mark.parametrize("keep", [None, 25 * HOUR, 24 * HOUR])
def test_features_equal_the_definition(spark, keep):
    rows, now = days(), 1_700_000_000_000 + 300 * HOUR
    tx = spark.createDataFrame(rows, TX).repartition(5)
    got = rolling_features(tx, F.col("merchant_id") == "C", F.lit(now), keep).collect()
    masked = lambda r: r.merchant_id == "C"
    shown = [(r.transaction_id, r.tx_count_1h, r.tx_count_24h, r.avg_amount_24h, r.time_since_last_ms, None if masked(r) else round(r.distance_km, 1)) for r in got]
    # equal times and ids come in any order: their sums are told apart below
    assert counted(shown) == counted(brute_features(rows, now, keep))


def test_prefix_sums_are_exact():
    rng = np.random.default_rng(1)
    for values in (rng.normal(0, 1e3, 5000), 10.0 ** rng.integers(-8, 9, 5000) * rng.random(5000), np.full(3, 0.1), np.zeros(4), np.empty(0), np.array([1e300, 1.0, -1e300])):
        low = rng.integers(0, len(values) + 1, 300)
        high = np.minimum(low + rng.integers(0, 200, 300), len(values))
        got, want = PrefixSums(values).of(low, high), [math.fsum(values[a:b]) for a, b in zip(low, high)]
        scale = np.abs(values).max(initial=0.0)
        assert np.allclose(got, want, rtol=1e-15, atol=scale * 1e-25)
    odd = PrefixSums(np.array([1.0, np.inf, 2.0, np.nan, 4.0])).of(np.array([0, 1, 2, 4]), np.array([1, 2, 4, 5]))
    assert odd[0] == 1.0 and np.isnan(odd[1:3]).all() and odd[3] == 4.0


def test_a_third_of_the_rows_in_one_account(spark):
    """An event a second, 86,400 in a day's window; its slices spread over tasks."""
    n = 600_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    i = F.col("id")
    hot = spark.range(0, n, 1, 8).select(F.format_string("T%07d", i).alias("transaction_id"), F.lit("A").alias("account_id"), (1_700_000_000_000 + i * 1000).alias("ts_ms"), (i % 7).cast("double").alias("amount"), F.lit(10.0).alias("latitude"), F.lit(106.0).alias("longitude"))
    others = spark.range(0, 2 * n, 1, 8).select(F.format_string("U%07d", i).alias("transaction_id"), F.format_string("B%d", i % 9999).alias("account_id"), (1_700_000_000_000 + i * 500).alias("ts_ms"), F.lit(1.0).alias("amount"), F.lit(10.0).alias("latitude"), F.lit(106.0).alias("longitude"))
    made = rolling_features(hot.unionByName(others))
    made = made.withColumn("task", F.spark_partition_id()).where("account_id = 'A'").cache()
    before = F.substring("transaction_id", 2, 7).cast("long")
    wrong = made.where((F.col("tx_count_1h") != F.least(before, F.lit(3600))) | (F.col("tx_count_24h") != F.least(before, F.lit(86_400))) | (F.col("time_since_last_ms") != F.when(before > 0, 1000).otherwise(0)))
    assert wrong.count() == 0 and made.count() == n
    assert made.select("task").distinct().count() > 2
    mean = sum((600_000 - 1 - k) % 7 for k in range(1, 86_401)) / 86_400
    assert made.where("transaction_id = 'T0599999'").first().avg_amount_24h == math.floor(mean * 100 + 0.5) / 100
    made.unpersist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def alone(kind, c, seed):
    """For one slice with a halo, for each last match before it: (what the slice says and its last match, what a walk says)."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(8, 40))
    at, halo = np.sort(rng.integers(0, 100_000, n)), int(rng.integers(1, n // 2))
    events = M.Events(np.zeros(n, np.int64), np.arange(n) >= halo, at)
    if kind == P.TAKEOVER:
        kinds = rng.choice([1, 1, 2, 3], n)
        found, counts = M.takeover(events, kinds, c.takeover_failures, c.takeover_most, c.takeover_ms)
    else:
        spot = rng.integers(0, len(PLACES) - 1, n)
        lat, lon = (np.array([PLACES[p][k] for p in spot]) for k in (0, 1))
        found = M.travel(events, lat, lon, c.travel_km, c.travel_ms)
        counts = found.start

    def walk(x):
        """Matches of own events, if the last one before them is event x."""
        opens, out = [], []
        for i in range(x + 1, n):
            if kind == P.TAKEOVER:
                opens = [o for o in opens if at[i] - o[0] < c.takeover_ms]
                if kinds[i] == 1:
                    opens = [[a, m + (not d and m < c.takeover_most), d] for a, m, d in opens] + [[at[i], 1, False]]
                elif kinds[i] == 2:
                    opens = [[a, m, d or m >= c.takeover_failures] for a, m, d in opens]
                hit = [o[1] for o in opens if o[2]] if kinds[i] == 3 else []
            else:
                opens = [o for o in opens if at[i] - at[o] < c.travel_ms]
                hit = [o for o in opens if km(PLACES[spot[o]], PLACES[spot[i]]) >= c.travel_km]
                opens = opens if hit and i >= halo else [*opens, i]
            if hit and i >= halo:
                out.append((i, hit[0]))
                opens = []
        return out

    for back in range(1, halo + 1):
        inside = (found.lo < back) & (back <= found.hi)
        told = sorted(zip(found.event[inside].tolist(), counts[inside].tolist()))
        last = next((o for _, bounds, outs in found.steps for b, o in zip(bounds, outs) if b < back), None)
        want = walk(halo - back)
        yield (told, last), (want, n - want[-1][0] if want else None)


def test_takeover_chains_that_interleave():
    """Chains of two last matches may share a match that a chain between them passes by; no alert is told twice. Before its slice nothing
    matches but the last match: the walk begins there."""
    c = Config(takeover_failures=1, takeover_ms=60_000)
    for seed in range(400):
        for told, want in alone(P.TAKEOVER, c, seed):
            assert told == want


def test_travel_chains_that_interleave(spark):
    """Journeys of one account around the edge of a slice, where the first match of the slice and the third share the next."""
    for seed in range(100):
        for told, want in alone(P.TRAVEL, Config(travel_ms=30_000), seed):
            assert told == want
    journey = [(69613781, 4), (114982586, 2), (119125772, 1), (154696606, 0), (180865580, 3), (181302560, 1), (194165794, 5), (278234283, 0), (321327473, 2), (432986809, 1), (452587204, 2), (560890734, 1)]
    rows = [(f"T{i:02d}", "A", 1_704_000_000_000 + ms, 50.0, "PAYMENT", *CITIES[city][1:], "M") for i, (ms, city) in enumerate(journey)]
    want = [w for w in loops(rows, SPARSE) if w[0] == P.TRAVEL]
    assert counted(shown(P._matches(spark.createDataFrame(rows, TX), SPARSE, (P.TRAVEL,)))) == counted(want)


def sorted_slices(**columns):
    n = 300
    table = {"slice": [i // 50 for i in range(n)], "own": [i % 50 > 9 for i in range(n)], "transaction_id": [f"T{i:03d}" for i in range(n)], "amount": [5.0] * n, "latitude": [10.8 + i % 2 * 30 for i in range(n)], "longitude": [106.6] * n}
    return pa.table(table | {k: v if isinstance(v, list) else [v] * n for k, v in columns.items()}), np.arange(n) // 50


def left_over(kind, work):
    """How many objects of a kind are left when work is done, before the collector of cycles runs."""
    gc.collect()
    gc.disable()
    try:
        work()
        return sum(type(o) is kind for o in gc.get_objects())
    finally:
        gc.enable()


def test_features_leave_no_table_behind():
    """A batch is freed when its rows are told, so a task's memory does not grow with its batches."""
    table, number = sorted_slices(_account="A", _ms=[i * 1000 for i in range(300)], _counted=True, _placed=True)
    assert left_over(E._Slice, lambda: E._summaries(table, number)) == 0
    assert left_over(E._Slice, lambda: E._windows(table, number, 90_000_000, ["transaction_id"])) == 0


def test_patterns_leave_no_table_behind():
    kinds = [("PAYMENT", "LOGIN_FAILED", "LOGIN_SUCCESS")[i % 3] for i in range(300)]
    table, number = sorted_slices(account_id="A", ts_ms=[i * 1000 for i in range(300)], login=[3 - i % 3 for i in range(300)], located=[k == "PAYMENT" for k in kinds], micro=[k == "PAYMENT" for k in kinds], fast=False, merchant_id="M")
    assert left_over(P._Slices, lambda: P._Slices(table, number, Config()).table_of(P.PATTERNS)) == 0
    assert left_over(P._Slices, lambda: P._Slices(table, number, Config()).steps_of(P.PATTERNS)) == 0


def most_held(work, table, key, batches):
    """The most bytes of Arrow beyond those at the start, while a task works on so many batches and no collector of cycles runs."""
    gc.collect()
    gc.disable()
    try:
        places = tuple(table.column_names.index(k) for k in key)
        read = (table.take(pa.array(range(table.num_rows))).combine_chunks().to_batches()[0] for _ in range(batches))
        floor, most = pa.total_allocated_bytes(), 0
        for part, number in whole_slices(read, places):
            work(part, number)
            most = max(most, pa.total_allocated_bytes() - floor)
        return most
    finally:
        gc.enable()


def test_task_memory_does_not_grow_with_batches():
    """What a task holds at a time is no more for 80 batches than for 10, but for half at most, in the features and the patterns."""
    at, kinds = [i * 1000 for i in range(300)], [i % 3 == 0 for i in range(300)]
    features, _ = sorted_slices(_account="A", _ms=at, _counted=True, _placed=True)
    patterns, _ = sorted_slices(account_id="A", ts_ms=at, login=[3 - i % 3 for i in range(300)], located=kinds, micro=kinds, fast=False, merchant_id="M")
    for table, key, works in (
        (features, ("_account", "slice"), (E._summaries, lambda t, n: E._windows(t, n, 90_000_000, ["transaction_id"]))),
        (patterns, ("account_id", "slice"), (lambda t, n: P._Slices(t, n, Config()).table_of(P.PATTERNS), lambda t, n: P._Slices(t, n, Config()).steps_of(P.PATTERNS))),
    ):
        for work in works:
            most_held(work, table, key, 2)
            assert most_held(work, table, key, 80) < 1.5 * most_held(work, table, key, 10)
