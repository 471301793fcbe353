"""Matches of the four patterns inside slices of accounts' events, on whole arrays.

Takeover and travel are chains: a match uses up all that is open. What is open after a match at event r are the events after r, so an
event e matches exactly if its latest possible start p(e), which depends on no match, comes after the last match. The events
with such a start are few, and the chain through a slice depends on the past only by its last match before the slice. A slice
therefore tells, as a step function, which match it ends with for each last match before it; alerts carry the range of last matches for
which they hold. A last match is named by `back`, its place counted from the end of its slice; NONE is none that matters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np

from tidemark.functions.scalars import EARTH_KM

NONE = (1 << 31) - 1
LAGS = 24  # earlier events that are tried one by one before cells are asked
FINER = 8  # cells of a level in one of the level before
LEVELS = 4
MOST_CELLS = 256  # of a slice; with more, one by one


@dataclass
class Events:
    """Relevant events of whole slices in order: which slice, whether its own, time."""

    slice: np.ndarray
    own: np.ndarray
    at: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.slice)
        edge = np.flatnonzero(self.slice[1:] != self.slice[:-1]) + 1 if n else np.empty(0, np.int64)
        self.begin = np.concatenate(([0], edge)).astype(np.int64) if n else np.empty(0, np.int64)  # of each slice with events
        self.end = np.concatenate((edge, [n])).astype(np.int64) if n else self.begin
        self.of = np.repeat(np.arange(len(self.begin)), self.end - self.begin)
        self.first_own = self.begin + np.add.reduceat((~self.own).astype(np.int64), self.begin) if n else self.begin

    def take(self, rows: np.ndarray) -> Events:
        return Events(self.slice[rows], self.own[rows], self.at[rows])

    def window_begin(self, window_ms: int) -> np.ndarray:
        """For each event, the first of its slice that is less than window_ms before it."""
        if not len(self.at):
            return np.empty(0, np.int64)
        since = self.at - self.at[self.begin][self.of]
        place = self.of * (int(since.max()) + window_ms + 2) + since
        return np.searchsorted(place, place - window_ms, "right")


class Places:
    """Questions about events far from an event, asked of cells first: two cells are wholly far, wholly near or neither, and
    only those are split into finer ones."""

    def __init__(self, events: Events, lat: np.ndarray, lon: np.ndarray, km: float):
        self.e, self.km = events, km
        self.lat, self.lon = np.radians(lat), np.radians(lon)
        self.cos = np.cos(self.lat)
        self.point = np.stack((self.cos * np.cos(self.lon), self.cos * np.sin(self.lon), np.sin(self.lat)), axis=1)
        self.chord = 2 * np.sin(min(km / (2 * EARTH_KM), np.pi / 2))

    def far(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        half_lat, half_lon = (self.lat[j] - self.lat[i]) / 2, (self.lon[j] - self.lon[i]) / 2
        a = np.sin(half_lat) ** 2 + self.cos[i] * self.cos[j] * np.sin(half_lon) ** 2
        return 2 * EARTH_KM * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(1 - a, 0))) >= self.km

    def nearest(self, asked: np.ndarray, low: np.ndarray, high: np.ndarray, latest: bool) -> np.ndarray:
        """For each event asked, the latest (or earliest) far one among low .. high - 1, -1 if there is none."""
        out = np.full(len(asked), -1, np.int64)
        live = np.flatnonzero(low < high)
        for lag in range(LAGS):
            j = high[live] - 1 - lag if latest else low[live] + lag
            inside = (j >= low[live]) & (j < high[live])
            live, j = live[inside], j[inside]
            hit = self.far(asked[live], j)
            out[live[hit]] = j[hit]
            live = live[~hit]
            if not len(live):
                return out
        for group in np.split(live, np.flatnonzero(np.diff(self.e.of[asked[live]])) + 1):
            a, b = int(low[group].min()), int(high[group].max())
            cells = self._cells(np.arange(a, b), self.chord / FINER)
            if len(np.unique(cells)) > MOST_CELLS:
                self._one_by_one(asked, low, high, latest, group, out)
            else:
                self._by_cells(asked, low, high, latest, group, np.arange(a, b), self.chord / FINER, 1, out)
        return out

    def _one_by_one(self, asked, low, high, latest, group, out, among=None) -> None:
        """As nearest, over the events `among` (all, if not given), and only better answers than those held."""
        live, lag = group, 0
        if among is not None:
            place = np.searchsorted(among, high[live]) - 1 if latest else np.searchsorted(among, low[live])
        while len(live):
            if among is None:
                j = high[live] - 1 - lag if latest else low[live] + lag
                inside = (j >= low[live]) & (j < high[live])
            else:
                at = place - lag if latest else place + lag
                inside = (at >= 0) & (at < len(among))
                j = among[np.where(inside, at, 0)]
                inside &= (j >= low[live]) & (j < high[live])
            held = out[live]
            inside &= (j > held) if latest else ((held < 0) | (j < held))
            live, j = live[inside], j[inside]
            if among is not None:
                place = place[inside]
            hit = self.far(asked[live], j)
            out[live[hit]] = j[hit]
            live = live[~hit]
            if among is not None:
                place = place[~hit]
            lag += 1

    def _cells(self, i: np.ndarray, side: float) -> np.ndarray:
        n = int(2 / side) + 2
        at = np.floor((self.point[i] + 1) / side).astype(np.int64)
        return (at[:, 0] * n + at[:, 1]) * n + at[:, 2]

    def _by_cells(self, asked, low, high, latest, group, among, side, level, out) -> None:
        n = int(2 / side) + 2
        split = lambda key: np.stack((key // (n * n), key // n % n, key % n), axis=1)
        held, of = np.unique(self._cells(among, side), return_inverse=True)
        asking, which = np.unique(self._cells(asked[group], side), return_inverse=True)
        members = np.split(among[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of))[:-1])
        for b, corner in enumerate(split(asking)):
            mine = group[which == b]
            apart = np.abs(split(held) - corner)
            least, most = side * np.sqrt((np.maximum(apart - 1, 0) ** 2).sum(axis=1)), side * np.sqrt(((apart + 1) ** 2).sum(axis=1))
            for a in np.flatnonzero(most >= self.chord * (1 - 1e-9)).tolist():
                own = members[a]
                if least[a] >= self.chord * (1 + 1e-9):  # all of it is far
                    at = np.searchsorted(own, high[mine]) - 1 if latest else np.searchsorted(own, low[mine])
                    inside = (at >= 0) & (at < len(own))
                    j = own[np.where(inside, at, 0)]
                    inside &= (j >= low[mine]) & (j < high[mine])
                    best = out[mine]
                    inside &= (j > best) if latest else ((best < 0) | (j < best))
                    out[mine[inside]] = j[inside]
                elif level < LEVELS and len(own) * len(mine) > 4096:
                    self._by_cells(asked, low, high, latest, mine, own, side / FINER, level + 1, out)
                else:
                    self._one_by_one(asked, low, high, latest, mine, out, own)


@dataclass
class Chain:
    """What slices tell of one chained pattern: steps (slice, bounds, outs) and matches (event, start, lo, hi): a match holds if
    lo < back <= hi for the last match before the slice."""

    steps: list[tuple[int, list[int], list[int]]]
    event: np.ndarray
    start: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def chain(e: Events, latest: np.ndarray, first: Callable[[np.ndarray, np.ndarray], np.ndarray], starts: Callable[[int, int, int], np.ndarray]) -> Chain:
    """The matches of a chained pattern. latest[i] is event i's latest possible start or -1; first(events, low) are the earliest
    possible starts from low on; starts(event, low, high) are all among low .. high - 1."""
    n = len(e.at)
    cand = np.flatnonzero((latest >= 0) & e.own)
    if not len(cand):
        none = np.empty(0, np.int64)
        return Chain([], none, none, none, none)
    # after a match at x comes the first event whose latest start is beyond x
    best = np.full(n + 1, n, np.int64)
    np.minimum.at(best, latest[cand], cand)
    after = np.minimum.accumulate(best[::-1])[::-1]
    of = e.of[cand]
    groups = np.split(cand, np.flatnonzero(np.diff(of)) + 1)
    steps, pairs, firsts = [], [], []
    for own in groups:
        g = int(e.of[own[0]])
        end, halo = int(e.end[g]), int(e.first_own[g])
        heads, bounds = [], []  # the first match for each range of last matches
        for c in own.tolist():
            back = max(halo - int(latest[c]), 0)
            if not bounds or back < bounds[-1]:
                heads.append(c)
                bounds.append(back)
            if back == 0:
                break
        through = {c: [(j, j)] for j, c in enumerate(heads)}  # of each match, the ranges of heads whose chains hold it
        queue, follows = list(heads), []
        while queue:  # matches in order, so all that lead to one are known; chains may interleave before they meet
            c = heappop(queue)
            follow, held = int(after[c + 1]), _joined(through.pop(c))
            follows.append((c, follow))
            if follow < end:
                if follow not in through:
                    heappush(queue, follow)
                through.setdefault(follow, []).extend(held)
                pairs += [(follow, c, bounds[b], bounds[a - 1] if a else NONE) for a, b in held]
        last: dict[int, int] = {}
        for c, follow in reversed(follows):
            last[c] = last[follow] if follow < end else c
        for j, c in enumerate(heads):
            firsts.append((c, bounds[j], bounds[j - 1] if j else NONE, halo))
        outs = [end - last[c] for c in heads]
        steps.append((g, bounds, outs))
    rows = []
    for c, lo, hi, halo in firsts:  # the earliest start after the last match, whichever that is
        above = hi
        halo_starts = starts(c, int(e.begin[e.of[c]]), min(halo, c))
        for s in halo_starts.tolist():
            back = halo - s
            if max(back, lo) < above:
                rows.append((c, s, max(back, lo), above))
                above = max(back, lo)
        if lo < above:
            rows.append((c, -1, lo, above))  # from the slice's own events
    event, start, lo, hi = (np.array(x, np.int64) for x in zip(*rows))
    own_start = np.flatnonzero(start < 0)
    start[own_start] = first(event[own_start], e.first_own[e.of[event[own_start]]])
    if pairs:
        match, before, low, high = (np.array(x, np.int64) for x in zip(*pairs))
        event, start = np.concatenate((event, match)), np.concatenate((start, first(match, before + 1)))
        lo, hi = np.concatenate((lo, low)), np.concatenate((hi, high))
    return Chain(steps, event, start, lo, hi)


def travel(e: Events, lat: np.ndarray, lon: np.ndarray, km: float, window_ms: int) -> Chain:
    """A place, then one `km` or more away within the window."""
    places = Places(e, lat, lon, km)
    begin = e.window_begin(window_ms)
    everyone = np.arange(len(e.at))
    latest = places.nearest(everyone, begin, everyone, latest=True)

    def starts(event: int, low: int, high: int) -> np.ndarray:
        among = np.arange(max(low, int(begin[event])), high)
        return among[places.far(np.full(len(among), event), among)]

    return chain(e, latest, lambda events, low: places.nearest(events, np.maximum(low, begin[events]), latest[events] + 1, latest=False), starts)


def takeover(e: Events, kind: np.ndarray, failures: int, most: int, window_ms: int) -> tuple[Chain, np.ndarray]:
    """Failed logins (kind 1), a login (2), a transfer (3); also the number of failures of each match. An attempt begins with
    each failed login, is complete with the first login after `failures` of them, and counts no more than `most`."""
    n = len(e.at)
    failed, passed = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
    done = np.full(len(failed), n, np.int64)  # where the attempt that each failed login begins is complete
    if failures <= most and len(failed) >= failures and len(passed):
        enough = failed[failures - 1 :]
        at = np.searchsorted(passed, enough)
        login = np.where(at < len(passed), passed[np.minimum(at, len(passed) - 1)], n)
        begun = failed[: len(enough)]
        same = (login < n) & (e.of[begun] == e.of[np.minimum(login, n - 1)])
        done[: len(enough)] = np.where(same, login, n)
    newest = np.full(n + 1, -1, np.int64)
    np.maximum.at(newest, done[done < n] + 1, failed[done < n])
    newest = np.maximum.accumulate(newest)[:n]  # the latest complete attempt before each event
    here = np.maximum(newest, 0)
    good = (kind == 3) & (newest >= 0) & (e.of[here] == e.of) & (e.at - e.at[here] < window_ms) if n else np.empty(0, bool)
    latest = np.where(good, newest, -1)
    count = np.concatenate(([0], np.cumsum(kind == 1)))

    begin = e.window_begin(window_ms)

    def starts(event: int, low: int, high: int) -> np.ndarray:
        a, b = np.searchsorted(failed, (max(low, int(begin[event])), min(high, int(latest[event]) + 1)))
        return failed[a:b]

    def first(events: np.ndarray, low: np.ndarray) -> np.ndarray:
        return failed[np.searchsorted(failed, np.maximum(low, begin[events]))]

    found = chain(e, latest, first, starts)
    begun = np.searchsorted(failed, found.start)
    return found, np.minimum(count[done[begun]] - count[found.start], most) if len(begun) else begun


@dataclass
class Runs:
    """Events in runs: each event, and of the earliest run that holds it the first event."""

    event: np.ndarray
    start: np.ndarray


def runs(e: Events, n: int, window_ms: int) -> Runs:
    """Runs of n consecutive events that end less than the window after they began. An event is told by the slice that its
    earliest run ends in, so the halo must cover two windows."""
    size = len(e.at)
    whole = np.zeros(size, bool)
    if size >= n:
        last = np.arange(n - 1, size)
        whole[: len(last)] = (e.of[last] == e.of[: len(last)]) & (e.at[last] - e.at[: len(last)] < window_ms)
    start = np.full(size, -1, np.int64)
    for back in range(min(n, size)):  # the earliest start is asked last and wins
        begins = whole[: size - back]
        start[back:] = np.where(begins, np.arange(size - back), start[back:])
    event = np.flatnonzero(start >= 0)
    event = event[e.own[start[event] + n - 1]]
    return Runs(event, start[event])
