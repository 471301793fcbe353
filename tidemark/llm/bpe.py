"""Byte-level BPE over rank files: pieces of a pattern are merged through a queue of ranks, and ids are decoded again.

A piece's tokens are a linked list over its bytes. Each merge rank has a bucket of the places whose pair has that rank; a
bitmap of three levels says which buckets hold anything, so the lowest rank is three find-first-set steps away however
many ranks there are, and a piece of n bytes costs about n log n. A place whose pair has changed since it was queued is
skipped when it comes up. Pieces without white space may be as long as a text. Short pieces are merged many at a time: one queue holds
the places of all of them, and a rank that comes up is merged in every piece that it is the lowest of.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import arrow

CACHE_PIECES = 800_000  # distinct pieces that a worker keeps with their ids; then it starts anew
CACHE_CHARS = 32 << 20  # characters of those pieces
TOGETHER = 64  # bytes of the longest piece that is merged together with others
GROUP_CHARS = 8 << 20  # characters of texts that are encoded together
SEGMENT = 1 << 20  # characters that are cut into pieces at once
BITS = 64  # of a bitmap word


def default_ranks() -> bytes:
    """The public byte_bpe_50k rank file: a token in base64 and its rank on each line."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read()


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines()) if token}


class RankQueue:
    """Buckets by rank, and bits of three levels that tell the lowest rank whose bucket holds anything."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.levels: list[list[int]] = []  # from the bits of ranks up to one word
        size = ranks
        while size > 1 or not self.levels:
            size = -(-size // BITS)
            self.levels.append([0] * size)

    def __bool__(self) -> bool:
        return self.levels[-1][0] != 0

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, which something is about to be put into."""
        held = self.buckets.get(rank)
        if held is None:
            held = self.buckets[rank] = []
            at = rank
            for level in self.levels:
                word, bit = at >> 6, at & 63
                before = level[word]
                level[word] = before | 1 << bit
                if before:  # the levels above know this word
                    break
                at = word
        return held

    def lowest(self) -> int:
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = (rank << 6) + (word & -word).bit_length() - 1  # find first set
        return rank

    def take(self, rank: int) -> list:
        """The bucket of a rank, which is gone."""
        at = rank
        for level in self.levels:
            word = at >> 6
            level[word] &= ~(1 << (at & 63))
            if level[word]:
                break
            at = word
        return self.buckets.pop(rank)


class _Numbers(dict):
    """A number for each piece, in order of their coming."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class BytePairs:
    """Ids of texts by ranks and a pattern, and bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: token for token, i in ranks.items()}
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        splits = {(ranks[t[:k]] << 32) + ranks[t[k:]]: i for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.left_right = np.array(sorted(splits), np.int64)  # pairs of tokens that are a token together
        self.together = np.array([splits[k] for k in self.left_right.tolist()], np.int64)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.known, self.chars = _Numbers(), 0, 0
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of the lowest rank is merged, the leftmost of equal ones, until none has a rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, rank_of, queue = len(piece), self.ranks.get, self.queue
        ends = array("q", range(1, n + 1))  # of the token that begins at a place
        before = array("q", range(-1, n - 1))  # where the token before begins
        pair = array("q", [-1]) * n  # the rank of a token and the next together
        for i in range(n - 1):
            rank = rank_of(piece[i : i + 2], -1)
            if rank >= 0:
                pair[i] = rank
                heappush(queue.bucket(rank), i)
        while queue:
            rank = queue.lowest()
            places = queue.buckets[rank]
            i = heappop(places)
            if not places:
                queue.take(rank)
            if pair[i] != rank:  # queued before its pair changed
                continue
            j = ends[i]
            end = ends[i] = ends[j]
            pair[j] = pair[i] = -1
            if end < n:
                before[end] = i
                new = rank_of(piece[i : ends[end]], -1)
                if new >= 0:
                    pair[i] = new
                    heappush(queue.bucket(new), i)
            h = before[i]
            if h >= 0:
                new = pair[h] = rank_of(piece[h:end], -1)
                if new >= 0:
                    heappush(queue.bucket(new), h)
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return ids

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of tokens and those that follow them, -1 where they are none together."""
        key = (left << 32) + right
        at = np.minimum(np.searchsorted(self.left_right, key), len(self.left_right) - 1)
        return np.where(self.left_right[at] == key, self.together[at], -1) if len(self.left_right) else np.full(len(key), -1)

    def _push(self, rank: np.ndarray, place: np.ndarray) -> None:
        kept = rank >= 0
        rank, place = rank[kept], place[kept]
        if len(rank) > 1:
            order = np.argsort(rank, kind="stable")
            rank, place = rank[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else np.empty(0, np.int64)
        bucket, cuts = self.queue.bucket, [*first.tolist(), len(rank)]
        for r, a, b in zip(rank[first].tolist(), cuts, cuts[1:]):
            bucket(r).append(place[a:b])

    def merge_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many of each piece), each piece's as merge() gives them: of a rank that comes up, every piece that has it
        merges its leftmost pair; its others wait in the bucket, for a merge may make a pair of a lower rank."""
        if not pieces:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stop = np.cumsum(length)
        n, queue = int(stop[-1]), self.queue
        of = np.repeat(np.arange(len(pieces)), length)
        token = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ends, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        before[stop - length] = -1
        pair = np.append(self._ranks_of(token[:-1], token[1:]), -1)
        pair[stop - 1] = -1
        alive = np.ones(n, bool)
        self._push(pair, np.arange(n))
        while queue:
            rank = queue.lowest()
            parts = queue.take(rank)
            place = parts[0] if len(parts) == 1 else np.concatenate(parts)
            place = np.unique(place[pair[place] == rank])  # the others were queued before their pair changed
            own = of[place]
            more = np.concatenate(([False], own[1:] == own[:-1])) if len(own) else np.zeros(0, bool)
            if more.any():
                queue.bucket(rank).append(place[more])
                place, own = place[~more], own[~more]
            gone = ends[place]
            end = ends[gone]
            ends[place], token[place], alive[gone], pair[gone], pair[place] = end, rank, False, -1, -1
            inside = end < stop[own]
            left, right = place[inside], end[inside]
            before[right] = left
            pair[left] = made = self._ranks_of(token[left], token[right])
            right = place[before[place] >= 0]
            head = before[right]
            pair[head] = joined = self._ranks_of(token[head], token[right])
            self._push(np.concatenate((made, joined)), np.concatenate((left, head)))
        return token[alive], np.bincount(of[alive], minlength=len(pieces))

    def _learn(self) -> None:
        """Finds the ids of the pieces that have got a number since the last time."""
        pieces = [p.encode() for p in islice(self.numbers, self.known, None)]
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        short, long = np.flatnonzero((whole < 0) & (length <= TOGETHER)), np.flatnonzero((whole < 0) & (length > TOGETHER))
        flat, counts = self.merge_together([pieces[i] for i in short.tolist()])
        apart = [self.merge(pieces[i]) for i in long.tolist()]
        size = np.ones(len(pieces), np.int64)
        size[short], size[long] = counts, np.fromiter(map(len, apart), np.int64, len(apart))
        # whole pieces first, then those merged together, then the long ones
        new = np.concatenate((whole[whole >= 0], flat, np.fromiter((i for ids in apart for i in ids), np.int64)))
        order = np.concatenate((np.flatnonzero(whole >= 0), short, long))
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(max(len(self.ids), len(new)), np.int32)))
        self.ids[self.used : self.used + len(new)] = new
        begin = np.empty(len(pieces), np.int64)
        begin[order] = self.used + np.cumsum(size[order]) - size[order]
        self.begin, self.size = np.concatenate((self.begin, begin)), np.concatenate((self.size, size))
        self.used += len(new)
        self.known += len(pieces)
        self.chars += int(length.sum())

    def _segments(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text. The last piece but one of a segment ends where it would end in the whole text if characters
        follow it, so the next segment begins at the last two pieces."""
        begin = 0
        while True:
            size = SEGMENT
            while True:
                pieces = self.pattern.findall(text[begin : begin + size])
                last = begin + size >= len(text)
                held = len(pieces) if last else len(pieces) - 2
                if last or held > 0:
                    break
                size *= 2  # a piece longer than the segment
            yield pieces[:held]
            if last:
                return
            begin += sum(map(len, pieces[:held]))

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(all ids, how many of each text) of groups of texts, which come one after the other."""
        group, chars = [], 0
        for text in texts:
            if chars > GROUP_CHARS:
                yield self._encode(group)
                group, chars = [], 0
            group.append(text)
            chars += len(text or "")
        if group:
            yield self._encode(group)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self._forget()
        number, held, ends = self.numbers.__getitem__, [np.empty(0, np.int64)], []
        total = 0
        for text in texts:
            for pieces in self._segments(text) if text else ():
                held.append(np.array(list(map(number, pieces)), np.int64))
                total += len(pieces)
            ends.append(total)
        self._learn()
        which = np.concatenate(held)
        size = self.size[which]
        done = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.arange(done[-1]) + np.repeat(self.begin[which] - done[:-1], size)]
        return ids, np.diff(done[np.array([0, *ends])])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.tokens[i] for i in ids.tolist()])


_WORKER: dict[tuple[int, str], BytePairs] = {}


def _byte_pairs(file: bytes, pattern: str) -> BytePairs:
    """What this worker process keeps from task to task."""
    key = (hash(file), pattern)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = BytePairs(read_ranks(file), pattern)
    return _WORKER[key]


def encode_texts(docs: DataFrame, ranks: bytes | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) for every row of docs (doc_id, text), whatever its id: the ids of the whole text, each match of `pattern`
    encoded on its own by the rank file `ranks`. Special tokens have no meaning.

    A null or empty text has no ids; repeated rows stay; other columns are left out. The pattern must cover every character
    and look no further than one character ahead, as the public one does.
    """
    held, pattern = docs.sparkSession.sparkContext.broadcast(ranks or default_ranks()), pattern or default_pattern()  # under a MB

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _byte_pairs(held.value, pattern)
        for batch in batches:
            first = 0
            for ids, size in pairs.encode(batch.column(1).to_pylist()):
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(size)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], ["doc_id", "ids"])
                first += len(size)

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scan, "doc_id long, ids array<int>")


def _ids(lists: pa.ListArray) -> Iterator[np.ndarray]:
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    for a, b in zip(at[:-1], at[1:]):
        yield values[a:b]


def decode_ids(encoded: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), text as bytes: those of a text that was encoded are its UTF-8 bytes. An id that
    the rank file does not hold is an error; no ids are no bytes, and null ids neither."""
    held = encoded.sparkSession.sparkContext.broadcast(ranks or default_ranks())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _byte_pairs(held.value, "")
        for batch in batches:
            texts = pa.array([pairs.decode(ids) for ids in _ids(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return arrow(rows, scan, "doc_id long, text binary")


def bpe_digests(encoded: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows from encode_texts: digests of the ids as little-endian unsigned
    32-bit integers, and of the bytes that they decode to."""
    held = encoded.sparkSession.sparkContext.broadcast(ranks or default_ranks())
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _byte_pairs(held.value, "")
        for batch in batches:
            rows = [(len(ids), sha(ids.astype("<u4").tobytes()), sha(pairs.decode(ids))) for ids in _ids(batch.column(1))]
            n, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow(encoded.select("doc_id", "ids"), scan, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
