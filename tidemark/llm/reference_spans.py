"""Removal of the spans that a reference of its own holds: suffix automata of its shards are built by Spark tasks and broadcast, and
documents stream past them once, without a shuffle.

The matching statistics of a chunk's documents are taken in lanes, pieces of a document that overlap by a window, which all move
through the automaton together, one word a step.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import substrings
from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, table
from tidemark.shipping import ship

SHARD_BYTES = 1 << 20  # text of a shard, whose automaton takes some 4 bytes for each of it
MOST_SHARDS = 8  # that every document is held against; a larger reference is routed
PIECE_WORDS = 5_000  # longer reference texts are cut, with overlaps
LANE = 64  # windows of a lane

_PIECES = "shard int, piece binary"
_AUTOMATA = "shard int, words binary, moves binary, next binary, link binary, length binary"


def _pieces(reference: DataFrame, words: int, shards: int) -> DataFrame:
    """Reference texts of a window or more, cut so that each window is whole in a piece, by shard."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(0):
                own = text.as_py().encode().split()
                made += [b" ".join(own[k : k + PIECE_WORDS + words - 1]) for k in range(0, len(own) - words + 1, PIECE_WORDS)]
            number = [zlib.crc32(p) % shards for p in made]
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(made, pa.binary())], ["shard", "piece"])

    return arrow(reference.select("text"), scan, _PIECES)


def _automaton(rows: pa.Table) -> pa.Table:
    """A shard's automaton as arrays: words by number, transitions sorted by state and word, links and lengths."""
    numbers: dict[bytes, int] = {}
    made = substrings.SuffixAutomaton()
    for piece in sorted(set(rows.column("piece").to_pylist())):
        made.add(ts.exact_ids(piece.split(b" "), numbers).tolist())
    size = np.fromiter(map(len, made.next), np.int64, len(made.next))
    moves = np.repeat(np.arange(len(size)), size) * len(numbers) + np.fromiter(chain.from_iterable(made.next), np.int64, size.sum())
    to = np.fromiter(chain.from_iterable(x.values() for x in made.next), np.int32, size.sum())
    order = np.argsort(moves)
    values = [b"\n".join(numbers), moves[order].tobytes(), to[order].tobytes(), np.array(made.link, np.int32).tobytes(), np.array(made.length, np.int32).tobytes()]
    return pa.table([rows.column("shard").slice(0, 1).combine_chunks(), *([v] for v in values)], pa.schema([("shard", pa.int32()), *((n, pa.binary()) for n in ("words", "moves", "next", "link", "length"))]))


class Shard:
    """One automaton, as it was broadcast, which reads many texts at once."""

    def __init__(self, words: bytes, moves: bytes, to: bytes, link: bytes, length: bytes):
        self.words, self.moves, self.to = words.split(b"\n"), np.frombuffer(moves, np.int64), np.frombuffer(to, np.int32)
        self.link, self.length = np.frombuffer(link, np.int32), np.frombuffer(length, np.int32)

    def ends(self, ids: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
        """Whether the shard holds the `words` words that end here, for each word of texts at[i] .. at[i + 1] by this shard's numbers,
        -1 for words it does not have."""
        hit, here = np.zeros(len(ids), bool), np.arange(len(ids))
        since = here - np.maximum.accumulate(np.where(ids < 0, here, -1)) if len(ids) else here  # known words up to here
        possible = np.concatenate(([0], np.cumsum(since >= words)))
        lanes = np.maximum(0, -(-(np.diff(at) - words + 1) // LANE))
        text = np.repeat(np.arange(len(lanes)), lanes)
        begin = at[text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        stop = np.minimum(begin + LANE + words - 1, at[text + 1])
        some = possible[stop] > possible[begin + words - 1] if len(begin) else np.empty(0, bool)
        begin, stop = begin[some], stop[some]
        state, length = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        for step in range(int((stop - begin).max(initial=0))):
            place = begin + step
            inside = place < stop
            word = np.where(inside, ids[np.minimum(place, len(ids) - 1)], -1)
            open_ = np.flatnonzero(word >= 0)
            lost = word < 0
            while len(open_):
                move = state[open_] * len(self.words) + word[open_]
                found = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
                good = self.moves[found] == move
                went = open_[good]
                state[went] = self.to[found[good]]
                length[went] += 1
                back = open_[~good]
                lost[back[state[back] == 0]] = True
                open_ = back[state[back] > 0]
                state[open_] = self.link[state[open_]]
                length[open_] = self.length[state[open_]]
            state[lost] = length[lost] = 0
            long = inside & (length >= words)
            hit[place[long]] = True
        return hit


class Reference:
    """All shards, and the numbers of their words."""

    def __init__(self, rows: list[tuple[bytes, ...]]):
        self.rows, self.shards = rows, None

    def __getstate__(self) -> list[tuple[bytes, ...]]:
        return self.rows

    def __setstate__(self, rows: list[tuple[bytes, ...]]) -> None:
        self.rows, self.shards = rows, None

    def _ready(self) -> None:
        """Once a worker: one numbering of all words, and each shard's own numbers by it."""
        if self.shards is None:
            self.shards = [Shard(*row) for row in self.rows]
            self.known: dict[bytes, int] = {}
            own = [ts.exact_ids(s.words, self.known) for s in self.shards]
            self.numbers = []
            for ids in own:
                number = np.full(len(self.known) + 1, -1, np.int64)  # the last is for words that no shard has
                number[ids] = np.arange(len(ids))
                self.numbers.append(number)

    def covered(self, own: list[bytes], at: np.ndarray, words: int) -> np.ndarray:
        """Which of the words of texts at[i] .. at[i + 1] lie in a window that the reference holds."""
        self._ready()
        ids = np.fromiter((self.known.get(w, -1) for w in own), np.int64, len(own))
        ends = np.zeros(len(own), bool)
        for shard, number in zip(self.shards, self.numbers):
            ends |= shard.ends(number[ids], at, words)
        edge, last = np.zeros(len(own) + 1, np.int64), np.flatnonzero(ends)
        np.add.at(edge, last - words + 1, 1)
        np.subtract.at(edge, last + 1, 1)
        return np.cumsum(edge[:-1]) > 0


def remove_reference_spans(docs: DataFrame, reference: DataFrame, words: int = substrings.WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): docs without the maximal spans of at least `words` words that a text of the reference
    (column text) holds.

    References of up to MOST_SHARDS * SHARD_BYTES, measured first, are broadcast as suffix automata; docs are read once, in place. Every
    document passes every shard, so a larger reference is routed by anchors like a corpus to itself (substrings.remove_routed_spans),
    with the same result. A sequence over two reference texts is no match. Null and empty texts have no words; an empty
    reference removes nothing; rows stay apart whatever their ids; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    known = table(reference.select(F.col("text").cast("string").alias("text")).where("text is not null").distinct(), "reference")
    total = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total > MOST_SHARDS * SHARD_BYTES:
        return substrings.remove_routed_spans(docs, known, words)
    ship(spark)
    shards = max(1, math.ceil(total / SHARD_BYTES))
    built = _pieces(known, words, shards).groupBy("shard").applyInArrow(_automaton, _AUTOMATA)
    held = spark.sparkContext.broadcast(Reference([tuple(map(bytes, r[1:])) for r in built.orderBy("shard").toLocalIterator()]))  # MOST_SHARDS rows at most

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept = [], [], []
            for chunk in ts.chunks(batch.column(1), ts.SPACE_WORDS):
                own = chunk.words(0, len(chunk.start))
                gone = held.value.covered(own, chunk.at, words)
                lost = np.concatenate(([0], np.cumsum(gone)))
                left = np.flatnonzero(~gone)
                cut = np.searchsorted(left, chunk.at).tolist()
                rest = [own[i] for i in left.tolist()]
                n_words += np.diff(chunk.at).tolist()
                removed += np.diff(lost[chunk.at]).tolist()
                kept += [b" ".join(rest[a:b]).decode() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scan, substrings._KEPT)
