"""Substring deduplication: words covered by a long word sequence that an earlier document also holds are removed.

The reference of a corpus compared with itself is the corpus, so a broadcast of every reference shard's automaton to every
document would cost the square of the corpus. Instead passages are routed: the least hash of the word groups in a window,
its anchor, is the same wherever the window stands, so passages around anchors that several documents hold meet in the
shard of that anchor. There a suffix automaton of the shard's passages, whose states know the smallest document they occur
in, is read by every passage for its matching statistics. Hashes only choose the shard; what repeats is told by words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, table
from tidemark.shipping import ship

_U = np.uint64
WORDS = 13
GRAM = 6  # words of an anchor
BUCKET_BYTES = 8 << 20  # text bytes for each hash partition
TASK_BYTES = 32 << 20  # text bytes for each task of a shuffle
HELD = 1_000_000  # entries that a task gathers before it packs them
SHARD_WORDS = 20_000  # words of a shard's automaton, which has at most twice as many states; one larger anchor is a shard of its own
HOT = 5_000  # documents of an anchor beyond which its windows are routed one by one, by all their words
MOST_HOT = 4_000_000  # anchors so marked: 32 MB in a broadcast

_ANCHORS = "bucket int, known boolean, hashes binary, docs binary, groups binary, counts binary"
_LISTS = "g int, hashes binary, docs binary"
_PASSAGES = "bucket int, known boolean, keys binary, docs binary, marks binary, groups binary, starts binary, ends binary, texts array<binary>"
_SPANS = "g int, docs binary, marks binary, starts binary, ends binary"
_KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _anchors(chunk: ts.Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the chunk its anchor, the least hash of the word groups inside it, and its text."""
    gram = min(GRAM, words)
    begin, text = ts.window_starts(chunk.at, words)
    least = ts.sequence_hash(chunk.code, np.arange(max(0, len(chunk.code) - gram + 1)), gram)
    have, need = 1, words - gram + 1
    while have < need:  # minima of twice as many groups, up to all that a window holds
        step = min(have, need - have)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        have += step
    return least[begin] if len(begin) else np.empty(0, _U), text


def _packed(part: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """One row a part, in order: its number, and its values as bytes."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, np.int64)
    cut = np.append(at, len(part))
    lists = [pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((cut * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[order]))]) for x in values]
    return [pa.array(part[at].astype(np.int32)), *lists]


def _joined(rows: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


def _anchor_rows(hashes: list[np.ndarray], docs: list[np.ndarray], groups: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """What one task knows of anchors: those of several documents, by group of these, and one entry an anchor for its bucket."""
    h, d, g = (np.concatenate(x) for x in (hashes, docs, groups))
    order = np.lexsort((g, d, h))
    h, d, g = h[order], d[order], g[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (g[1:] != g[:-1])))
    h, d, g = h[new], d[new], g[new]
    first = np.concatenate(([True], h[1:] != h[:-1]))
    count = np.diff(np.append(np.flatnonzero(first), len(h)))
    many = np.repeat(count > 1, count)
    for known, take, part in ((True, many, g), (False, first, (h % _U(buckets)).astype(np.int64))):
        c = count if not known else np.zeros(int(many.sum()), np.int64)
        number, *lists = _packed(part[take].astype(np.int64), h[take], d[take], g[take].astype(np.int32), c.astype(np.int64))
        yield pa.RecordBatch.from_arrays([number, pa.array([known] * len(number), pa.bool_()), *lists], ["bucket", "known", "hashes", "docs", "groups", "counts"])


def _anchor_entries(docs: DataFrame, words: int, buckets: int) -> DataFrame:
    """Packed entries of the anchors of all windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], []), 0
        for batch in batches:
            ids, groups = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for chunk in ts.chunks(batch.column(2), ts.SPACE_WORDS):
                anchor, text = _anchors(chunk, words)
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                at = chunk.first + text[new]
                for into, x in zip(held, (anchor[new], ids[at], groups[at])):
                    into.append(x)
                n += len(at)
                if n >= HELD:
                    yield from _anchor_rows(*held, buckets)
                    held, n = ([], [], []), 0
        if n:
            yield from _anchor_rows(*held, buckets)

    return arrow(docs.select("doc_id", "g", "text"), scan, _ANCHORS)


def _shared_anchors(entries: DataFrame, hot: int) -> DataFrame:
    """(g, hashes, docs) of anchors that several documents hold, by group of these; the group -1 has the anchors of more than
    `hot` documents, with their number, and the group -2 the number of all entries."""

    def scan(rows: pa.Table) -> pa.Table:
        known = rows.filter(rows.column("known"))
        rows = rows.filter(pc.invert(rows.column("known")))
        h, d, g, c = (_joined(rows, n, k) for n, k in (("hashes", _U), ("docs", np.int64), ("groups", np.int32), ("counts", np.int64)))
        order = np.argsort(h, kind="stable")
        h, d, g, c = h[order], d[order], g[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
        n, total = np.diff(np.append(first, len(h))), np.add.reduceat(c, first) if len(h) else c
        take, many = np.repeat(n > 1, n), total > hot
        number, *lists = _packed(np.concatenate((g[take].astype(np.int64), np.full(int(many.sum()), -1), [-2])), np.concatenate((h[take], h[first[many]], [_U(0)])), np.concatenate((d[take], total[many], [c.sum()])))
        found = pa.Table.from_arrays([number, *lists], ["g", "hashes", "docs"])
        return pa.concat_tables([known.select(["bucket", "hashes", "docs"]).rename_columns(["g", "hashes", "docs"]), found])

    return entries.groupBy("bucket").applyInArrow(scan, _LISTS)


class _ByDoc:
    """Hashes by doc, from the rows of one group."""

    def __init__(self, rows: pa.Table):
        h, d = _joined(rows, "hashes", _U), _joined(rows, "docs", np.int64)
        order = np.argsort(d, kind="stable")
        self.hashes, self.docs = h[order], d[order]

    def of(self, doc: int) -> np.ndarray:
        return self.hashes[np.searchsorted(self.docs, doc, "left") : np.searchsorted(self.docs, doc, "right")]


def _runs(chunk: ts.Chunk, ids: np.ndarray, known: _ByDoc, hot: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first word, last word + 1) of the chunk's passages: runs of windows of one anchor that several documents hold,
    by that anchor; single windows by their own hash where the anchor is hot."""
    anchor, text = _anchors(chunk, words)
    begin, _ = ts.window_starts(chunk.at, words)
    at, keep = np.searchsorted(text, np.arange(chunk.n + 1)), np.zeros(len(anchor), bool)
    for i in range(chunk.n):
        own = known.of(ids[chunk.first + i])
        if len(own):
            keep[at[i] : at[i + 1]] = np.isin(anchor[at[i] : at[i + 1]], own)
    place = np.flatnonzero(keep)
    anchor, begin = anchor[place], begin[place]
    alone = np.isin(anchor, hot)
    new = np.ones(len(place), bool)
    new[1:] = alone[1:] | alone[:-1] | (anchor[1:] != anchor[:-1]) | (begin[1:] != begin[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    key = np.where(alone[first], ts.sequence_hash(chunk.code, begin[first], words), anchor[first])
    return key, begin[first], begin[last] + words


def _text_blob(chunk: ts.Chunk) -> tuple[bytes, np.ndarray]:
    """The chunk's words, a space after each, and where each begins."""
    width = chunk.end - chunk.start
    at = np.concatenate(([0], np.cumsum(width + 1)))
    out = np.full(at[-1], 32, np.uint8)
    place = np.arange(width.sum()) + np.repeat(np.arange(len(width)), width)
    out[place] = chunk.data[np.arange(width.sum()) + np.repeat(chunk.start - np.cumsum(width) + width, width)]
    return out.tobytes(), at


def _passage_rows(found: dict[tuple[int, bytes], list[tuple]], buckets: int, below: int | None) -> pa.Table:
    """What one task knows of passages: spans of documents that repeat a smaller one of the task, and an entry for the bucket of
    the key for the others."""
    spans, sent = [], []
    for (key, text), holders in found.items():
        least = min(holders)[0]
        n = text.count(b" ") + 1
        for doc, mark, g, start in holders:
            if least < doc and (below is None or least < below):
                spans.append((g, doc, mark, start, start + n))
            else:
                sent.append((key, doc, mark, g, start, start + n, text))
    parts = []
    if spans:
        g, *values = (np.array(x, np.int64) for x in zip(*spans))
        number, docs, marks, starts, ends = _packed(g, *values)
        none, empty = pa.array([b""] * len(number), pa.binary()), pa.array([[]] * len(number), pa.list_(pa.binary()))
        parts.append(pa.Table.from_arrays([number, pa.array([True] * len(number)), none, docs, marks, none, starts, ends, empty], _names(_PASSAGES)))
    if sent:
        key = np.array([x[0] for x in sent], _U)
        part = (key % _U(buckets)).astype(np.int64)
        values = [np.array([x[k] for x in sent], t) for k, t in ((1, np.int64), (2, np.int64), (3, np.int32), (4, np.int64), (5, np.int64))]
        number, keys, docs, marks, groups, starts, ends = _packed(part, key, *values)
        order = np.argsort(part, kind="stable")
        counts = np.diff(np.append(np.flatnonzero(np.concatenate(([True], np.diff(part[order]) != 0))), len(order)))
        texts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array([sent[i][6] for i in order.tolist()], pa.binary()))
        parts.append(pa.Table.from_arrays([number, pa.array([False] * len(number)), keys, docs, marks, groups, starts, ends, texts], _names(_PASSAGES)))
    return pa.concat_tables(parts) if parts else pa.Table.from_arrays([pa.array([], t) for t in (pa.int32(), pa.bool_(), *[pa.binary()] * 6, pa.list_(pa.binary()))], _names(_PASSAGES))


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


class SuffixAutomaton:
    """All word sequences of some texts: states with transitions, suffix links, longest lengths and the least owner."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner, self.last = [-1], [0], [math.inf], 0

    def add(self, text: list[int], owner: int = 0) -> None:
        self.last = 0
        for word in text:
            self._extend(word)
            if owner < self.owner[self.last]:
                self.owner[self.last] = owner

    def _state(self, moves: dict[int, int], link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(math.inf)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A copy of q for the sequences that end p + word."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, word: int) -> None:
        p, q = self.last, self.next[self.last].get(word)
        if q is not None:  # a sequence of an earlier text
            self.last = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
            return
        new = self._state({}, 0, self.length[p] + 1)
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        self.last = new

    def settle(self) -> None:
        """After the last text: a state's sequences also occur where those of states linked to it do."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.owner[state] < self.owner[up]:
                self.owner[up] = self.owner[state]

    def _walk(self, text: list[int]) -> Iterator[tuple[int, int]]:
        """For each word, the state and length of the longest sequence ending there that some added text holds."""
        state = length = 0
        for word in text:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield state, length

    def matching(self, text: list[int]) -> list[int]:
        """For each word, the length of the longest sequence ending there that some added text holds."""
        return [length for _, length in self._walk(text)]

    def owners(self, text: list[int], words: int) -> list[float]:
        """For each window of `words` words, the least owner of a text that holds it; infinite where none does. After settle()."""
        out = []
        for state, length in self._walk(text):
            if length >= words:
                while self.length[self.link[state]] >= words:
                    state = self.link[state]
            out.append(self.owner[state] if length >= words else math.inf)
        return out[words - 1 :]


def _shards(key: np.ndarray, docs: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Entries of keys that several documents hold, in shards of whole keys with about SHARD_WORDS words."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(order) else order
    held, words = [], 0
    for a, b in zip(first.tolist(), np.append(first[1:], len(order)).tolist()):
        own = order[a:b]
        if b - a > 1 and (docs[own] != docs[own[0]]).any():
            held.append(own)
            words += int(size[own].sum())
            if words >= SHARD_WORDS:
                yield np.concatenate(held)
                held, words = [], 0
    if held:
        yield np.concatenate(held)


def _matched(passages: DataFrame, words: int, below: int | None) -> DataFrame:
    """(g, docs, marks, starts, ends): spans that a smaller document also holds, from the passages of each bucket."""

    def scan(rows: pa.Table) -> pa.Table:
        known = rows.filter(rows.column("known")).select(["bucket", "docs", "marks", "starts", "ends"]).rename_columns(_names(_SPANS))
        rows = rows.filter(pc.invert(rows.column("known")))
        key, docs, marks, groups, starts, ends = (_joined(rows, n, k) for n, k in (("keys", _U), ("docs", np.int64), ("marks", np.int64), ("groups", np.int32), ("starts", np.int64), ("ends", np.int64)))
        texts, spans = pa.concat_arrays([x for c in rows.column("texts").chunks for x in [c.flatten()]]) if rows.num_rows else pa.array([], pa.binary()), []
        for shard in _shards(key, docs, ends - starts):
            holders: dict[bytes, list[int]] = {}
            for i in shard.tolist():
                holders.setdefault(texts[i].as_py(), []).append(i)
            automaton, numbers = SuffixAutomaton(), {}
            read = [(ts.exact_ids(text.split(b" "), numbers).tolist(), own) for text, own in holders.items()]
            for text, own in read:
                automaton.add(text, int(docs[own].min()))
            automaton.settle()
            for text, own in read:
                least = np.array(automaton.owners(text, words))
                for i in own:
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], least < (docs[i] if below is None else min(docs[i], below)), [0]))))
                    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        spans.append((int(groups[i]), int(docs[i]), int(marks[i]), int(starts[i]) + a, int(starts[i]) + b - 1 + words))
        if not spans:
            return known
        g, *values = (np.array(x, np.int64) for x in zip(*spans))
        return pa.concat_tables([known, pa.Table.from_arrays(_packed(g, *values), _names(_SPANS))])

    return passages.groupBy("bucket").applyInArrow(scan, _SPANS)


def _kept(ids: pa.Array, texts: pa.Array, marks: np.ndarray | None, docs: np.ndarray | None, spans: dict[tuple[int, int], list[tuple[int, int]]]) -> pa.Table:
    """Rows of _KEPT: texts without the words of the spans of their (doc, mark)."""
    n_words, removed, kept = [], [], []
    for chunk in ts.chunks(texts, ts.SPACE_WORDS):
        for i in range(chunk.n):
            lo, hi = int(chunk.at[i]), int(chunk.at[i + 1])
            a, b = chunk.text_bytes(i)
            own = chunk.data[a:b].tobytes().split()
            gone = spans.get((int(docs[chunk.first + i]), int(marks[chunk.first + i]))) if spans else None
            n_words.append(hi - lo)
            if gone:
                edge = np.zeros(hi - lo + 1, np.int64)
                begin, end = map(list, zip(*gone))
                np.add.at(edge, begin, 1)
                np.subtract.at(edge, end, 1)
                own = list(compress(own, np.cumsum(edge[:-1]) == 0))
            removed.append(hi - lo - len(own))
            kept.append(b" ".join(own).decode("utf-8", "replace"))
    return pa.Table.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], _names(_KEPT))


def _without_repeats(source: DataFrame, words: int, below: int | None = None) -> DataFrame:
    """Rows of _KEPT for rows (id, doc_id, text): texts without the windows that a row of a smaller doc_id holds. Where `below` is
    given, rows of smaller ids are a reference: they alone count for others, and they are not returned."""
    spark = source.sparkSession
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, math.ceil(total / BUCKET_BYTES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    marked = source.withColumn("mark", F.xxhash64("text"))
    placed = marked.withColumn("g", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets)).cast("int")).select("id", "doc_id", "mark", "g", "text")
    by_group = placed.repartition(tasks, "g")
    ship(spark)
    anchors = table(_shared_anchors(_anchor_entries(placed, words, buckets).repartition(tasks, "bucket"), HOT), "anchors")
    entries = sum(int(np.frombuffer(r.docs, np.int64).sum()) for r in anchors.where("g = -2").select("docs").toLocalIterator())  # one number a bucket
    limit = max(HOT, math.ceil(entries / MOST_HOT))
    hot = [np.empty(0, _U)]
    for r in anchors.where("g = -1").select("hashes", "docs").toLocalIterator():
        hot.append(np.frombuffer(r.hashes, _U)[np.frombuffer(r.docs, np.int64) > limit])
    held = spark.sparkContext.broadcast(np.sort(np.concatenate(hot)))  # MOST_HOT at most, as each stands for more than entries / MOST_HOT

    def cut_out(rows: pa.Table, lists: pa.Table) -> pa.Table:
        known, found = _ByDoc(lists), {}
        ids, marks, groups = (rows.column(n).to_numpy() for n in ("doc_id", "mark", "g"))
        for chunk in ts.chunks(rows.column("text"), ts.SPACE_WORDS) if len(known.docs) else ():
            key, first, last = _runs(chunk, ids, known, held.value, words)
            blob, at = _text_blob(chunk)
            text = np.searchsorted(chunk.at, first, "right") - 1
            row, start = chunk.first + text, first - chunk.at[text]
            for k, a, b, d, m, g, s in zip(key.tolist(), at[first].tolist(), (at[last] - 1).tolist(), ids[row].tolist(), marks[row].tolist(), groups[row].tolist(), start.tolist()):
                found.setdefault((k, blob[a:b]), []).append((d, m, g, s))
        return _passage_rows(found, buckets, below)

    passages = by_group.groupBy("g").cogroup(anchors.where("g >= 0").repartition(tasks, "g").groupBy("g")).applyInArrow(cut_out, _PASSAGES)
    spans = _matched(passages.repartition(tasks, "bucket"), words, below)

    def finish(rows: pa.Table, lists: pa.Table) -> pa.Table:
        gone: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for d, m, a, b in zip(*(_joined(lists, n, np.int64).tolist() for n in ("docs", "marks", "starts", "ends"))):
            gone.setdefault((d, m), []).append((a, b))
        return _kept(rows.column("id").combine_chunks(), rows.column("text").combine_chunks(), rows.column("mark").to_numpy(), rows.column("doc_id").to_numpy(), gone)

    judged = by_group if below is None else by_group.where(F.col("doc_id") >= below)
    return judged.groupBy("g").cogroup(spans.repartition(tasks, "g").groupBy("g")).applyInArrow(finish, _KEPT)


def _whole(rows: DataFrame) -> DataFrame:
    """Rows of _KEPT for rows (id, text) that nothing is removed from."""

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _kept(batch.column(0), batch.column(1), None, None, {}).to_batches()

    return arrow(rows.select("id", "text"), bare, _KEPT)


def remove_repeated_spans(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of docs; kept is the remaining words joined by one space.

    A word goes if a window of `words` words over it also starts in a document with a smaller doc_id, judged on the input.

    Null or empty texts have no words; texts shorter than a window keep all; null ids have no order, so their words stay and
    count for nobody; rows repeating an id are one document's, so they do not remove each other's words; an empty table
    gives no rows; other columns are ignored. Rows that repeat id and text share a task.
    """
    doc = F.col("doc_id").cast("long")
    source = docs.select(doc.alias("id"), doc.alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _without_repeats(source.where("doc_id is not null"), words).unionByName(_whole(source.where("doc_id is null")))


def remove_routed_spans(docs: DataFrame, reference: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): docs without the maximal spans of at least `words` words that a text of the reference
    (column text) holds, of any size. The reference goes to the same shards, as a document before all others, which don't count for each other.

    A sequence over two reference texts is no match. Null and empty texts have no words; an empty reference removes nothing;
    rows stay apart whatever their ids; an empty table gives no rows.
    """
    text = F.col("text").cast("string").alias("text")
    rows = table(docs.select(F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("doc_id"), text), "numbered")
    known = reference.select(F.lit(None).cast("long").alias("id"), F.lit(-1).cast("long").alias("doc_id"), text).where("text is not null").distinct()
    return _without_repeats(rows.unionByName(known), words, 0)
