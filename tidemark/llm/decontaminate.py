"""Benchmark decontamination: broadcast hash sets of normalised test n-grams, training windows scanned against them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, table
from tidemark.llm.sizes import small

WORDS = 10
LEAK_ROWS = 100_000  # rows of an id and an MD5, or runs of words, in a broadcast
BROADCAST_BYTES = 8 << 20  # benchmark text behind one broadcast index of at most INDEX_BYTES; beyond it there are several scans
WINDOW_BYTES = 28  # of the index for a window: hash, place in the words, item
INDEX_BYTES = BROADCAST_BYTES * (1 + WINDOW_BYTES // 2)  # a window for every two bytes, at worst; about 5 times the text in prose


@dataclass
class Windows:
    """The different windows of one length, sorted by hash: places in the words' bytes; window k is held by the items
    item[at[k] : at[k + 1]]; a filter of leading hash bits."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    at: np.ndarray
    item: np.ndarray
    bits: int
    seen: np.ndarray


class Index:
    """Windows of benchmark items as flat arrays beside the items' normalised words."""

    def __init__(self, ids: list[int], texts: list[str], words: int):
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        blobs, size = [], 0
        for chunk in ts.chunks(pa.array(texts, pa.string()), ts.ALNUM_WORDS_LOWER):
            width = chunk.end - chunk.start
            first = np.cumsum(width + 1) - width - 1 + size  # words follow each other, a space after each
            blobs.append(b"".join(w + b" " for w in chunk.words(0, len(chunk.code))))
            size += len(blobs[-1])
            n = np.diff(chunk.at)
            for length in np.unique(np.minimum(n[n > 0], words)).tolist():
                take = n >= length if length == words else n == length
                at = np.stack((chunk.at[:-1][take], chunk.at[1:][take]), axis=1)
                count = at[:, 1] - at[:, 0] - length + 1
                begin = np.repeat(at[:, 0] - np.cumsum(count) + count, count) + np.arange(count.sum())
                item = np.repeat(np.array(ids, np.int64)[chunk.first + np.flatnonzero(take)], count)
                found.setdefault(length, []).append((ts.sequence_hash(chunk.code, begin, length), first[begin], first[begin + length - 1] + width[begin + length - 1], item))
        self.words, self.windows = b"".join(blobs), {}
        for length, parts in found.items():
            hashes, begin, end, item = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            hashes, begin, end, item = hashes[order], begin[order], end[order], item[order]
            new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            if not new.all():
                own, new = self._told_apart(np.cumsum(new) - 1, begin, end)
                hashes, begin, end, item = hashes[own], begin[own], end[own], item[own]
            first = np.flatnonzero(new)
            bits = min(24, max(10, int(len(first) * 8).bit_length()))
            seen = np.zeros(1 << bits, bool)
            seen[(hashes[first] >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.windows[length] = Windows(hashes[first], begin[first].astype(np.uint32), end[first].astype(np.uint32), np.append(first, len(hashes)), item, bits, np.packbits(seen, bitorder="little"))

    def _told_apart(self, run: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of windows, which are the first of their words), for windows sorted by hash in runs of equal ones."""
        number, known = np.zeros(len(run), np.int64), {}
        many = np.flatnonzero(np.bincount(run)[run] > 1)
        for k, r, a, b in zip(many.tolist(), run[many].tolist(), begin[many].tolist(), end[many].tolist()):
            own = known.setdefault(r, {})  # nearly always of one entry
            number[k] = own.setdefault(self.words[a:b], len(own))
        order = np.lexsort((number, run))
        run, number = run[order], number[order]
        return order, np.concatenate(([True], (run[1:] != run[:-1]) | (number[1:] != number[:-1])))

    def hits(self, chunk: ts.Chunk) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Marks of the chunk's words inside any occurrence, and the items met by each text; a hit has the words of its window."""
        edge, met = np.zeros(len(chunk.code) + 1, np.int64), {}
        for length, known in self.windows.items():
            begin, text = ts.window_starts(chunk.at, length)
            if not len(begin):
                continue
            hashes = ts.sequence_hash(chunk.code, begin, length)
            top = (hashes >> np.uint64(64 - known.bits)).astype(np.int64)
            maybe = np.flatnonzero(known.seen[top >> 3] >> (top & 7).astype(np.uint8) & 1)
            low, high = (np.searchsorted(known.hashes, hashes[maybe], side) for side in ("left", "right"))
            for k, a, b in zip(maybe[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                own = b" ".join(chunk.words(int(begin[k]), int(begin[k]) + length))
                for j in range(a, b):  # one, but where hashes collide
                    if self.words[known.begin[j] : known.end[j]] == own:
                        edge[begin[k]] += 1
                        edge[begin[k] + length] -= 1
                        met.setdefault(int(text[k]), set()).add((length, j))
        items = {}
        for i, found in met.items():
            parts = [self.windows[length].item[self.windows[length].at[j] : self.windows[length].at[j + 1]] for length, j in found]
            items[i] = np.unique(np.concatenate(parts))
        return np.cumsum(edge[:-1]) > 0, items


def _kept_text(chunk: ts.Chunk, i: int, hit: np.ndarray) -> str:
    """Text i without its hit words; each removed run takes the bytes from its first word to its last."""
    lo, hi = chunk.at[i], chunk.at[i + 1]
    run = np.flatnonzero(np.diff(np.concatenate(([0], hit[lo:hi].astype(np.int8), [0]))))
    a, b = chunk.text_bytes(i)
    out, at = [], a
    for first, after in zip(run[::2] + lo, run[1::2] + lo):
        out.append(chunk.data[at : chunk.start[first]].tobytes())
        at = chunk.end[after - 1]
    out.append(chunk.data[at:b].tobytes())
    return b"".join(out).decode("utf-8", "replace")


_SCHEMA = "doc_id long, text_md5 string, n_words long, begin array<int>, end array<int>, items array<long>"


def _scan(docs: DataFrame, index) -> DataFrame:
    """(doc_id, text_md5, n_words, begin, end, items): the hit runs as word positions and the items met."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        for batch in batches:
            for chunk in ts.chunks(batch.column(2), ts.ALNUM_WORDS_LOWER):
                hit, items = found.hits(chunk)
                begin, end, met = [], [], []
                for i in range(chunk.n):
                    lo, hi = chunk.at[i], chunk.at[i + 1]
                    if i not in items:
                        begin.append([]), end.append([]), met.append([])
                        continue
                    run = np.flatnonzero(np.diff(np.concatenate(([0], hit[lo:hi].astype(np.int8), [0]))))
                    begin.append(run[::2].tolist()), end.append(run[1::2].tolist()), met.append(items[i].tolist())
                part = batch.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(chunk.at)), *(pa.array(x, pa.list_(pa.int32())) for x in (begin, end)), pa.array(met, pa.list_(pa.int64()))],
                    ["doc_id", "text_md5", "n_words", "begin", "end", "items"],
                )

    text = F.col("text").cast("string")
    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("text_md5"), text.alias("text")), scan, _SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_md5, n_words, n_hit, begin, end, items) for every row of docs.

    A hit is a window of `words` consecutive normalised words of an item (all words of a shorter item) found in the
    document; hash hits are confirmed on the words. begin and end are the maximal hit runs as word positions, items the
    sorted ids met. Items are broadcast in groups of about most_bytes of text (one longer item is a group of its own);
    with several groups the documents are scanned once for each and the runs are merged.

    Null or empty texts have no words and no hits; items without id or words are left out; repeated ids of items are one
    item; repeated rows of docs stay; empty tables give no rows or no hits; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(total / most_bytes))
    scans = []
    for g in range(groups):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect()  # about most_bytes
        scans.append(_scan(docs, spark.sparkContext.broadcast(Index([r.item_id for r in own], [r.text for r in own], words))))
    found = scans[0]
    if groups > 1:
        hits = scans[0]
        for more in scans[1:]:
            hits = hits.unionByName(more)
        hits = table(hits, "hits")
        n_rows = hits.groupBy("doc_id", "text_md5", "n_words").agg((F.count("*") / groups).cast("int").alias("copies"))
        runs = hits.select("doc_id", "text_md5", F.explode(F.arrays_zip("begin", "end")).alias("r")).select("doc_id", "text_md5", "r.begin", "r.end").distinct()
        merged = runs.groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("r"))
        joined = F.aggregate(
            "r", F.array().cast("array<struct<begin:int,end:int>>"),
            lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["begin"]),
                                  F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(F.struct(x["begin"].alias("begin"), x["end"].alias("end"))))),
        )
        merged = merged.withColumn("r", joined)
        met = hits.select("doc_id", "text_md5", F.explode("items").alias("i")).groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_set("i")).alias("items"))
        merged = merged.withColumnsRenamed({"doc_id": "_i", "text_md5": "_t"})
        met = met.withColumnsRenamed({"doc_id": "_j", "text_md5": "_u"})
        same = lambda i, t: F.col("doc_id").eqNullSafe(F.col(i)) & F.col("text_md5").eqNullSafe(F.col(t))
        none = F.array().cast("array<int>")
        found = n_rows.join(merged, same("_i", "_t"), "left").join(met, same("_j", "_u"), "left").select(
            "doc_id", "text_md5", "n_words", F.coalesce(F.col("r.begin"), none).alias("begin"), F.coalesce(F.col("r.end"), none).alias("end"),
            F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_copy"),
        ).drop("_copy")
    n_hit = F.aggregate(F.zip_with("begin", "end", lambda b, e: (e - b).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_hit", n_hit)


def clean_documents(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """docs without the rows that contain a benchmark window; all columns stay as they are. See contamination()."""
    bad = table(contamination(docs, benchmark, words).where("n_hit > 0").select(F.col("doc_id").alias("_i"), F.col("text_md5").alias("_t")).distinct(), "leaks")
    return docs.join(small(bad, LEAK_ROWS), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.md5(F.col("text").cast("string").cast("binary")) == F.col("_t")), "left_anti")


def clean_spans(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text): every document, without the words inside any occurrence of a benchmark window. See contamination()."""
    found = contamination(docs, benchmark, words, most_bytes).where("n_hit > 0").select(F.col("doc_id").alias("_i"), F.col("text_md5").alias("_t"), "begin", "end")
    runs = table(found.dropDuplicates(["_i", "_t"]), "leak-spans")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wide = runs.agg(F.coalesce(F.sum(F.size("begin")), F.lit(0))).first()[0]
    runs = small(runs, LEAK_ROWS) if wide <= LEAK_ROWS else runs
    both = texts.join(runs, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.md5(F.col("text").cast("binary")) == F.col("_t")), "left").select("doc_id", "text", "begin", "end")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in ts.chunks(batch.column(1), ts.ALNUM_WORDS_LOWER):
                ids, own, begin, end = (batch.column(k).slice(chunk.first, chunk.n) for k in range(4))
                hit, kept = np.zeros(chunk.at[-1], bool), own.to_pylist()
                for i in np.flatnonzero(begin.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    for b, e in zip(begin[i].as_py(), end[i].as_py()):
                        hit[chunk.at[i] + b : chunk.at[i] + e] = True
                    kept[i] = _kept_text(chunk, i, hit)
                yield pa.RecordBatch.from_arrays([ids, pa.array(kept, pa.string())], ["doc_id", "text"])

    return arrow(both, scan, "doc_id long, text string")
