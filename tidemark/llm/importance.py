"""Importance resampling towards a target distribution over hashed n-grams.

Texts become a sparse matrix, documents by buckets, which is stored as CSR blocks: a row of the table holds the counts of a few thousand
documents. Column sums of two such matrices are the distributions, their ratio gives each bucket a gain, and a sparse
matrix-vector product with the gains gives each document's weight. Adding Gumbel noise to the weights and taking the
highest scores draws without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.scratch import arrow, scope, table
from tidemark.llm.sizes import small

BUCKETS = 10_000
MOST_BUCKETS = 1_000_000  # of a broadcast of eight bytes each
BLOCKS = 4  # CSR blocks of a Parquet row group, which a task holds whole
GROUP = 256  # scores, or groups of scores, that one window adds up
CSR = "doc_ids array<bigint>, n_words array<bigint>, indptr array<bigint>, indices array<int>, counts array<bigint>"


def crc32_of(padded: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run of bytes, a byte of all runs at a time; long runs on their own."""
    steps = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    crc, live, done = np.full(len(start), 0xFFFFFFFF, np.uint32), np.flatnonzero((size > 0) & (size <= ts.LONG)), 0
    while len(live):
        held = crc[live]
        crc[live] = steps[(held ^ padded[start[live] + done]) & 0xFF] ^ (held >> np.uint32(8))
        done += 1
        live = live[size[live] > done]
    crc = ~crc
    for i in np.flatnonzero(size > ts.LONG).tolist():
        crc[i] = zlib.crc32(padded[start[i] : start[i] + size[i]])
    return crc


def _runs(chunk: ts.Chunk, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, CRC-32) of all runs of 1 to `longest` words of a text, joined by one space."""
    size = chunk.end - chunk.start
    for n in range(1, longest + 1):
        if n == 1:
            yield np.repeat(np.arange(chunk.n), np.diff(chunk.at)), crc32_of(chunk.shown, chunk.start, size)
            continue
        if n == 2:  # words end to end, each with a space behind it
            place = np.concatenate(([0], np.cumsum(size + 1)))
            joined = np.full(int(place[-1]) + 7, 0x20, np.uint8)
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            joined[np.repeat(place[:-1], size) + inside] = chunk.shown[np.repeat(chunk.start, size) + inside]
        begin, text = ts.window_starts(chunk.at, n)
        yield text, crc32_of(joined, place[begin], place[begin + n] - 1 - place[begin])


def count_matrix(docs: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """docs (doc_id, text) as CSR blocks, one a row: row i of a block is document doc_ids[i] of n_words[i] words, whose buckets
    are indices[indptr[i] : indptr[i + 1]], ascending, and their counts beside them. Features are runs of 1 to `longest`
    words; a feature's bucket is its CRC-32 modulo `buckets`. A null text has no words, and every document has a row."""
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in ts.chunks(batch.column(1), ts.ALNUM_WORDS_LOWER):
                parts = [text * buckets + crc.astype(np.int64) % buckets for text, crc in _runs(chunk, longest)] if len(chunk.code) else [np.empty(0, np.int64)]
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                indptr = np.searchsorted(keys, np.arange(chunk.n + 1) * buckets)
                whole = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(
                    [whole(batch.column(0).slice(chunk.first, chunk.n), pa.int64()), whole(np.diff(chunk.at), pa.int64()), whole(indptr, pa.int64()),
                     whole((keys % buckets).astype(np.int32), pa.int32()), whole(counts, pa.int64())],
                    ["doc_ids", "n_words", "indptr", "indices", "counts"],
                )

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scan, CSR)


def _flat(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of a matrix's buckets that occur: a task sums its blocks, so no more than `buckets` rows of each are shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, n = _flat(batch.column(0)), _flat(batch.column(1))
            keys, inverse = np.unique(at, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, inverse, n)
            total[keys] += sums
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    return arrow(matrix.select("indices", "counts"), add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the source, in doubles, from column sums: `buckets` numbers."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for held, sums in ((s, source), (t, target)):
        for row in sums.toLocalIterator():  # a row a bucket
            held[row.bucket] = row.n
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1.0) * all_s / ((float(a) + 1.0) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weights(matrix: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the gains over each document's features, 0 for none."""
    held = matrix.sparkSession.sparkContext.broadcast(gain)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.concatenate(([0], np.cumsum(batch.column(1).value_lengths().to_numpy())))
            entries = np.concatenate(([0], np.cumsum(batch.column(3).value_lengths().to_numpy())))
            indptr, indices, counts = _flat(batch.column(2)), _flat(batch.column(3)), _flat(batch.column(4))
            first = np.arange(len(rows) - 1) + rows[:-1]  # a block has one more pointer than rows
            ids, words = batch.column(0).flatten(), batch.column(1).flatten()
            total = np.concatenate(([0], np.cumsum(counts)))
            value = np.concatenate(([0], np.cumsum(counts * held.value[indices])))
            pointer = np.delete(indptr, first + np.diff(rows)) + np.repeat(entries[:-1], np.diff(rows))
            after = np.delete(indptr, first) + np.repeat(entries[:-1], np.diff(rows))
            n = total[after] - total[pointer]
            mean = np.where(n > 0, (value[after] - value[pointer]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([ids, words, pa.array(n), pa.array(mean)], ["doc_id", "n_words", "n_features", "weight"])

    return arrow(matrix, multiply, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the first 8 hex digits of sha256('<seed>:<doc_id>'); a null id is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _before(counts: DataFrame, key: str) -> DataFrame:
    """(key, before): how many rows have a higher key, from (key, n). Keys are summed in groups of GROUP, and those in groups, until one
    window of GROUP rows or fewer is left."""
    span = counts.agg(F.min(key), F.max(key)).first()
    higher = lambda *by: Window.partitionBy(*by).orderBy(F.desc(key)).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    if span[0] is None or span[1] - span[0] < GROUP:
        return counts.select(key, F.coalesce(F.sum("n").over(higher()), zero).alias("before"))
    up = f"{key}_up"
    upper = counts.withColumn(up, F.floor(F.col(key) / GROUP))
    above = _before(table(upper.groupBy(up).agg(F.sum("n").alias("n")), "score-groups"), up).withColumnRenamed("before", "above")
    inside = upper.withColumn("inside", F.coalesce(F.sum("n").over(higher(up)), zero))
    return inside.join(above, up).select(key, (F.col("inside") + F.col("above")).alias("before"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = BUCKETS, longest: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of docs (doc_id, text), resampled towards target (text).

    Of the N rows with at least min_words words the floor(percent * N / 100) of the highest scores are drawn; rank counts them from
    1, equal scores by smaller doc_id (null last), then fewer features; other rows have a null rank. Null and empty texts have no features and
    weight 0. Repeated rows score alike and are ranked one after the other. Without target text all gains come from the smoothing.
    Scores are whole numbers, so ranks are counts of rows with a higher score, and only rows of one score are sorted together.
    """
    with scope(docs.sparkSession):
        matrix = table(count_matrix(docs, buckets, longest), "csr-documents", group=BLOCKS)
        wanted = table(count_matrix(target.select(F.lit(0).alias("doc_id"), "text"), buckets, longest), "csr-target", group=BLOCKS)
        gain = gains(column_sums(matrix, buckets), column_sums(wanted, buckets), buckets)
        scored = weights(matrix, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
        scored = table(scored, "scores")
        fit = scored.where(F.col("n_words") >= min_words)
        drawn = fit.count() * percent // 100
        before = table(_before(table(fit.groupBy("score").agg(F.count("*").alias("n")), "score-counts"), "score"), "score-ranks")
        placed = scored.join(small(before), "score", "left")
        near = F.coalesce((F.col("n_words") >= min_words) & (F.col("before") < drawn), F.lit(False))  # the drawn rows, and ties of the last
        tied = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
        rank = F.col("before") + F.row_number().over(tied)
        columns = ["doc_id", "n_features", "weight", "score"]
        ranked = placed.where(near).select(*columns, rank.alias("rank")).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
        rest = placed.where(~near).select(*columns, F.lit(None).cast("long").alias("rank"))
        return table(ranked.unionByName(rest), "resampled", outer=True)
