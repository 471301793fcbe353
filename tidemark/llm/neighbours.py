"""Nearest neighbours by randomly rotated one-bit codes with error bounds, and reranking on the vectors themselves.

The index is a table partitioned by cells around fitted centres: blocks of packed codes with their correction scalars and, in
columns that only the rerank reads, the vectors. Queries are broadcast in groups of bounded size. A first scan reads codes
alone and bounds each query's k-th distance from above; a second reads the cells that can hold something nearer, and
measures exactly what its codes' lower bounds allow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import arrow, cut, place, scope, table

SAMPLE_ROWS = 10_000  # vectors that the centres are fitted on
BLOCK_ROWS = 2048
MOST_CELLS = 1024
QUERY_BYTES = 16 << 20  # query vectors in one broadcast
TILE = 512  # queries that a block is compared with at once
PAIRS = 50_000  # vectors measured at once
BOUND = 3.0  # deviations allowed to an estimate

_CODES = ["cell", "n", "ids", "bits", "norm", "fit"]
_BLOCK = "cell int, n int, ids binary, bits binary, norm binary, fit binary, vectors binary"
_OUT = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """The fitted part of the index: centres of cells and a random rotation."""

    centres: np.ndarray
    rotation: np.ndarray

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        return np.argmin((self.centres**2).sum(axis=1) - 2 * vectors @ self.centres.T, axis=1)


def usable(vector: Column) -> Column:
    """Not null, not zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def fit(vectors: DataFrame, dim: int, rows: int, sample: int = SAMPLE_ROWS, steps: int = 6) -> Codes:
    """Codes for `rows` vectors of length dim: the centres are the means of about a cell for each BLOCK_ROWS, fitted on at most
    `sample` rows, by least hash of id."""
    held = np.array([r.vector for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).select("vector").collect()])
    cells = max(1, min(MOST_CELLS, math.ceil(rows / BLOCK_ROWS), len(held) // 8))
    rng = np.random.default_rng(7)
    codes = Codes(held[rng.choice(len(held), cells, replace=False)], np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    for _ in range(steps):
        of = codes.cell_of(held)
        count = np.bincount(of, minlength=cells)
        total = np.zeros((cells, dim))
        np.add.at(total, of, held)
        codes = Codes(np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], codes.centres), codes.rotation)
    return codes


def blocks(vectors: DataFrame, codes: Codes) -> DataFrame:
    """One row for up to BLOCK_ROWS vectors of a cell: packed one-bit codes of their offsets from the centre, the offsets' norms
    and correction scalars, and the vectors."""
    dim = codes.dim

    def pack(cell: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        turned = (v - codes.centres[cell]) @ codes.rotation
        norm = np.linalg.norm(turned, axis=1)
        fit = np.where(norm > 0, np.abs(turned).sum(axis=1) / np.maximum(norm, 1e-300) / math.sqrt(dim), 1.0)
        cells = [ids, np.packbits(turned > 0, axis=1), norm, fit, v]
        return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in cells)], [*_CODES, "vectors"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            of = codes.cell_of(v)
            for cell in np.unique(of).tolist():
                held.setdefault(cell, []).append((ids[of == cell], v[of == cell]))
                if sum(len(i) for i, _ in held[cell]) >= BLOCK_ROWS:
                    own_ids, own = (np.concatenate(x) for x in zip(*held.pop(cell)))
                    for a in range(0, len(own_ids), BLOCK_ROWS):
                        yield pack(cell, own_ids[a : a + BLOCK_ROWS], own[a : a + BLOCK_ROWS])
        for cell, parts in held.items():
            yield pack(cell, *(np.concatenate(x) for x in zip(*parts)))

    return arrow(vectors.select("vec_id", "vector"), scan, _BLOCK)


@dataclass(frozen=True)
class Queries:
    """Query vectors of one broadcast, also rotated, and bounds on their k-th squared distance."""

    ids: np.ndarray
    vectors: np.ndarray
    turned: np.ndarray
    limit: np.ndarray


def _estimates(queries: Queries, part: slice, block: dict, codes: Codes, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of some queries to a block's vectors, from its codes, and how far they may be off."""
    dim, n = codes.dim, block["n"]
    bits = np.unpackbits(np.frombuffer(block["bits"], np.uint8).reshape(n, -1), axis=1, count=dim)
    norm, fit = np.frombuffer(block["norm"]), np.maximum(np.frombuffer(block["fit"]), 1e-12)
    signs = (bits.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
    turned = queries.turned[part] - codes.centres[block["cell"]] @ codes.rotation
    far = np.linalg.norm(turned, axis=1)[:, None]
    inner = (turned.astype(np.float32) @ signs.T) / fit
    near = far**2 + norm**2 - 2 * norm * inner
    spread = np.sqrt(np.maximum(0, 1 - fit**2)) / fit * (bound / math.sqrt(max(1, dim - 1)))
    return near, 2 * norm * spread * far + 1e-6 * (far**2 + norm**2)


def _bounds(index: DataFrame, queries, codes: Codes, k: int, bound: float) -> DataFrame:
    """(at, high): for each query, by its place, k upper bounds of squared distances from each task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        best = np.full((len(q.ids), k), np.inf)
        for batch in batches:
            for block in batch.to_pylist():
                ids = np.frombuffer(block["ids"], np.int64)
                for a in range(0, len(q.ids), TILE):
                    part = slice(a, a + TILE)
                    near, slack = _estimates(q, part, block, codes, bound)
                    high = np.where(ids == q.ids[part, None], np.inf, near + slack)
                    high = np.concatenate((best[part], np.partition(high, k - 1, axis=1)[:, :k] if high.shape[1] > k else high), axis=1)
                    best[part] = np.partition(high, k - 1, axis=1)[:, :k]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(best))), pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1) * k, pa.int32()), pa.array(best.ravel()))], ["at", "high"])

    return arrow(index.select(*_CODES), scan, "at long, high array<double>")


def _measured(index: DataFrame, queries, codes: Codes, k: int, bound: float) -> DataFrame:
    """Up to k of _OUT for each query from each task: exact distances to all vectors that the bounds allow."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        at, found, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        limit = q.limit.copy()
        for batch in batches:
            for block in batch.to_pylist():
                ids = np.frombuffer(block["ids"], np.int64)
                vectors = np.frombuffer(block["vectors"]).reshape(block["n"], codes.dim)
                for a in range(0, len(q.ids), TILE):
                    part = slice(a, a + TILE)
                    near, slack = _estimates(q, part, block, codes, bound)
                    i, j = np.nonzero((near - slack <= limit[part, None]) & (ids != q.ids[part, None]))
                    i += a
                    exact = np.concatenate([np.empty(0), *(np.sqrt(((vectors[j[b : b + PAIRS]] - q.vectors[i[b : b + PAIRS]]) ** 2).sum(axis=1)) for b in range(0, len(i), PAIRS))])
                    at, found, score = np.concatenate((at, i)), np.concatenate((found, ids[j])), np.concatenate((score, exact))
                order = np.lexsort((found, score, at))
                at, found, score = at[order], found[order], score[order]
                place = np.arange(len(at)) - np.searchsorted(at, at, "left")
                last = place == k - 1
                limit[at[last]] = np.minimum(limit[at[last]], score[last] ** 2 * (1 + 1e-9))
                at, found, score = (x[place < k] for x in (at, found, score))
        yield pa.RecordBatch.from_arrays([pa.array(q.ids[at]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    return arrow(index.select(*_CODES, "vectors"), scan, _OUT)


def _groups(asked: DataFrame, rows: int) -> list[Column]:
    """Conditions that cut the queries into groups of about `rows`, near ones together: whole cells, or parts of one by hash."""
    groups, held, n = [], [], 0
    for r in asked.groupBy("cell").count().orderBy("cell").collect():  # one row a cell
        parts = math.ceil(r["count"] / rows)
        if parts > 1:
            groups += [(F.col("cell") == r.cell) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == p) for p in range(parts)]
            continue
        if held and n + r["count"] > rows:
            groups.append(F.col("cell").isin(held))
            held, n = [], 0
        held.append(r.cell)
        n += r["count"]
    return groups + ([F.col("cell").isin(held)] if held else [])


def search(vectors: DataFrame, every: int = 100, k: int = 10, bound: float = BOUND, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its k nearest by Euclidean distance.

    The index holds every row. Each group of queries, of QUERY_BYTES at most, is one broadcast and two scans; nothing is
    joined or crossed, and a vector is measured if its code, within `bound` deviations, may be nearer than the k-th. Ties go
    to the smaller id.

    Rows with a null id, or a vector that is null, zero, holds null or non-finite components, or has another length than
    most rows (of equally common lengths, the smallest), take no part. Of query rows repeating an id the smallest vector is
    the query; candidates repeating an id are all candidates. Equal vectors tie. An empty table gives no rows.
    """
    v = F.col(vector_col).cast("array<double>")
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    common = source.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], _OUT).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    source, dim = source.where(F.size("vector") == common["dim"]), common["dim"]
    with scope(spark):
        return _searched(source, dim, common["count"], every, k, bound)


def _searched(source: DataFrame, dim: int, rows_in_all: int, every: int, k: int, bound: float) -> DataFrame:
    spark = source.sparkSession
    codes = fit(source, dim, rows_in_all)
    index = table(blocks(source, codes), "ann-index", partition="cell")
    single = source.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.cell_of(own).astype(np.int32))], ["vec_id", "vector", "cell"])

    asked = cut(arrow(single, celled, "vec_id long, vector array<double>, cell int"))
    # the farthest that a row of each cell lies from its centre: one number a cell
    norms = arrow(index.select("cell", "norm"), lambda batches: (_farthest(b) for b in batches), "cell int, far double")
    far = {r.cell: r.far for r in norms.groupBy("cell").agg(F.max("far").alias("far")).collect()}
    cells, reach = np.array(sorted(far)), np.array([far[c] for c in sorted(far)])
    out, groups = place(spark, "neighbours", outer=True), 0
    for group in _groups(asked, max(1, QUERY_BYTES // (8 * dim))):
        rows = asked.where(group).select("vec_id", "vector").collect()  # QUERY_BYTES at most, but for hash parts a little larger
        q = np.array([r.vector for r in rows])
        ids, limit = np.array([r.vec_id for r in rows]), np.full(len(rows), np.inf)
        first = spark.sparkContext.broadcast(Queries(ids, q, q @ codes.rotation, limit))
        highs = _bounds(index, first, codes, k, bound)
        for by in (["at", F.pmod(F.hash("high"), F.lit(64)).alias("_part")], ["at"]):  # in two steps, as every task sends k
            highs = highs.groupBy(*by).agg(F.slice(F.sort_array(F.flatten(F.collect_list("high"))), 1, k).alias("high"))
        for r in highs.select("at", F.element_at("high", -1).alias("high")).toLocalIterator():  # one number a query of the group
            limit[r["at"]] = r.high
        least = np.maximum(0, np.sqrt(np.maximum(0, _squares(q, codes.centres[cells]))) * (1 - 1e-6) - reach)
        needed = cells[(least**2 <= limit[:, None]).any(axis=0)]
        held = spark.sparkContext.broadcast(Queries(ids, q, first.value.turned, limit))
        part = _measured(index.where(F.col("cell").isin(needed.tolist())), held, codes, k, bound)
        part.write.mode("overwrite").parquet(f"{out}/group={groups}")
        first.destroy()  # what the driver and the executors hold does not grow with the groups
        held.destroy()
        groups += 1
    found = spark.read.schema(_OUT).parquet(out) if groups else spark.createDataFrame([], _OUT)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T


def _farthest(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array([float(np.frombuffer(x, np.float64).max()) for x in batch.column(1).to_pylist()], pa.float64())], ["cell", "far"])
