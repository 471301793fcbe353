"""Accounts cut into slices of time, so that one busy account spreads over many tasks.

A slice holds its own events and, before them, those of the slice before that lie within the halo, which must not be longer
than a slice. Tasks read slices sorted by time as Arrow batches and work on whole arrays of many slices at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.shipping import ship


def dealt(rows: DataFrame, time: str, halo_ms: int, length_ms: int, key: str = "account_id") -> DataFrame:
    """rows with `slice` and `own` (false on copies in the halo of the next slice), dealt out by key and slice."""
    if halo_ms > length_ms:
        raise ValueError("a halo must not be longer than a slice")
    at = F.floor(F.col(time) / length_ms)
    of = lambda n, own: F.struct((at + n).alias("slice"), F.lit(own).alias("own"))
    copies = F.when((at + 1) * length_ms - F.col(time) < halo_ms, F.array(of(0, True), of(1, False))).otherwise(F.array(of(0, True)))
    return rows.select("*", F.inline(copies)).repartition(key, "slice")


def sliced(rows: DataFrame, time: str, halo_ms: int, length_ms: int, order: list[str], key: str = "account_id") -> DataFrame:
    """As dealt(), in order within each slice."""
    return dealt(rows, time, halo_ms, length_ms, key).sortWithinPartitions(key, "slice", *order)


def whole_slices(batches: Iterator[pa.RecordBatch], key: tuple[int, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows of whole slices, of each row the number of its slice); `key` are the places of the key columns. The last slice of
    a batch waits for the next one."""
    held: list[pa.RecordBatch] = []  # of one slice
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = _last_start(batch, key)
        if cut:
            yield _numbered(pa.Table.from_batches([*held, batch.slice(0, cut)]), key)
            held = [batch.slice(cut)]
        elif held and _same(held[-1], 0, batch, 0, key):
            held.append(batch)
        else:
            if held:
                yield _numbered(pa.Table.from_batches(held), key)
            held = [batch]
    if held:
        yield _numbered(pa.Table.from_batches(held), key)


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, key: tuple[int, ...]) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in key)


def _changes(table: pa.Table | pa.RecordBatch, key: tuple[int, ...]) -> np.ndarray:
    """Whether each row but the first differs from the one before in its key."""
    out = np.zeros(max(table.num_rows - 1, 0), bool)
    for k in key:
        column = table.column(k)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)
        out |= codes[1:] != codes[:-1]
    return out


def _last_start(batch: pa.RecordBatch, key: tuple[int, ...]) -> int:
    at = np.flatnonzero(_changes(batch, key))
    return int(at[-1]) + 1 if len(at) else 0


def _numbered(table: pa.Table, key: tuple[int, ...]) -> tuple[pa.Table, np.ndarray]:
    return table, np.concatenate(([0], np.cumsum(_changes(table, key)))) if table.num_rows else np.empty(0, np.int64)


def over_slices(rows: DataFrame, work: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str | StructType, key: tuple[str, ...] = ("account_id", "slice")) -> DataFrame:
    """`work` on tables of whole slices of rows from sliced()."""
    ship(rows.sparkSession)
    places = tuple(rows.columns.index(k) for k in key)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in whole_slices(batches, places):
            yield work(table, number)

    return rows.mapInArrow(scan, schema)
