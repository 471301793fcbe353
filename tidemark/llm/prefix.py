"""Distributed prefix sums with DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 10  # a window has about 2 ** BLOCK_BITS rows


def block_bits(rows: int) -> int:
    """Leading hash bits that name a block, so that a block has about 2 ** BLOCK_BITS rows."""
    return max(1, math.ceil(math.log2(max(rows, 2))) - BLOCK_BITS)


def _offsets(sums: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(keys, _block, _offset) from (keys, _block, _sum): the sum of the blocks before. Blocks are named by `bits` bits; blocks of
    blocks get their offsets first, so that no window holds more than 2 ** BLOCK_BITS of a key's blocks."""
    if bits <= BLOCK_BITS:
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(*keys, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    upper = sums.withColumn("_upper", F.shiftrightunsigned("_block", BLOCK_BITS))
    above = _offsets(upper.groupBy(*keys, F.col("_upper").alias("_block")).agg(F.sum("_sum").alias("_sum")), keys, bits - BLOCK_BITS)
    before = Window.partitionBy(*keys, "_upper").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = upper.select(*keys, "_block", "_upper", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_inside"))
    above = above.select(*keys, F.col("_block").alias("_upper"), F.col("_offset").alias("_above"))
    return inside.join(above, [*keys, "_upper"]).select(*keys, "_block", (F.col("_inside") + F.col("_above")).alias("_offset"))


def running_sum(df: DataFrame, keys: list[str], value: Column, order: str | list[str], rows: int, out: str) -> DataFrame:
    """df with `out`: the sum of `value` over the rows of the same keys that come before in `order`, whose first column is a hash.

    No window holds a whole key: rows are cut into blocks by leading bits of the hash, block sums (one row a key and
    block) get offsets, in blocks of blocks, and only the order inside one block is a window over rows. keys must not be null;
    rows that are equal in `order` come one after the other in any order, so hashes should tell rows apart. `df` is read
    twice, so it should be a table.
    """
    order = [order] if isinstance(order, str) else order
    bits = block_bits(rows)
    held = df.withColumn("_v", value.cast("long")).withColumn("_block", F.shiftright(F.col(order[0]), 64 - bits) + (1 << bits - 1))
    offsets = _offsets(held.groupBy(*keys, "_block").agg(F.sum("_v").alias("_sum")), keys, bits)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = held.withColumn("_before", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return ranked.join(offsets, [*keys, "_block"]).withColumn(out, F.col("_before") + F.col("_offset")).drop("_v", "_block", "_before", "_offset")


def numbered_copies(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The rows of df's `columns` with `out`, which counts equal rows 0, 1, ...: equal rows are counted, not sorted, so that the
    numbers don't depend on their order and no key's rows meet in one window."""
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / 1000))))
    last = F.least((F.col("_part") + 1) * 1000, "_n") - 1
    return parts.select(*columns, F.explode(F.sequence(F.col("_part") * 1000, last)).alias(out))
