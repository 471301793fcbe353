"""Limits that decide between a broadcast and a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # of one or two numbers each; callers with wider rows give a lower bound
BROADCAST_BYTES = 16 << 20  # of texts and bytes in them


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for a broadcast if its counted rows and bytes of text (it should be materialised) are within the bounds, else as it is."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, kind in df.dtypes if kind in ("string", "binary")]
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(sum(wide, F.lit(0))), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df
