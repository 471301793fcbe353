"""Places that the driver and all executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.shipping import ship


ARROW_BYTES = "4m"  # of a batch that goes to a Python worker
_LOCAL = threading.local()  # each thread has scopes of its own
_LEFT: list[tuple[SparkSession, str]] = []  # tables outside all scopes, which hold results; deleted when the program ends


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _delete_left() -> None:
    while _LEFT:
        try:
            _delete(*_LEFT.pop())
        except Exception:  # the JVM may be gone before Python ends
            return


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only where that is unset and all runs on this machine (tests), a folder of it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-shared-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, as a table in the shared folder, which outlives lost executors.

    A table rather than checkpoint(): a checkpointed frame keeps the constraints of the plan it came from, and in
    iterative joins the optimiser's work on them doubles with every round.
    """
    return table(df, "cut")


def table(df: DataFrame, name: str, outer: bool = False, partition: str | None = None, group: int | None = None) -> DataFrame:
    """df written as a Parquet table in the shared folder, in folders by `partition` if given, and read again. Inside scope() it is deleted at its end, with
    `outer` at the end of the scope around it, outside at the end of the program. `group`: rows of a row group at most, for rows of megabytes, as a
    writer fills pages of 100 rows at least and a reader decodes all lists of a row group (or of 4,096 rows) at once."""
    path = place(df.sparkSession, name, outer)
    writer = df.write.option("parquet.block.row.count.limit", group) if group else df.write
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def place(spark: SparkSession, name: str, outer: bool = False) -> str:
    """A new path in the shared folder, deleted at the end of the scope (of the one around it with `outer`), or of the program."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes()[:-1] if outer else _scopes()
    if scopes:
        scopes[-1].append(path)
    else:
        _LEFT.append((spark, path))
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables made inside when it ends; what is still to be read must be written before, or be an outer table."""
    _scopes().append([])
    try:
        yield
    finally:
        for path in _scopes().pop():
            _delete(spark, path)


def arrow(df: DataFrame, scan, schema: str | StructType) -> DataFrame:
    """df.mapInArrow(scan, schema), with this package sent to the workers first and batches of bounded size."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(scan, schema)
