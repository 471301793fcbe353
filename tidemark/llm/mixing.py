"""Mixing sources to target weights: hash-random order in each source, distributed prefix sums, exact budgets, epochs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textscan as ts
from tidemark.llm.prefix import numbered_copies, running_sum
from tidemark.llm.scratch import arrow, cut, table
from tidemark.llm.sizes import small

MOST_EPOCHS = 3
WEIGHTS = 3  # 1, 2, 3, repeating
SOURCE_ROWS = 50_000  # rows named by a source in a broadcast; sources of 200 bytes make them 15 MB


def word_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, mark): the number of words of each whole text, 0 for null, and a hash of it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ts.word_counts(batch.column(2), ts.SPACES)), batch.column(3)], ["doc_id", "source", "size", "mark"])

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("mark")]
    return arrow(docs.select(*cols), scan, "doc_id long, source string, size long, mark long")


def source_targets(sizes: DataFrame, epochs: int = MOST_EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """(source, source_size, target): one row a source, by code point with null last, weighing 1 .. weights in turn.

    Targets share the sum of all sizes by weight; none passes epochs * source_size, what is over goes to the others by
    weight until none is above. That fixed point is a water level: with sources ordered by cap / weight, the first whose
    cap lies above the level left by those before it sets the level. The windows hold one row a source.
    """
    totals = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = totals.withColumn("w", (F.row_number().over(by_name) - 1) % weights + 1).withColumn("cap", epochs * F.col("source_size").cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everyone = Window.partitionBy()
    level = named.select(
        "source", "source_size", "w", "cap",
        F.row_number().over(by_cap).alias("k"),
        (F.sum("source_size").over(everyone).cast("double")
         - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).alias("left"),
        F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"),
    ).withColumn("level", F.col("left") / F.col("w_left"))
    free = F.when(F.col("level") < F.col("cap") / F.col("w"), F.col("k"))
    water = F.coalesce(F.min_by("level", free).over(everyone), F.lit(0.0))
    return level.withColumn("water", water).select(
        "source", "source_size", F.when(F.col("cap") <= F.col("water") * F.col("w"), F.col("cap")).otherwise(F.col("water") * F.col("w")).alias("target")
    )


def _named(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _key(doc_id: str, mark: str, copy: str) -> Column:
    """A row's hash-random key."""
    return F.xxhash64(F.col(doc_id), F.col(mark), F.col(copy), F.lit("mix"))


def _ordered(docs: DataFrame, epochs: int, weights: int) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): every row with its key and what comes before it in its source, and each source's budget."""
    sizes = table(word_sizes(docs), "mix-sizes")
    targets = cut(source_targets(sizes, epochs, weights))
    full = F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0)).cast("int")
    sources = cut(targets.withColumn("full", full).withColumn("_source", _named(F.col("source"))).withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")))
    keyed = table(numbered_copies(sizes, ["doc_id", "source", "size", "mark"], "copy").withColumn("h", _key("doc_id", "mark", "copy")).withColumn("_source", _named(F.col("source"))), "mix-keys")
    return running_sum(keyed, ["_source"], F.col("size"), ["h", "doc_id", "mark", "copy"], keyed.count(), "before"), sources


def mix(docs: DataFrame, epochs: int = MOST_EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """(doc_id, source, size, mark, copy, h, source_size, target, copies, taken) for every row of docs.

    Documents of a source are put in the order of a hash of their id, text and, among equal rows, number. All are taken
    floor(target / source_size) times; of the remaining budget, whole documents are taken in that order while their middle
    lies within it, so a source misses its target by half a document at most. taken = copies * size. Reruns give the same
    rows, whatever the order of the input.

    Null texts have size 0; null sources are one source, the last; null ids are ids like others; repeated rows are taken
    apart; without any words every target is 0; an empty table gives no rows.
    """
    ranked, sources = _ordered(docs, epochs, weights)
    joined = ranked.join(small(sources.drop("source"), SOURCE_ROWS), "_source")
    more = (F.col("before") + F.col("size") / 2 <= F.col("budget")) & (F.col("full") < epochs) & (F.col("size") > 0)
    return joined.withColumn("copies", F.col("full") + more.cast("int")).select(
        "doc_id", "source", "size", "mark", "copy", "h", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, epochs: int = MOST_EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """docs with every row as often as mix() takes it; the columns stay as they are. See mix() for nulls and repeated rows.

    What is taken of a source is all that comes up to one key, so texts meet only that key and are not shuffled; rows that
    repeat id, source and text are numbered first, by their other columns. An empty table gives no rows.
    """
    taken = table(mix(docs, epochs, weights), "mix")
    place = F.struct("h", "doc_id", "mark", "copy")
    full = F.min("copies")
    ends = taken.where("size > 0").groupBy(_named(F.col("source")).alias("_source")).agg(
        full.alias("_full"), F.max(F.when(F.col("copies") > 0, F.struct(F.col("copies"), place.alias("place")))).alias("_most")
    )
    # the one with most copies and the last key; where all have as many, it is the last of all
    ends = cut(ends.select("_source", "_full", F.col("_most.copies").alias("_copies"), F.col("_most.place").alias("_end")))
    spare = cut(taken.where("size = 0 and copies > 0").groupBy(_named(F.col("source")).alias("_source")).agg(F.max("copies").alias("_empty")))
    twins = cut(taken.where("copy = 1").select(F.col("doc_id").alias("_i"), _named(F.col("source")).alias("_s"), F.col("mark").alias("_m")))
    own = {"_id": F.col("doc_id").cast("long"), "_source": _named(F.col("source").cast("string")), "_mark": F.xxhash64(F.col("text").cast("string"))}
    keyed = docs.withColumns(own)
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_source") == F.col("_s")) & (F.col("_mark") == F.col("_m"))
    if twins.isEmpty():
        keyed = keyed.withColumn("_copy", F.lit(0).cast("long"))
    else:
        held = small(twins, SOURCE_ROWS)
        rest = F.to_json(F.struct(*(c for c in docs.columns if c != "text"), F.lit(0)), {"ignoreNullFields": "false"})
        order = Window.partitionBy("_id", "_source", "_mark").orderBy("_row")
        many = keyed.join(held, same, "left_semi").withColumn("_row", rest).withColumn("_copy", F.row_number().over(order).cast("long") - 1).drop("_row")
        keyed = keyed.join(held, same, "left_anti").withColumn("_copy", F.lit(0).cast("long")).unionByName(many)
    at = F.struct(_key("_id", "_mark", "_copy").alias("h"), F.col("_id").alias("doc_id"), F.col("_mark").alias("mark"), F.col("_copy").alias("copy"))
    bare = ~F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    n = F.when(bare, F.coalesce("_empty", F.lit(0))).when(at <= F.col("_end"), F.col("_copies")).otherwise(F.coalesce("_full", F.lit(0)))
    joined = keyed.join(small(ends, SOURCE_ROWS), "_source", "left").join(small(spare, SOURCE_ROWS), "_source", "left").withColumn("_n", n)
    return joined.where("_n > 0").withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns)
