"""Balanced label propagation: equal texts move towards one shard under capacity quotas; counts differ by one at most.

DataFrame operations only. The documents that share a text are linked; within a link group they are interchangeable,
so a round works on cells, the number of documents of one group in one shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.prefix import numbered_copies, running_sum
from tidemark.llm.scratch import cut, scope, table

SHARDS = 40


def _kept_edges(cells: DataFrame) -> int:
    """Twice the links within shards, and the documents: the sum of the cells' squares."""
    return int(cells.agg(F.sum(F.col("n").cast("decimal(38,0)") * F.col("n"))).first()[0] or 0)


def _propagate(cells: DataFrame, quota: DataFrame) -> DataFrame:
    """Cells (grp, label, n) after rounds of moves towards each group's fullest shards, within quotas, until a round keeps no more
    links inside shards than the one before. Links are whole numbers, so the rounds end."""
    best = _kept_edges(cells)
    while True:
        moved = _round(cells, quota)
        kept = _kept_edges(moved) if moved is not None else best
        if kept <= best:
            return cells
        cells, best = moved, kept


def _round(cells: DataFrame, quota: DataFrame) -> DataFrame | None:
    """Cells after one round of moves; None if no shard grants one."""
    load = cells.groupBy("label").agg(F.sum("n").alias("load"))
    room = cut(quota.join(load, "label", "left").select("label", "quota", (F.col("quota") - F.coalesce("load", F.lit(0))).alias("free")))
    of_group = Window.partitionBy("grp")
    fullest = of_group.orderBy(F.desc("open"), F.desc("n"), F.xxhash64("grp", "label"), "label")
    seen = (
        cells.join(F.broadcast(room), "label")  # one row a shard
        .withColumn("total", F.sum("n").over(of_group))
        .withColumn("open", (F.col("free") > 0) | (F.col("n") >= F.col("quota")))
        .withColumn("place", F.row_number().over(fullest) - 1)
        .withColumn("wanted", F.ceil(F.col("total") / F.greatest("quota", F.lit(1))))
    )
    aims = seen.where("place < wanted and open").select("grp", F.col("place").alias("aim"), F.col("label").alias("to"), F.col("free").alias("free_to"))
    asks = (
        seen.where("place >= wanted or not open")
        .withColumn("aim", F.pmod(F.col("place"), F.col("wanted")))
        .join(aims, ["grp", "aim"])
        .where("free_to > 0")
        .select("grp", "label", "n", "to", "free_to", F.xxhash64("grp", "label").alias("h"))
    )
    asks = cut(asks)
    granted = running_sum(asks, ["to"], F.col("n"), ["h", "grp", "label"], asks.count(), "before").select(
        "grp", "label", "to", F.least("n", F.greatest(F.lit(0), F.col("free_to") - F.col("before"))).alias("go")
    )
    granted = cut(granted.where("go > 0"))
    if granted.isEmpty():
        return None
    out = granted.select("grp", "label", (-F.col("go")).alias("n"))
    into = granted.select("grp", F.col("to").alias("label"), F.col("go").alias("n"))
    return cut(cells.unionByName(out).unionByName(into).groupBy("grp", "label").agg(F.sum("n").alias("n")).where("n > 0"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of docs; law `rows`.

    Shard counts differ by one at most (the first count % shards have one more). Copies of a text stay together as far
    as quotas allow: a group is split only if it is larger than a shard or the shards near it are full. Documents
    without a copy have no edge to cut and fill what is left. slot counts 0, 1, ... in each shard. Reruns give the same rows,
    whatever the order of the input; cut_edges() tells what links are cut.

    Null and empty texts: size 16, crc 0; null texts link with nothing, empty texts are copies of each other. Null ids and
    repeated rows are rows like others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    with scope(spark):
        whole, rows = _placed(docs, shards)
    return running_sum(whole, ["shard"], F.lit(1), ["h", "doc_id", "copy"], rows, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("grp").alias("text_md5")
    )


def cut_edges(sharded: DataFrame) -> DataFrame:
    """(links, cut) of what shard() returned: pairs of documents of one text, and those of them in different shards."""
    pairs = lambda n: F.col(n).cast("decimal(38,0)") * (F.col(n) - 1) / 2
    cells = sharded.where("text_md5 is not null").groupBy("text_md5", "shard").agg(F.count("*").alias("n"))
    groups = cells.groupBy("text_md5").agg(F.sum("n").alias("all"), F.sum(pairs("n")).alias("inside"))
    total = F.coalesce(F.sum(pairs("all")), F.lit(0)).cast("decimal(38,0)")
    return groups.agg(total.alias("links"), (total - F.coalesce(F.sum("inside"), F.lit(0))).cast("decimal(38,0)").alias("cut"))


def _placed(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, grp, copy, h, shard) of every row, and their number."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.col("text").cast("string").cast("binary")).alias("grp"),
    )
    names = ["doc_id", "size", "text_crc32", "grp", "copy", "h"]
    items = table(numbered_copies(bare, names[:4], "copy").withColumn("h", F.xxhash64("doc_id", "grp", "size", "copy")), "shard-items")
    rows = items.count()
    quota = docs.sparkSession.range(shards).select(
        F.col("id").cast("int").alias("label"), (F.lit(rows // shards) + (F.col("id") < rows % shards).cast("long")).alias("quota")
    )
    many = cut(items.where("grp is not null").groupBy("grp").agg(F.count("*").alias("c")).where("c > 1").select("grp"))
    linked = table(items.join(many, "grp"), "shard-linked")
    cells = cut(linked.groupBy("grp", F.pmod("h", F.lit(shards)).cast("int").alias("label")).agg(F.count("*").alias("n")))
    cells = _propagate(cells, quota)
    # quotas are exact: what a shard has beyond its quota joins the documents without copies
    held = running_sum(cells.withColumn("h", F.xxhash64("grp", "label")), ["label"], F.col("n"), ["h", "grp"], cells.count(), "before").join(F.broadcast(quota), "label")
    stay = F.least("n", F.greatest(F.lit(0), F.col("quota") - F.col("before")))
    held = cut(held.select("grp", "label", "n", stay.alias("stay")))
    parts = held.select("grp", "label", F.col("stay").alias("n")).unionByName(held.select("grp", F.lit(-1).alias("label"), (F.col("n") - F.col("stay")).alias("n"))).where("n > 0")
    upto = Window.partitionBy("grp").orderBy("label", "n").rowsBetween(Window.unboundedPreceding, 0)
    spans = cut(parts.withColumn("hi", F.sum("n").over(upto)).select("grp", "label", "hi", (F.col("hi") - F.col("n")).alias("lo")))
    ranked = cut(running_sum(linked, ["grp"], F.lit(1), ["h", "doc_id", "copy"], linked.count(), "rank"))
    a, b = ranked.alias("a"), spans.alias("b")
    settled = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.rank") >= F.col("b.lo")) & (F.col("a.rank") < F.col("b.hi"))).select(
        *(f"a.{n}" for n in names), "b.label"
    )
    settled = cut(settled)
    own = items.join(many, "grp", "left_anti").select(*names)
    pool = cut(settled.where("label < 0").select(*names).unionByName(own).withColumn("_all", F.lit(0)))
    used = {r.label: r["count"] for r in settled.where("label >= 0").groupBy("label").count().collect()}  # one row a shard
    ends, end = [], 0
    for s in range(shards):
        end += rows // shards + (s < rows % shards) - used.get(s, 0)
        ends.append(end)
    place = F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in ends)), lambda x: x <= F.col("rank"))).cast("int")
    filled = running_sum(pool, ["_all"], F.lit(1), ["h", "doc_id", "copy"], rows, "rank").select(*names, place.alias("label"))
    return table(settled.where("label >= 0").unionByName(filled).withColumnRenamed("label", "shard"), "shard-placed", outer=True), rows
