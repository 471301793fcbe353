"""Connected components by alternating large-star and small-star, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import cut, scope, table


def _linked(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return _linked(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _linked(near.unionByName(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (u, v): the smallest node reachable.

    Self-links give a node of its own component. Nulls in u or v are no link. Each round is
    a table in the shared folder; the rounds end when large-star and small-star leave
    the edges as they were, compared by count and sum of hashes, not by collecting them.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u is not null and v is not null")
    alone = edges.where("u = v").select("u").distinct()
    with scope(edges.sparkSession):
        now, seen = cut(_linked(edges)), None
        while True:
            mark = now.agg(F.count("*"), F.sum(F.xxhash64(F.greatest("u", "v"), F.least("u", "v")).cast("decimal(38,0)"))).first()
            if mark == seen:
                break
            seen, now = mark, cut(_small_star(_large_star(now)))
        stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
        single = alone.select(F.col("u").alias("node"), F.col("u").alias("component"))
        return table(stars.unionByName(roots).unionByName(single).groupBy("node").agg(F.min("component").alias("component")), "components", outer=True)
