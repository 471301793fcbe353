"""How well scores rank labels: exact area under the ROC curve and average precision, by prefix sums over groups of equal scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 256


def ranking_metrics(rows: DataFrame, score: str = "ml_score", label: str = "label") -> DataFrame:
    """One row (auc, average_precision, positives, negatives) of rows with a score and a label 0 or 1; others are left out.

    Equal scores are one step of the curve. Their groups are cut into PARTS ranges at quantiles; a window adds up
    one range, and another the sums of the ranges, so no task sorts them all. Without positives or negatives the areas are null.
    """
    yes = F.col(label) == 1
    valid = rows.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isin(0, 1))
    groups = valid.groupBy(F.col(score).cast("double").alias("s")).agg(F.count_if(yes).alias("pos"), F.count_if(~yes).alias("neg"))
    edges = groups.agg(F.percentile_approx("s", [k / PARTS for k in range(1, PARTS)], 10 * PARTS)).first()[0] or []
    cuts = F.array(*(F.lit(float(e)) for e in sorted(set(edges)))).cast("array<double>")
    placed = groups.withColumn("part", F.size(F.filter(cuts, lambda e: e < F.col("s"))))
    sums = placed.groupBy("part").agg(F.sum("pos").alias("pos_part"), F.sum("neg").alias("neg_part"))
    below, everyone = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    sums = sums.select("part", zero(F.sum("pos_part").over(below)).alias("pos_below"), zero(F.sum("neg_part").over(below)).alias("neg_below"), F.sum("pos_part").over(everyone).alias("p"), F.sum("neg_part").over(everyone).alias("n"))
    inside = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(F.broadcast(sums), "part")  # PARTS rows at most
    low = lambda c: F.col(f"{c}_below") + zero(F.sum(c).over(inside))
    steps = joined.select("s", "pos", "neg", "p", "n", low("pos").alias("pos_low"), low("neg").alias("neg_low"))
    true, false = F.col("p") - F.col("pos_low"), F.col("n") - F.col("neg_low")  # at this score or above
    wide = lambda c: c.cast("decimal(19,0)")
    area = F.sum(wide(F.col("pos")) * wide(2 * F.col("neg_low") + F.col("neg"))).cast("double")
    precise = F.sum(F.when(F.col("pos") > 0, F.col("pos") * (true / (true + false))))
    total = steps.agg(area.alias("area"), precise.alias("precise"), F.max("p").alias("p"), F.max("n").alias("n"))
    both = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("area") / (2.0 * F.col("p") * F.col("n")))
    return total.select(both.alias("auc"), F.when(F.col("p") > 0, F.col("precise") / F.col("p")).alias("average_precision"), zero(F.col("p")).alias("positives"), zero(F.col("n")).alias("negatives"))
