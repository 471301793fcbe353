"""Scoring: the feature vector, forests trained here or given as data, and scorers that a pipeline can take."""

from __future__ import annotations

from typing import Protocol

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import is_foreign, local_hour, round_half_up
from tidemark.operators.decisions import set_aside
from tidemark.operators.ranking import ranking_metrics

INPUTS = ["amount", "hour_of_day", "is_foreign", "tx_frequency_1h", "distance_km"]


class Scorer(Protocol):
    def __call__(self, rows: DataFrame) -> DataFrame: ...


def no_model(rows: DataFrame) -> DataFrame:
    """Score 0 everywhere, as when no model is there."""
    return rows.withColumn("ml_score", F.lit(0.0))


def inputs(rows: DataFrame) -> DataFrame:
    """rows with the model's inputs as 32-bit floats in the column `inputs`."""
    values = [F.col("amount"), local_hour(F.col("ts_ms")), is_foreign(F.col("latitude"), F.col("longitude")), F.coalesce("tx_count_1h", F.lit(1)), F.coalesce("distance_km", F.lit(0.0))]
    return rows.withColumn("inputs", F.struct(*(v.cast("float").alias(n) for v, n in zip(values, INPUTS))))


def split_by_class(rows: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """rows with `held`, true for `share` of each label's rows (to a ten-thousandth of the label's), equal rows not together."""
    drawn = rows.withColumn("_u", F.rand(seed)).persist()  # drawn once: both parts come from the same numbers
    edges = drawn.groupBy("label").agg(F.percentile_approx("_u", F.lit(share), F.lit(10_000)).alias("_edge"))
    return drawn.join(F.broadcast(edges), "label").withColumn("held", F.col("_u") <= F.col("_edge")).drop("_u", "_edge")  # one row a label


def train_forest(rows: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> tuple[PipelineModel, dict[str, float]]:
    """A forest with class weights, fitted on four fifths of each class of rows (INPUTS, label), and its metrics on the rest."""
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(counts.values())
    weight = F.coalesce(*(F.when(F.col("label") == k, total / (len(counts) * n)) for k, n in counts.items()))
    split = split_by_class(rows.withColumn("weight", weight), seed=seed)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed)
    model = Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="x"), forest]).fit(split.where("not held"))
    tested = model.transform(split.where("held")).persist()
    ranked = ranking_metrics(tested.withColumn("p", F.get(vector_to_array("probability"), 1)), "p").first()
    metrics = {"areaUnderROC": ranked.auc, "areaUnderPR": ranked.average_precision}
    said, true = F.col("prediction") == 1, F.col("label") == 1
    hits = tested.agg(F.count_if(said & true).alias("tp"), F.count_if(said).alias("p"), F.count_if(true).alias("n")).first()
    precision, recall = hits.tp / max(hits.p, 1), hits.tp / max(hits.n, 1)
    return model, metrics | {"precision": precision, "recall": recall, "f1": 2 * precision * recall / max(precision + recall, 1e-12)}


# a tree is a probability, or (input, limit, tree up to the limit, tree above it)
Tree = float | tuple
#: a forest for data without a trained model; its limits fit the `events` table
SMALL_FOREST: list[Tree] = [
    ("amount", 100.0, ("hour_of_day", 5.0, 0.55, 0.1), ("is_foreign", 0.0, 0.4, 0.9)),
    ("tx_frequency_1h", 0.0, ("distance_km", 2000.0, 0.05, 0.85), ("amount", 60.0, 0.5, 0.95)),
    ("distance_km", 500.0, ("amount", 150.0, 0.1, 0.7), ("hour_of_day", 6.0, 0.92, 0.65)),
]


class TreeScorer:
    """The mean of trees given as data, to six decimals, as one expression; 0 on rows that are set aside."""

    def __init__(self, forest: list[Tree] = SMALL_FOREST):
        self.forest = forest

    def _value(self, tree: Tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        name, limit, low, high = tree
        return F.when(F.col(f"inputs.{name}") <= limit, self._value(low)).otherwise(self._value(high))

    def __call__(self, rows: DataFrame) -> DataFrame:
        mean = sum((self._value(t) for t in self.forest), F.lit(0.0)) / len(self.forest)
        return inputs(rows).withColumn("ml_score", F.when(set_aside(rows.columns), 0.0).otherwise(round_half_up(mean, 6))).drop("inputs")


class ForestScorer:
    """Probability of fraud to six decimals; 0 on rows that are set aside."""

    def __init__(self, model: PipelineModel):
        self.model = model

    @classmethod
    def load(cls, path: str) -> ForestScorer:
        return cls(PipelineModel.load(path))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def __call__(self, rows: DataFrame) -> DataFrame:
        kept = rows.columns
        spread = inputs(rows).select(F.struct(*kept).alias("row"), "inputs.*")
        made = self.model.transform(spread).withColumn("p", round_half_up(F.get(vector_to_array("probability"), 1), 6))
        return made.select("row.*", "p").withColumn("ml_score", F.when(set_aside(kept), 0.0).otherwise(F.col("p"))).drop("p")
