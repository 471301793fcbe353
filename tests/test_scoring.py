from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.operators.scoring import INPUTS, ForestScorer, TreeScorer, split_by_class, train_forest
from tidemark.plans import risk


def labelled(spark, rows):
    """INPUTS and label: every 20th row is labelled, and lies higher in each input."""
    base = spark.range(rows).withColumn("label", (F.col("id") % 20 == 0).cast("int"))
    return base.select(*((F.exp(F.randn(k) + 2 * F.col("label")) * 10).cast("float").alias(n) for k, n in enumerate(INPUTS)), "label")


def test_forest(spark, data, tmp_path):
    model, metrics = train_forest(labelled(spark, 5000), trees=20, depth=6)
    assert metrics["areaUnderROC"] > 0.85 and metrics["areaUnderPR"] > 0.70 and metrics["f1"] > 0.78
    ForestScorer(model).save(f"{tmp_path}/m")
    scored = risk.assess(risk.events(spark, data), risk.demo_rules(spark), Config(), ForestScorer.load(f"{tmp_path}/m"))
    got = scored.agg(F.count("*").alias("n"), F.max("ml_score").alias("hi"), F.min("ml_score").alias("lo")).first()
    assert got.n == 1000 and 0 <= got.lo <= got.hi <= 1
    assert scored.where("rule_triggered like '%RULE_002%' and ml_score > 0").count() == 0


def test_split_by_class(spark):
    rows = spark.range(2000).select(F.lit(1.0).alias("x"), (F.col("id") % 10 == 0).cast("int").alias("label"))  # equal but for the label
    got = {(r.label, r.held): r["count"] for r in split_by_class(rows).groupBy("label", "held").count().collect()}
    assert got == {(0, True): 360, (0, False): 1440, (1, True): 40, (1, False): 160}


def test_scores_decide(spark, data):
    """High scores block, raised ones alert, above rules but below patterns."""
    always = lambda p: risk.assess(risk.events(spark, data), risk.demo_rules(spark), Config(), TreeScorer([p]))
    for p, decision in ((0.9, "BLOCK"), (0.6, "ALERT"), (0.5, None)):
        rows = always(p).where("ml_score > 0 and decision_source <> 'CEP_ENGINE'").select("decision", "decision_source").distinct().collect()
        assert rows and (decision is None or {tuple(r) for r in rows} == {(decision, "ML_SCORING")})
        assert decision or "ML_SCORING" not in {r.decision_source for r in rows}


def test_config():
    assert Config.from_env({"TXRISK_MICRO_COUNT": "7", "TXRISK_TRAVEL_KM": "x", "TXRISK_TRAVEL_MS": " 5 "}) == Config(micro_count=7, travel_ms=5)
