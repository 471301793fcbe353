"""The whole risk pipeline as one lazy plan: rules, patterns, features, score, decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SPARSE, Config
from tidemark.operators.decisions import decide, set_aside
from tidemark.operators.features import rolling_features
from tidemark.operators.patterns import attach, detect
from tidemark.operators.rules import apply_rules, latest_rules, seed_rules
from tidemark.operators.scoring import Scorer, no_model
from tidemark.sources.transactions import from_events


def enrich(tx: DataFrame, rules: DataFrame, config: Config) -> DataFrame:
    """tx with rule_alerts and cep_alerts."""
    return attach(apply_rules(tx, latest_rules(rules)), detect(tx, config))


def assess(tx: DataFrame, rules: DataFrame, config: Config, scorer: Scorer = no_model) -> DataFrame:
    """A decision for every transaction. Features are computed only where the scorer reads them."""
    tx = tx if "decided_ms" in tx.columns else tx.withColumn("decided_ms", F.unix_millis(F.current_timestamp()))
    return resolve(enrich(tx, rules, config), config, scorer)


def resolve(marked: DataFrame, config: Config, scorer: Scorer = no_model) -> DataFrame:
    """A decision for every transaction with its rule_alerts and cep_alerts."""
    rows = marked if scorer is no_model else rolling_features(marked, set_aside(marked.columns))
    return decide(scorer(rows), config)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def demo_rules(spark: SparkSession) -> DataFrame:
    """The seed rules at amounts that fit the events table."""
    return seed_rules(spark, high=100.0, off_hours=50.0)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(events(spark, sf_dir), demo_rules(spark), SPARSE)
