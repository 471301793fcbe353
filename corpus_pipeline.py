"""A training-corpus pipeline: toxic documents out, near duplicates out, benchmark leaks out, sources mixed, rows sharded.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows its predecessor kept; its result is
written as Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import clean_documents
from tidemark.llm.minhash import without_near_duplicates
from tidemark.llm.mixing import mixed
from tidemark.llm.scratch import scope, shared_dir
from tidemark.llm.sharding import shard
from tidemark.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that a grammar learned from `labels` scores below 0.5. Null and empty texts are judged like others, by the bias alone;
    repeated rows each by their text; without labels the prior weights judge; an empty table stays empty."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest doc_id; rows without an id or words all stay, and rows of one
    id with different texts are documents of their own."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without a window of any `benchmark` item. Null and empty texts stay; without items all rows do."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs as often as their sources' targets take them; a null source is a source, the last; texts without words are taken as
    often as all of their source are."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot, as shard() returns them; copies that mixing made are copies like others."""
    return shard(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: The trained grammar of the first stage is not expressible in SQL; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again."""
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scope(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{base}/{name}")
    return docs
