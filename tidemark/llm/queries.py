"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import conversation_digests, format_conversations
from tidemark.llm.decontaminate import contamination
from tidemark.llm import bpe, licenses, oracle
from tidemark.llm.divergence import source_divergence
from tidemark.llm.importance import resample
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mix
from tidemark.llm.neighbours import search
from tidemark.llm.sharding import shard
from tidemark.llm.substrings import remove_repeated_spans
from tidemark.llm.tokens import token_round_trip
from tidemark.llm.toxicity import toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licences(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", F.size("known").cast("long").alias("n_known"), F.size("matches").cast("long").alias("n_matches"), F.array_join("licences", ",").alias("licences")
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_read(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeated_spans(_read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_read(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(_read(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    names = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    return conversation_digests(format_conversations(stored.unionByName(probe)))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(bpe.encode_texts(_read(spark, sf_dir, "documents")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_sharding": op3_sharding,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_mixing": op9_mixing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op10_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(17 + length(role) + length(text) + 2 * (length(role) + length(text)) - length(replace(role, '[', '')) - length(replace(text, '[', ''))
                       - length(replace(role, '<', '')) - length(replace(text, '<', ''))) AS formatted_chars
            FROM turns GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM whole
    """,
    "op11_importance_resampling": oracle.IMPORTANCE,
    "op13_source_divergence": oracle.DIVERGENCE,
}
