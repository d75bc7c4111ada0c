"""The operators over the given tables, with the digest columns that are compared."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import (
    chat, counts, divergence, fingerprint, lm, mixing, neardup, pieces, quality, records, resampling, secrets,
    sharding,
)
from tidings.llm.oracles import ORACLES  # noqa: F401
from tidings.llm.textops import read_table
from tidings.session import new_path, stage


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(_documents(spark, sf_dir))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "records")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    records.write_records(_documents(spark, sf_dir), folder, tokenizer)
    rows = records.with_start(records.read_records(spark, folder, ids=False), folder)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    typed = turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    return chat.read_chats(stage(chat.format_chats(typed), "chats"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir)).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op7_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(_documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(_documents(spark, sf_dir))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_pieces": op2_pieces,
    "op3_records": op3_records,
    "op4_chats": op4_chats,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_scores": op7_scores,
    "op8_secrets": op8_secrets,
    "op9_shards": op9_shards,
    "op10_mix": op10_mix,
    "op11_token_counts": op11_token_counts,
    "op12_resampling": op12_resampling,
    "op13_divergence": op13_divergence,
}
