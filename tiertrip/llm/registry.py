"""Queries of the text operators over the test tables, and their DuckDB text where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tiertrip.session import run_path

from . import (decontaminate, hard_negatives, hilbert, langid, mixing, pii, quality_mil, quality_rules, simhash, suffix_dedup,
               token_files, toxicity, whitening)
from .common import id_remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, tau=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.withColumn("spans", pii.as_text("found")).drop("found")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    network = quality_mil.fit(docs, labels, train=id_remainder(F.col("doc_id"), 3) != 1)
    out = docs.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                      quality_mil.score(F.col("text"), network).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_rank_order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    profiles = langid.fit(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), profiles).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op7_deep_shallow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, train=id_remainder(F.col("doc_id"), 4) != 2)
    out = docs.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                      toxicity.score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents")).drop("copies")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = run_path(spark, "llm", f"token-files-{uuid.uuid4().hex}")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = token_files.read(spark, path)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)
    each = found.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
                       "whitened", F.get("explained", F.col("place")).alias("explained"), "identity_error")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table.withColumn("label", moved), is_anchor=F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_weak_pii, op2_hilbert_shards, op3_rule_votes, op4_attention_mil, op5_simhash_pigeonring,
    op6_rank_order_profiles, op7_deep_shallow_dedup, op8_minhash_containment, op9_noisy_channel_toxicity,
    op10_source_mix, op11_token_files, op12_whitening,
    op13_hard_negatives)}
ORACLE: dict[str, str] = {"op2_hilbert_shards": hilbert.oracle(), "op7_deep_shallow_dedup": suffix_dedup.oracle(), "op8_minhash_containment": decontaminate.oracle(),
                          "op10_source_mix": mixing.oracle(), "op13_hard_negatives": hard_negatives.oracle()}
