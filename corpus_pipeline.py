"""Corpus preparation in five stages, each on all rows that the stage before kept.

language (rank-order profiles; texts without a language go), near duplicates (SimHash with
pigeonring chains; the row with the smallest id of each component stays), decontamination (texts
that contain a benchmark item go), mixing (each source's rows as often as its target says) and
sharding (Hilbert order, 40 shards of equal row counts). A stage's result is written as Parquet
below the shared working folder and read again as the next stage's documents.

Rows. A NULL or empty text has no language and goes in the first stage, as does a text without a letter; no
later stage meets one. A NULL id sorts last wherever ids decide (which copy stays, order within a
shard); NULL in any other column is a value of its own (a source, a language). Of repeated rows and of ties
one row stays, and mixing may then repeat it. Very long texts are read whole in every stage. Extra columns pass
through, whatever their names; ``size, text_crc32, shard, slot`` of the last stage replace columns of these
names. An empty table gives an empty table with the last stage's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiertrip.llm import decontaminate, hilbert, langid, mixing, simhash
from tiertrip.llm.common import stash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, tau=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hilbert.shard(docs, shards=40)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("sharding", sharding)]

#: The rank-order profiles and the 64-bit fingerprints have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
