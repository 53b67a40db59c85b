"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps; its result is written as Parquet and read
again as the next one's input. The last also returns each row's size, text_crc32, shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taskspire.llm import decontamination, language_id, mixing, near_dedup, sharding
from taskspire.llm.common import materialize, table

SHARDS = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_of_each(docs, 5, 80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"), most_rate=1.0)


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_to_weights),
    ("sharding", deal_into_shards),
]
#: Language profiles, the forest and the fit aren't SQL; the tests hold each operator, and the stages that filter, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
