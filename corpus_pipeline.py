"""A training corpus from the documents table: identify languages, drop near duplicates and leaks, mix sources, shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probeloom.llm import decontaminate, language, minhash, mixing, sharding
from probeloom.llm.common import read
from probeloom.scratch import delete_path, scratch_path, temporary_tables


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language for the most part, go."""
    return language.reject_unidentified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to its edit budget, go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: documents are left out or repeated."""
    return mixing.mix(docs)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot; rows that the mix repeats get slots of their own."""
    return sharding.shard(docs, [F.col("doc_id"), F.xxhash64("text")])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard_documents", shard_documents),
]

#: SQL can't express the language model or the edit search; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on the written result of the one before; what a stage leaves behind is deleted after it."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        target = scratch_path(spark, name)
        with temporary_tables(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(target)
        docs = spark.read.schema(kept.schema).parquet(target)
        if last:
            delete_path(spark, last)
        last = target
    return STAGES[-1][1](spark, docs, sf_dir)
