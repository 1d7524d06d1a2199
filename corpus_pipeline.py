"""A corpus made ready for training: five stages, each an operator of ``reviewloom.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewloom import session
from reviewloom.llm import decontamination, mixing, repetition, sharding, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return repetition.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_documents(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target asks for, in training order."""
    return mixing.training_set(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and its place there."""
    return sharding.sharded_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Rolling hashes, fingerprints and tiles are not SQL; the stages are tested against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = session.store(stage(spark, docs, sf_dir))
    return docs
