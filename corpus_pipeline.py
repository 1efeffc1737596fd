"""A corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input.

Each stage takes nulls in any column, empty and very long texts, repeated rows, extra columns whatever their names, and
an empty table (which stays empty); all but the last return the columns they got.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontamination, mixing, sharding, simhash, toxicity
from gridloom.llm.common import intermediates, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; learned from the labels of those that are there. A null text has no findings."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id. Texts without words are one group."""
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark passages go. A null text has no words and stays."""
    return decontamination.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice. Texts without words cost nothing and are taken."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; every row, repeated ones too, has a slot of its own."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Compression distances, XXH64 and CRC-32 aren't to be had in SQL; tests/llm tests the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/gridloom-pipeline-{name}-{uuid.uuid4().hex}"
        with intermediates(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
