"""The corpus pipeline: five stages from raw documents to sharded ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each one's rows as Parquet under the shared checkpoint folder and reads them
again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctscreen.llm import op2_mixing, op5_lshforest, op6_sharding, op8_decontaminate, op9_langid
from acctscreen.llm.common import Scratch, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return op9_langid.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return op5_lshforest.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op8_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return op2_mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, text and all, with its shard and its place there."""
    return op6_sharding.shard_documents(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Trigram models, signatures and latent spaces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return docs
