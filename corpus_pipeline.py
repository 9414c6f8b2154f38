"""The corpus pipeline: documents through five stages, each written and read again.

quality classifier (rejected documents go), n-gram Jaccard join (one document of each group of
near copies stays), benchmark decontamination (documents that hold an item go), mixing to target
weights (documents come as often, and as much of them, as the mix takes), sharding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transferlake.llm import decontamination, jaccard, mixing, quality, sharding
from transferlake.llm.common import read, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, text=True)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The classifier, the MinHash search and the drawn mix are beyond SQL: tests/llm compares the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
