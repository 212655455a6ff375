"""Training corpus from ``documents``: good, distinct, uncontaminated texts, mixed and sharded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept; the runner writes its result and reads it back as the next one's
documents. Repeated rows, nulls, empty tables and further columns are handled
as the operators' modules define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillpanel.llm import decontaminate, mixing, near_dups, quality, sharding
from tillpanel.llm.common import table, unused, written

SHARDS = 40


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.keep_first(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources interleave."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; slots follow the mix, whatever order the rows are read in."""
    position, = unused(docs, "mix_position")
    return sharding.shards(mixing.placed(docs, position=position), SHARDS, position=position)


STAGES = [("quality", good), ("near_dups", distinct), ("decontamination", uncontaminated), ("mixing", mixed), ("sharding", sharded)]

# models, sampling and edit distances are not SQL: tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
