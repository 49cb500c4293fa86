"""A training corpus from documents: quality rules, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written to the shared folder as Parquet and
reread as the next one's ``docs``. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlake.llm import decontaminate, jaccard, mixing, quality, sharding
from gridlake.llm.common import cleared, table
from gridlake.session import discard, scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every class of similar documents."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# The near duplicates' components and the shuffle's hashes are not expressible: tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the stages write on the way, and each stage's output but the last, is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        with cleared(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
