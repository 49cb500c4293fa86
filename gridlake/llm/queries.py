"""The registered queries of this package: each operator with its production parameters on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.llm import (
    collocations,
    credentials,
    decontaminate,
    divergence,
    jaccard,
    language,
    lines,
    mixing,
    pii,
    quality,
    sharding,
    substrings,
    urls,
)
from gridlake.llm.common import table
from gridlake.llm.sql import ORACLE_SQL


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.marked(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.counted(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.counted(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.marked(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_pii": op5_pii,
    "op6_language_id": op6_language_id,
    "op7_secrets": op7_secrets,
    "op8_url_filter": op8_url_filter,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sharding": op10_sharding,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_collocations": op13_collocations,
}
