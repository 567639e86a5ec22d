"""Curation of ``documents`` in five stages: rules, exact and near duplicates, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import bpe, exact, mixing, near, rules
from gleaner.llm.queries import tokenizer_path
from gleaner.session import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a risk-controlled cutoff go."""
    return rules.rule_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact.exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays."""
    return near.near_dedup(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, one row per mixed document."""
    return bpe.encode_rows(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact duplicates", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("mixed sources", mixed_sources),
    ("tokens", tokens),
]

#: SQL has no BPE; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
