"""The corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annotspark.llm import stages
from annotspark.llm.common import read, written

STAGES = [
    ("quality_rules", stages.quality),
    ("ngram_jaccard", stages.near_duplicates),
    ("suffix_dedup", stages.repeated_passages),
    ("secret_scan", stages.secrets),
    ("best_fit_packing", stages.pack),
]

#: Near-duplicate groups, suffix order and packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
