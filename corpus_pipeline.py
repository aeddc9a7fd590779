"""A training corpus from `documents`: language, near-duplicates, repeated passages, packing.

Each stage reads what its predecessor wrote, so a lost executor or a failed stage
costs that stage only. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innlake.llm import best_fit, cross_parse, near_dedup, suffix_dedup
from innlake.session import scratch_path

STAGES = [
    ("language_id", cross_parse.stage),
    ("near_dedup", near_dedup.stage),
    ("suffix_dedup", suffix_dedup.stage),
    ("packing", best_fit.stage),
]

# Language, MinHash and packing order can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed sequences of the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
