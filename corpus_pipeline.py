"""A corpus pipeline of the text operators: quality, language, copies, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from datamove.llm import stages
from datamove.session import scratch_path

STAGES = [
    ("quality", stages.keep_quality),
    ("language", stages.keep_language),
    ("copies", stages.keep_one_copy),
    ("benchmark", stages.keep_uncontaminated),
    ("tokens", stages.to_tokens),
]

# The language and quality models and the groups of near copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
