"""The training-data pipeline over ``documents``: each stage's result is written
as Parquet and read again as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fadeclust.llm import stages
from fadeclust.llm.work import written

STAGES = [
    ("language_id", stages.language_id),
    ("near_copies", stages.near_copies),
    ("suffix_dedup", stages.suffix_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
