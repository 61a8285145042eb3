"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabeval.llm import stages
from tabeval.llm.frames import written

STAGES = [
    ("language_id", stages.known_language),
    ("near_duplicates", stages.one_of_near_duplicates),
    ("decontamination", stages.without_benchmark),
    ("pii_surrogates", stages.with_surrogates),
    ("sentencepiece", stages.as_pieces),
]
ORACLE_SQL = None  # a fitted classifier, keyed hashes and a tokenizer: tested against plain versions instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
