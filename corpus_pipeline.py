"""A training-corpus pipeline over ``documents``: toxicity, near-duplicates,
secrets, packing. Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its
result is written as Parquet and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import stages
from tablewright.llm.shared import read, written

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("minhash_near_dedup", stages.drop_near_duplicates),
    ("secret_scan", stages.redact_secrets),
    ("best_fit_packing", stages.pack),
]

#: A trained network and a packing search are not expressible in SQL; the
#: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
