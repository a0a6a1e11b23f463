"""Parquet tables by name from a folder (the driver's ``sf*`` folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input that arrives in fewer partitions than there are
    task slots (one row group, one gzip file) before CPU-heavy work. A large
    input on a cluster has far more partitions than slots and is returned
    unchanged. Apply it to a raw scan: asking a plan with shuffles for its
    partition count would run those shuffles ahead of the query."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
