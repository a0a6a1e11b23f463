"""Exploded list side tables ``(row_id, value)``: written as JSON Lines or
parquet, read back with an explicit schema; a missing table reads as empty."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SIDE_SCHEMA = "row_id long, value string"


def write_side_table(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.select("row_id", "value").write.mode("overwrite").format(fmt).save(path)


def read_side_table(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_or_empty(spark, path, SIDE_SCHEMA, fmt)


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)
