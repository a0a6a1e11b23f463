"""Table and metadata sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """Main/derived tables; parquet by default (CSV with a header on request)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """Small per-column tables (types, fill values, statistics: a few rows per
    column) as JSON Lines, one file. Tables that grow with the data, such as
    category dictionaries, go through :func:`write_table` instead: a
    ``coalesce(1)`` would also pull the stage that produces them into one
    task."""
    df.coalesce(1).write.mode("overwrite").json(path)
