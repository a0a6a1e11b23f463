"""Positions in a global order, computed without a single-task window.

``row_number() over (order by k)`` (no partition) moves every row into one
task. Here the rows are range-partitioned and sorted instead, tagged with
(partition, index) and written to the shared checkpoint folder (so the tags
stay fixed if a task is re-run), and a position is ``rows in earlier
partitions + index within partition``.
Only a table with one row per (partition, group) ever goes to one task.

Used for row ids (no group) and dictionary codes (group = column name).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | index


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pin_sorted(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``, tag every row with its sorted
    partition and index (``_pid``, ``_local``) and write the result as a table
    in the shared checkpoint folder. The tags travel with the rows, so they
    do not depend on how the table is read back, and a retried task cannot
    change them."""
    n = partitions or _partitions(df)
    mid = F.monotonically_increasing_id()
    ordered = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
               .withColumn("_mid", mid))
    pinned = materialize(ordered, "sorted")
    return (pinned.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
            .withColumn("_local", F.col("_mid") - F.shiftleft("_pid", _LOCAL_BITS))
            .drop("_mid"))


def _chunk_offsets(tagged: DataFrame, group_cols: Sequence[str], weight: Column) -> DataFrame:
    """One row per (partition, group): its weight and the weight of the same
    group in earlier partitions. Size <= partitions + groups."""
    chunks = tagged.groupBy("_pid", *group_cols).agg(
        F.sum(weight).alias("_w"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    return chunks.withColumn("_before", F.coalesce(F.sum("_w").over(w), F.lit(0)))


def positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
              out: str = "position") -> DataFrame:
    """Add ``out``: the 0-based position of each row within its group, in
    ``order_cols`` order. ``group_cols`` must be low-cardinality (such as a
    column-name column); ``order_cols`` should be unique within a group so
    that positions are deterministic."""
    keys = [*group_cols, *order_cols]
    tagged = pin_sorted(df, keys)
    chunks = _chunk_offsets(tagged, group_cols, F.lit(1)).select("_pid", *group_cols, "_before", "_first")
    # chunks has at most partitions + groups rows (a proven bound): computed
    # once, then broadcast as a local table so later uses of the result do
    # not recompute it.
    small = df.sparkSession.createDataFrame(chunks.collect(), chunks.schema)
    joined = tagged.join(F.broadcast(small), ["_pid", *group_cols])
    return (joined.withColumn(out, (F.col("_before") + F.col("_local") - F.col("_first")).cast("long"))
            .drop("_pid", "_local", "_before", "_first"))


def assign_row_id(df: DataFrame, order_cols: Sequence[str], out: str = "row_id") -> DataFrame:
    """Dense 0-based row id following ``order_cols`` (a file-position
    stand-in). Computed once; persist the result if it is reused."""
    return positions(df, order_cols, (), out)
