"""List-valued columns: explode to side tables, item and pair statistics.

Items are parsed per cell with built-in expressions
(:func:`tablewright.functions.lists.parse_items`). Statistics count *rows*:
an item that appears twice in one cell counts once for that row, which
``array_distinct`` settles inside the row, before any shuffle.

Pair co-occurrence is restricted to a given item set (the top items): a cell
with m items would otherwise emit m·(m-1)/2 pairs, and only pairs among the
top items are ever reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.functions.lists import parse_items
from tablewright.functions.names import col


def items_column(df: DataFrame, column: str, hint: str | None) -> F.Column:
    dtype = df.schema[column].dataType
    return parse_items(col(column), dtype, hint)


def explode_list(df: DataFrame, column: str, hint: str | None, id_col: str) -> DataFrame:
    """Side table ``(row_id, value)``: one row per item, duplicates kept,
    rows without items produce nothing."""
    return df.select(col(id_col).alias("row_id"), F.explode(items_column(df, column, hint)).alias("value"))


def row_item_sets(df: DataFrame, column: str, hint: str | None) -> DataFrame:
    """``items``: the distinct items of each row (rows without items dropped)."""
    items = F.array_distinct(items_column(df, column, hint))
    return df.select(items.alias("items")).where(F.size("items") > 0)


def row_item_sets_from_side(side: DataFrame) -> DataFrame:
    """Same as :func:`row_item_sets` but from an exploded side table, where
    a row's items may sit in different partitions: deduplicate (row, item)."""
    return side.select("row_id", "value").distinct()


def item_counts(sets: DataFrame) -> DataFrame:
    """``(value, count)``: number of rows containing each item."""
    if "items" in sets.columns:
        long = sets.select(F.explode("items").alias("value"))
    else:
        long = sets.select("value")
    return long.groupBy("value").agg(F.count("*").alias("count"))


def top_items(counts: DataFrame, n: int = C.TOP_N_COOCCURRENCE) -> list[str]:
    """The ``n`` most frequent items (count desc, item asc): a bounded top-k."""
    return [r["value"] for r in counts.orderBy(F.desc("count"), F.asc("value")).limit(n).collect()]


def pair_counts(sets: DataFrame, among: Sequence[str]) -> DataFrame:
    """``(item_a, item_b, count)`` with ``item_a < item_b``: rows in which
    both items occur, for items in ``among`` (a bounded set)."""
    spark = sets.sparkSession
    if len(among) < 2:
        return spark.createDataFrame([], "item_a string, item_b string, count long")
    keep = F.array(*[F.lit(v) for v in among])
    if "items" not in sets.columns:
        sets = sets.groupBy("row_id").agg(F.collect_set(
            F.when(F.array_contains(keep, F.col("value")), F.col("value"))).alias("items"))
    chosen = F.array_sort(F.array_distinct(F.filter("items", lambda v: F.array_contains(keep, v))))
    t = sets.select(chosen.alias("s")).where(F.size("s") >= 2)
    idx = F.sequence(F.lit(0), F.size("s") - 1)
    pairs = F.flatten(F.transform(idx, lambda i: F.transform(
        F.slice("s", i + 2, F.lit(len(among))), lambda b: F.struct(F.element_at("s", i + 1).alias("item_a"),
                                                                   b.alias("item_b")))))
    return (t.select(F.inline(pairs)).groupBy("item_a", "item_b")
            .agg(F.count("*").alias("count")))


def cooccurrence_matrix(counts: DataFrame, pairs: DataFrame, top: Sequence[str]) -> DataFrame:
    """Lower triangle of the top-item matrix: ``(i, j, row_item, col_item,
    count)`` for ``j <= i``; the diagonal holds item counts, other cells the
    pair count (0 when the pair never occurs)."""
    spark = counts.sparkSession
    cells = [(i, j, top[i], top[j]) for i in range(len(top)) for j in range(i + 1)]
    if not cells:
        return spark.createDataFrame([], "i int, j int, row_item string, col_item string, count long")
    grid = F.broadcast(spark.createDataFrame(cells, "i int, j int, row_item string, col_item string"))
    lo = F.least("row_item", "col_item")
    hi = F.greatest("row_item", "col_item")
    g = grid.withColumn("item_a", lo).withColumn("item_b", hi)
    diag = counts.where(F.col("value").isin(list(top))).select(
        F.col("value").alias("item_a"), F.col("value").alias("item_b"), F.col("count").alias("_d"))
    joined = (g.join(F.broadcast(pairs.withColumnRenamed("count", "_p")), ["item_a", "item_b"], "left")
              .join(F.broadcast(diag), ["item_a", "item_b"], "left"))
    value = F.when(F.col("i") == F.col("j"), F.col("_d")).otherwise(F.coalesce(F.col("_p"), F.lit(0)))
    return joined.select("i", "j", "row_item", "col_item", value.cast("long").alias("count"))


def list_summary(column: str, counts: DataFrame) -> DataFrame:
    """``(column, total_items_parsed, num_unique_elements)``: the sum of the
    per-item row counts and the number of distinct items."""
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_items_parsed"),
                      F.count("*").cast("long").alias("num_unique_elements")).select(
        F.lit(column).alias("column"), "total_items_parsed", "num_unique_elements")
