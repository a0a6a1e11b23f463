"""Moments of columns and of pairs of columns as tables that merge.

A state is a table with a row for each column, or pair of columns: how many rows
have both values, their means, squared deviations, the product of deviations and
the least and greatest values. States of separate parts of a table merge into the
state of the whole (:func:`merge_columns`, :func:`merge_pairs`), so scaling,
correlation and principal components follow new files without a second look at
the old ones.

All pairs are one aggregate over one scan. Columns are grouped in blocks of
``BLOCK``; a row is unpivoted to its pairs of blocks, not of columns, and grouped by
the pair, so the buffer has a fixed width (within Spark's limit for generated
code) whatever the number of columns. Values are taken less a value of the
column, which keeps sums of squares small; what they are does not depend on it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.names import col
from tablewright.functions.text import try_number

#: Columns of a block: 9 pairs of 10 sums are below the limit of 100 fields.
BLOCK = 3

COLUMN_STATE = "column string, n bigint, mean double, m2 double, lo double, hi double"
PAIR_STATE = ("col_x string, col_y string, n bigint, mean_x double, mean_y double, m2_x double, m2_y double, c_xy double, "
              "lo_x double, hi_x double, lo_y double, hi_y double")


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One column ``v``, the numeric values of ``cols`` as an array."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    return df.select(F.array(*[try_number(col(c), schema[c]) for c in cols]).alias("v"))


def column_state(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row for each column of ``cols``, in one scan."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column"), try_number(col(c), schema[c]).alias("x")) for c in cols]
    stats = df.select(F.inline(F.array(*cells))).groupBy("column").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"),
        F.min("x").alias("lo"), F.max("x").alias("hi"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    # A row for each column on both sides.
    return names.join(F.broadcast(stats), "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).alias("n"), "mean", "m2", "lo", "hi")


def merge_columns(states: DataFrame) -> DataFrame:
    """The state of all parts from the rows of several states."""
    whole = Window.partitionBy("column")
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    return states.withColumn("_mean", mean).groupBy("column").agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def scaler_of(state: DataFrame) -> DataFrame:
    """``(column, mean, std)``: mean and population standard deviation; a zero
    deviation is replaced by 1."""
    std = F.when(F.col("hi") > F.col("lo"), F.sqrt(F.greatest(F.col("m2") / F.col("n"), F.lit(0.0))))
    return state.select("column", "mean", F.when(std > 0, std).otherwise(F.lit(1.0)).alias("std"))


def _origins(values: DataFrame, n: int) -> list[float]:
    """A value of each column from the first rows; 0 where they have none."""
    rows = values.limit(20).collect()
    return [next((float(r["v"][k]) for r in rows if r["v"][k] is not None and math.isfinite(r["v"][k])), 0.0) for k in range(n)]


def pair_state(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row for each pair of columns, also of a column with itself: ``col_x`` comes
    before or is ``col_y`` in ``cols``; only rows with both values count."""
    cols = list(cols)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], PAIR_STATE)
    values = _values(df, cols)
    origins = _origins(values, len(cols))
    blocks = -(-len(cols) // BLOCK)
    shifted = values.select(F.zip_with("v", F.array(*map(F.lit, origins)), lambda x, o: x - o).alias("v"))
    pairs = shifted.select("v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("bx")).select(
        "v", "bx", F.explode(F.sequence(F.col("bx"), F.lit(blocks - 1))).alias("by"))
    cells = pairs.select("bx", "by", *[F.get("v", F.col(b) * BLOCK + k).alias(f"{s}{k}")
                                       for b, s in (("bx", "x"), ("by", "y")) for k in range(BLOCK)])
    sums = []
    for i in range(BLOCK):
        for j in range(BLOCK):
            x, y = F.col(f"x{i}"), F.col(f"y{j}")
            both = x.isNotNull() & y.isNotNull()
            x, y = F.when(both, x), F.when(both, y)
            sums += [f(e).alias(f"{name}{i}{j}") for name, f, e in (
                ("n", F.count, x), ("sx", F.sum, x), ("sy", F.sum, y), ("xx", F.sum, x * x), ("yy", F.sum, y * y), ("xy", F.sum, x * y),
                ("lx", F.min, x), ("hx", F.max, x), ("ly", F.min, y), ("hy", F.max, y))]
    grouped = cells.groupBy("bx", "by").agg(*sums)
    rows = []
    for i in range(BLOCK):
        for j in range(BLOCK):
            rows.append(F.struct((F.col("bx") * BLOCK + i).alias("i"), (F.col("by") * BLOCK + j).alias("j"), *[
                F.col(f"{name}{i}{j}").alias(name) for name in ("n", "sx", "sy", "xx", "yy", "xy", "lx", "hx", "ly", "hy")]))
    flat = grouped.select(F.inline(F.array(*rows))).where((F.col("i") <= F.col("j")) & (F.col("j") < len(cols)))
    names, origin = F.array(*map(F.lit, cols)), F.array(*map(F.lit, origins))
    name, at = (lambda k: F.get(names, F.col(k))), (lambda k: F.get(origin, F.col(k)))
    n = F.nullif(F.col("n"), F.lit(0))
    found = flat.select(
        name("i").alias("col_x"), name("j").alias("col_y"), "n",
        (at("i") + F.col("sx") / n).alias("mean_x"), (at("j") + F.col("sy") / n).alias("mean_y"),
        F.greatest(F.col("xx") - F.col("sx") * F.col("sx") / n, F.lit(0.0)).alias("m2_x"),
        F.greatest(F.col("yy") - F.col("sy") * F.col("sy") / n, F.lit(0.0)).alias("m2_y"),
        (F.col("xy") - F.col("sx") * F.col("sy") / n).alias("c_xy"),
        (at("i") + F.col("lx")).alias("lo_x"), (at("i") + F.col("hx")).alias("hi_x"),
        (at("j") + F.col("ly")).alias("lo_y"), (at("j") + F.col("hy")).alias("hi_y"))
    # A row for each pair on both sides: an empty table has its pairs, too.
    every = spark.createDataFrame([(a, b) for k, a in enumerate(cols) for b in cols[k:]], "col_x string, col_y string")
    return every.join(F.broadcast(found), ["col_x", "col_y"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def merge_pairs(states: DataFrame) -> DataFrame:
    """The state of all parts from the rows of several states."""
    whole = Window.partitionBy("col_x", "col_y")
    n = F.nullif(F.sum("n").over(whole), F.lit(0))
    held = states.withColumn("_x", F.sum(F.col("n") * F.col("mean_x")).over(whole) / n).withColumn(
        "_y", F.sum(F.col("n") * F.col("mean_y")).over(whole) / n)
    dx, dy = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    return held.groupBy("col_x", "col_y").agg(
        F.sum("n").alias("n"), F.first("_x").alias("mean_x"), F.first("_y").alias("mean_y"),
        F.sum(F.col("m2_x") + F.col("n") * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + F.col("n") * dy * dy).alias("m2_y"),
        F.sum(F.col("c_xy") + F.col("n") * dx * dy).alias("c_xy"),
        *[f(c).alias(c) for c, f in (("lo_x", F.min), ("hi_x", F.max), ("lo_y", F.min), ("hi_y", F.max))])


def columns_of(pairs: DataFrame) -> DataFrame:
    """The column state within a pair state."""
    return pairs.where("col_x = col_y").select(F.col("col_x").alias("column"), "n", F.col("mean_x").alias("mean"), F.col("m2_x").alias("m2"),
                                               F.col("lo_x").alias("lo"), F.col("hi_x").alias("hi"))


def pearson_of(pairs: DataFrame) -> DataFrame:
    """``(col_x, col_y, pearson)`` for every ordered pair, diagonal included; null
    where one of the two is constant over the pair's rows."""
    varies = (F.col("hi_x") > F.col("lo_x")) & (F.col("hi_y") > F.col("lo_y"))
    r = F.when(varies, F.when(F.col("col_x") == F.col("col_y"), F.lit(1.0)).otherwise(
        F.try_divide(F.col("c_xy"), F.sqrt("m2_x") * F.sqrt("m2_y"))))
    one = pairs.select("col_x", "col_y", r.alias("pearson"))
    other = one.where("col_x <> col_y").select(F.col("col_y").alias("col_x"), F.col("col_x").alias("col_y"), "pearson")
    return one.unionByName(other)


def correlation_matrix(pairs: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """The matrix of :func:`pearson_of`, a constant column being 0 throughout: the
    covariance of standardised columns."""
    place = {c: k for k, c in enumerate(cols)}
    out = np.zeros((len(cols), len(cols)))
    for r in pearson_of(pairs).collect():
        out[place[r["col_x"]], place[r["col_y"]]] = r["pearson"] or 0.0
    return out


# --- a state that follows new files ------------------------------------------------

def add_to_state(df: DataFrame, cols: Sequence[str], path: str) -> None:
    """Scan ``df``, the rows that are new, and add their state at ``path``."""
    pair_state(df, cols).coalesce(1).write.mode("append").parquet(path)


def stored_state(spark, path: str) -> DataFrame:
    """The state of all rows whose states were added at ``path``."""
    return merge_pairs(spark.read.schema(PAIR_STATE).parquet(path))


def fitted(pairs: DataFrame, cols: Sequence[str]) -> tuple[Mapping[str, tuple[float, float]], np.ndarray, np.ndarray]:
    """Scaler parameters, loadings and variance ratios of the table that a pair
    state describes, without reading the table."""
    from tablewright.operators.features import pca_components, principal

    scaler = {r["column"]: (r["mean"], r["std"]) for r in scaler_of(columns_of(pairs)).collect()}
    matrix = correlation_matrix(pairs, cols)
    loadings, variances = principal(matrix, pca_components(len(cols)))
    return scaler, loadings, variances / (np.trace(matrix) or 1.0)
