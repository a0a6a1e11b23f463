"""Exploratory statistics of numeric columns.

Each statistic is one aggregate over all requested columns, or an aggregate
over the long ``(column, value)`` form when a per-column grid is needed
(histogram, density). Per-column parameters (quartiles, min/max, bandwidth)
are a few numbers per column; they are collected and inlined as literals.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.functions.names import col
from tablewright.functions.text import try_number
from tablewright.operators.moments import pair_state, pearson_of
from tablewright.operators.quantiles import interpolated, numeric_long, rank_pairs


def _typed(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict]:
    """``df`` with each of ``cols`` parsed to DOUBLE once (columns ``_v{i}``),
    and the plain column references to aggregate over."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    view = df.select(*[try_number(col(c), schema[c]).alias(f"_v{i}") for i, c in enumerate(cols)])
    return view, {c: F.col(f"_v{i}") for i, c in enumerate(cols)}


def per_column(df: DataFrame, cols: Sequence[str], aggs) -> DataFrame:
    """``(column, *aggs(value))``, one row per column of ``cols``.

    The cells are unpivoted to ``(column, value)`` and grouped by column: the
    aggregation buffer has a fixed width whatever the number of columns (a
    one-row aggregate with several fields per column passes Spark's codegen
    field limit on wide tables), and each partial aggregate holds one row per
    column. A column without any row still gets its row (null aggregates)."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column"), try_number(col(c), schema[c]).alias("value"))
             for c in cols]
    stats = df.select(F.inline(F.array(*cells))).groupBy("column").agg(*aggs(F.col("value")))
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, _pos int")
    # One row per requested column on both sides: proven small.
    return names.join(F.broadcast(stats), "column", "left").drop("_pos")


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, count, min, max, mean)``; mean is 0 for an empty column."""
    out = per_column(df, cols, lambda x: [F.count(x).alias("count"), F.min(x).alias("min"),
                                          F.max(x).alias("max"), F.avg(x).alias("mean")])
    return out.select("column", F.coalesce("count", F.lit(0)).alias("count"), "min", "max",
                      F.coalesce("mean", F.lit(0.0)).alias("mean"))


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n, skewness)``: bias-corrected sample skewness
    ``g1 · sqrt(n(n-1)) / (n-2)``; 0 for a constant column, null for n < 3."""
    def aggs(x):
        n = F.count(x).cast("double")
        adj = F.when(n < 3, F.lit(None).cast("double")).when(
            F.stddev_pop(x) == 0, F.lit(0.0)).otherwise(
            F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
        return [F.count(x).alias("n"), adj.alias("skewness")]
    out = per_column(df, cols, aggs)
    return out.select("column", F.coalesce("n", F.lit(0)).alias("n"), "skewness")


def skewed_columns(df: DataFrame, cols: Sequence[str],
                   threshold: float = C.SKEW_LOG_THRESHOLD) -> dict[str, float]:
    """``{column: min}`` for the columns whose |skewness| exceeds
    ``threshold`` (NaN/null skewness never does)."""
    sk = {r["column"]: r["skewness"] for r in skewness(df, cols).collect()}
    chosen = [c for c in cols if sk.get(c) is not None and abs(sk[c]) > threshold]
    if not chosen:
        return {}
    v, x = _typed(df, chosen)
    row = v.agg(*[F.min(x[c]).alias(f"m{i}") for i, c in enumerate(chosen)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(chosen)}


def log_transform(df: DataFrame, mins: Mapping[str, float]) -> DataFrame:
    """Replace each column in ``mins`` by ``log1p(x - min)``."""
    out = df
    schema = {f.name: f.dataType for f in df.schema.fields}
    for c, m in mins.items():
        out = out.withColumn(c, F.log1p(try_number(col(c), schema[c]) - F.lit(float(m))))
    return out


def plot_values(df: DataFrame, cols: Sequence[str],
                threshold: float = C.SKEW_LOG_THRESHOLD) -> tuple[DataFrame, dict[str, float]]:
    """The values a distribution display uses: heavily skewed columns go
    through ``log1p(x - min)``. Returns the frame and the transformed set."""
    mins = skewed_columns(df, cols, threshold)
    return log_transform(df, mins), mins


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quartile_ranks(df: DataFrame, cols: Sequence[str]) -> dict:
    """The order statistics behind the quartiles of ``cols``, for several uses of
    one search (``ranks`` below)."""
    return rank_pairs(df, cols, list(QUARTILES.values())) if cols else {}


def plotted_ranks(ranks: Mapping, mins: Mapping[str, float]) -> dict:
    """``ranks`` of columns that :func:`log_transform` has changed by ``mins``."""
    return {(c, p): (*(math.log1p(v - mins[c]) for v in pair[:2]), pair[2]) if c in mins else pair
            for (c, p), pair in ranks.items()}


def quartile_bounds(df: DataFrame, cols: Sequence[str], factor: float = C.IQR_FACTOR,
                    ranks: Mapping | None = None) -> dict[str, dict]:
    """Per column: q1, median, q3, iqr and the outlier fences."""
    ranks = quartile_ranks(df, cols) if ranks is None else ranks
    out = {}
    for c in cols:
        if (c, 0.5) in ranks:
            q = {name: interpolated(*ranks[c, p]) for name, p in QUARTILES.items()}
            iqr = q["q3"] - q["q1"]
            out[c] = dict(q, iqr=iqr, lower=q["q1"] - factor * iqr, upper=q["q3"] + factor * iqr)
    return out


def _outside(x, b) -> F.Column:
    return (x < F.lit(b["lower"])) | (x > F.lit(b["upper"]))


def iqr_outliers(df: DataFrame, cols: Sequence[str], factor: float = C.IQR_FACTOR, ranks: Mapping | None = None) -> DataFrame:
    """``(column, q1, q3, iqr, lower, upper, n_outliers)``; a value is an
    outlier when strictly outside ``[q1 - f·iqr, q3 + f·iqr]``."""
    bounds = quartile_bounds(df, cols, factor, ranks)
    present = [c for c in cols if c in bounds]
    spark = df.sparkSession
    schema = ("column string, q1 double, q3 double, iqr double, lower double, "
              "upper double, n_outliers long")
    if not present:
        return spark.createDataFrame([], schema)
    v, x = _typed(df, present)
    cells = [F.struct(F.lit(c).alias("column"),
                      *[F.lit(float(bounds[c][k])).alias(k) for k in ("q1", "q3", "iqr", "lower", "upper")],
                      F.count_if(_outside(x[c], bounds[c])).alias("n_outliers"))
             for c in present]
    return v.agg(F.array(*cells).alias("_s")).select(F.inline("_s"))


def remove_outliers(df: DataFrame, cols: Sequence[str], factor: float = C.IQR_FACTOR, ranks: Mapping | None = None) -> DataFrame:
    """Rows of ``df`` that are not an IQR outlier in any of ``cols`` (nulls
    are kept). A plain filter with literal fences: pushed into the scan stage."""
    bounds = quartile_bounds(df, cols, factor, ranks)
    schema = {f.name: f.dataType for f in df.schema.fields}
    x = {c: try_number(col(c), schema[c]) for c in cols}
    keep = F.lit(True)
    for c in cols:
        if c in bounds:
            keep = keep & ~F.coalesce(_outside(x[c], bounds[c]), F.lit(False))
    return df.where(keep)


def box_stats(df: DataFrame, cols: Sequence[str], factor: float = C.IQR_FACTOR, ranks: Mapping | None = None) -> DataFrame:
    """``(column, q1, median, q3, whisker_lo, whisker_hi, n_fliers)``: the
    whiskers are the furthest values inside the 1.5·IQR fences, and never end
    inside the box."""
    bounds = quartile_bounds(df, cols, factor, ranks)
    present = [c for c in cols if c in bounds]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, median double, q3 double, whisker_lo double, "
                "whisker_hi double, n_fliers long")
    # One row per column (quartiles and fences): proven small, broadcast. The
    # whiskers are a grouped aggregate over the unpivoted values, so the
    # buffer width does not grow with the number of columns.
    fences = F.broadcast(df.sparkSession.createDataFrame(
        [(c, *[float(bounds[c][k]) for k in ("q1", "median", "q3", "lower", "upper")]) for c in present],
        "column string, q1 double, median double, q3 double, lower double, upper double"))
    x = F.col("value")
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    outside = (x < F.col("lower")) | (x > F.col("upper"))
    stats = (numeric_long(df, present).join(fences.select("column", "lower", "upper"), "column")
             .groupBy("column").agg(F.min(F.when(inside, x)).alias("whisker_lo"),
                                    F.max(F.when(inside, x)).alias("whisker_hi"),
                                    F.count_if(outside).alias("n_fliers")))
    return fences.join(F.broadcast(stats), "column", "left").select(
        "column", "q1", "median", "q3", F.least("whisker_lo", "q1").alias("whisker_lo"),
        F.greatest("whisker_hi", "q3").alias("whisker_hi"), F.coalesce("n_fliers", F.lit(0)).cast("long").alias("n_fliers"))


def _ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """``{column: (min, max, count, sample std)}`` (one row per column)."""
    rows = per_column(df, cols, lambda x: [F.min(x).alias("lo"), F.max(x).alias("hi"),
                                           F.count(x).alias("n"), F.stddev_samp(x).alias("sd")]).collect()
    return {r["column"]: (r["lo"], r["hi"], r["n"] or 0, r["sd"]) for r in rows}


def _param_table(spark, rows, schema):
    return F.broadcast(spark.createDataFrame(rows, schema))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """``(column, bin, bin_lo, bin_hi, count, density)`` with ``bins`` equal
    bins between min and max (last bin closed, a constant column spans
    ±0.5); density = count / (n · width). Empty bins are included."""
    spark = df.sparkSession
    ranges = _ranges(df, cols)
    params = []
    for c, (lo, hi, n, _) in ranges.items():
        if not n:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        params.append((c, float(lo), float(hi), int(n)))
    schema = "column string, lo double, hi double, n long"
    if not params:
        return spark.createDataFrame([], "column string, bin int, bin_lo double, bin_hi double, "
                                         "count long, density double")
    p = _param_table(spark, params, schema)  # one row per column: proven small
    scale = F.lit(float(bins)) / (F.col("hi") - F.col("lo"))
    idx = F.least(F.floor((F.col("value") - F.col("lo")) * scale), F.lit(bins - 1)).cast("int")
    counts = (numeric_long(df, [c for c, *_ in params]).join(p, "column")
              .groupBy("column", idx.alias("bin")).agg(F.count("*").alias("count")))
    grid = p.select("column", "lo", "hi", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    out = grid.join(counts, ["column", "bin"], "left").fillna(0, ["count"])
    return out.select("column", "bin",
                      (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                      F.col("count").cast("long").alias("count"),
                      (F.col("count") / (F.col("n") * width)).alias("density"))


def kde(df: DataFrame, cols: Sequence[str], points: int = C.KDE_POINTS,
        bandwidth: float = C.KDE_BANDWIDTH) -> DataFrame:
    """``(column, point, x, density)``: Gaussian kernel density with
    bandwidth ``bandwidth · sample std`` at ``points`` equally spaced points
    from min to max. Columns with zero variance get no curve.

    Each task adds the kernels of its values to an array with a place for each
    point (equal values of a batch once), and emits the arrays at its end; a value
    never becomes a row for each point, nor a key of an exchange."""
    spark = df.sparkSession
    ranges = _ranges(df, cols)
    params = []
    for c, (lo, hi, n, sd) in ranges.items():
        if not n or sd is None or not (sd > 0) or math.isnan(sd):
            continue
        params.append((c, float(lo), float(hi), int(n), float(bandwidth * sd)))
    if not params:
        return spark.createDataFrame([], "column string, point int, x double, density double")
    p = _param_table(spark, params, "column string, lo double, hi double, n long, h double")
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    grid_x = F.when(F.col("point") == points - 1, F.col("hi")).otherwise(F.col("lo") + F.col("point") * step)
    grids = [(np.append(lo + np.arange(points - 1) * ((hi - lo) / (points - 1)), hi), h) for _, lo, hi, _, h in params]
    view, held = _typed(df, [c for c, *_ in params])

    def run(batches):
        import pyarrow as pa
        total = np.zeros((len(grids), points))
        for batch in batches:
            for k, (grid, h) in enumerate(grids):
                values, many = np.unique(batch.column(k).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                for at in range(0, len(values), 512):
                    z = (grid[:, None] - values[at:at + 512]) / h
                    total[k] += np.exp(-0.5 * z * z) @ many[at:at + 512]
        yield pa.record_batch([pa.array(np.repeat(np.arange(len(grids), dtype=np.int32), points)),
                               pa.array(np.tile(np.arange(points, dtype=np.int32), len(grids))), pa.array(total.ravel())],
                              names=["_k", "point", "s"])

    sums = view.select(*[held[c] for c, *_ in params]).mapInArrow(run, "_k int, point int, s double")
    names = F.array(*[F.lit(c) for c, *_ in params])
    sums = sums.groupBy(F.get(names, F.col("_k")).alias("column"), "point").agg(F.sum("s").alias("_s"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (sums.join(p, "column").withColumn("x", grid_x)
            .select("column", F.col("point").cast("int").alias("point"), "x", (F.col("_s") / norm).alias("density")))


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col_x, col_y, pearson)`` for every ordered pair, diagonal included.
    Each pair uses the rows where both values are present; a constant column
    gives null. All pairs come from one scan (``moments.pair_state``)."""
    return pearson_of(pair_state(df, cols))


def head(df: DataFrame, order_cols: Sequence[str], n: int, dense_id: bool = False,
         groups: int | None = None) -> DataFrame:
    """First ``n`` rows in ``order_cols`` order.

    * ``dense_id``: ``order_cols`` is one dense 0-based row id (as made by
      ``assign_row_id`` / ``read_raw_csv``), so the head is a filter that is
      pushed into the scan;
    * otherwise a top-k in rounds, so that no task merges every partition's
      candidates: each input partition is cut to its own first ``n`` rows
      where it is (a sort within the partition and a filter on the
      partition-local index: no shuffle), the survivors of each of ``groups``
      groups of partitions (default: the shuffle partition count) are ranked
      together, and the final merge takes the first ``n`` of at most
      ``groups * n`` rows. The input's partition count is never asked for
      (that would run the input's shuffles ahead of the query)."""
    if dense_id and len(order_cols) == 1:
        return df.where(col(order_cols[0]) < F.lit(n))
    order = [col(c) for c in order_cols]
    groups = groups or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # monotonically_increasing_id = partition index << 33 | row index within
    # the partition, so its low bits number the rows of a sorted partition.
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    per_partition = (df.sortWithinPartitions(*order)
                     .withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(groups)))
                     .where(local < F.lit(n)))
    w = Window.partitionBy("_g").orderBy(*order)
    first = (per_partition.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
             .drop("_g", "_r"))
    return first.orderBy(*order).limit(n)


def scatter_points(sample: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """``(id, x_col, y_col, x, y)`` for every ordered pair of distinct
    columns over ``sample`` (the data behind a scatter matrix)."""
    schema = {f.name: f.dataType for f in sample.schema.fields}
    v = sample.select(col(id_col), *[try_number(col(c), schema[c]).alias(f"_v{i}") for i, c in enumerate(cols)])
    x = {c: F.col(f"_v{i}") for i, c in enumerate(cols)}
    cells = [F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"),
                      x[a].alias("x"), x[b].alias("y"))
             for a in cols for b in cols if a != b]
    return v.select(col(id_col), F.inline(F.array(*cells)))
