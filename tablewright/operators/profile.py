"""Column profiling: null shares, sparse-column dropping and semantic types.

Both the null profile and the type checks are a single aggregate over all
columns (partial aggregation per partition, a one-row final result), whatever
the number of columns. Only per-column metadata reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.functions.names import col
from tablewright.functions.text import (is_missing, is_numeric_type, looks_boolean, looks_numeric, looks_truth,
                                        starts_with_after_space, try_number, value_text)

# Column count from which per-column counts are grouped by position instead
# of held as one field each in a single-row aggregate.
_WIDE_COLUMNS = 90

PROFILE_SCHEMA = ("column string, position int, null_count long, row_count long, "
                  "null_ratio double, dropped boolean")


def null_profile(df: DataFrame, threshold: float = C.NULL_THRESHOLD,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, position, null_count, row_count, null_ratio, dropped)``;
    a column is dropped when its null share is strictly above ``threshold``."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns) if columns is not None else list(df.columns)
    ratio = F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    if len(cols) < _WIDE_COLUMNS:
        # One row, one count per column: within Spark's codegen field limit.
        counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                        *[F.count_if(is_missing(col(c), schema[c])).alias(f"_n{i}")
                          for i, c in enumerate(cols)])
        cells = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                          F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)]
        base = counts.select(F.col("_rows").alias("row_count"), F.inline(F.array(*cells)))
    else:
        # Very wide tables: (position, missing) cells grouped by position, so
        # the aggregation buffer does not grow with the column count.
        cells = [F.struct(F.lit(i).alias("position"), is_missing(col(c), schema[c]).alias("m"))
                 for i, c in enumerate(cols)]
        grouped = (df.select(F.inline(F.array(*cells))).groupBy("position")
                   .agg(F.count(F.lit(1)).alias("_rows"), F.count_if("m").alias("_n")))
        names = df.sparkSession.createDataFrame(list(enumerate(cols)), "position int, column string")
        # One row per column on both sides: proven small.
        base = names.join(F.broadcast(grouped), "position", "left").select(
            "column", "position", F.coalesce("_n", F.lit(0)).alias("null_count"),
            F.coalesce("_rows", F.lit(0)).alias("row_count"))
    return (base.select("column", "position", "null_count", "row_count",
                        F.coalesce(ratio, F.lit(0.0)).alias("null_ratio"))
            .withColumn("dropped", F.col("null_ratio") > F.lit(float(threshold))))


def kept_columns(profile: DataFrame) -> list[str]:
    """Columns that survive the sparse-column drop, in input order."""
    rows = profile.where(~F.col("dropped")).select("column", "position").collect()
    return [r.column for r in sorted(rows, key=lambda r: r.position)]


def drop_sparse(df: DataFrame, threshold: float = C.NULL_THRESHOLD,
                keep: Sequence[str] = ()) -> DataFrame:
    """``df`` without the columns whose null share exceeds ``threshold``
    (columns in ``keep``, such as a row id, always stay)."""
    cols = [c for c in df.columns if c not in keep]
    kept = set(kept_columns(null_profile(df, threshold, cols)))
    return df.select(*[col(c) for c in df.columns if c in kept or c in keep])


def type_sample(df: DataFrame, order_cols: Sequence[str] | None, rows: int | None,
                dense_id: bool = False) -> DataFrame:
    """The rows types are detected on: the first ``rows`` rows in
    ``order_cols`` order, or everything (see ``numeric.head``)."""
    if rows is None:
        return df
    if order_cols:
        from tablewright.operators.numeric import head
        return head(df, order_cols, rows, dense_id)
    return df.limit(rows)


_BUCKET_WORDS = 2  # 128 hash buckets
FLAGS = ("num", "tf", "yn", "br", "sq", "cm")

STATE = ("column string, position int, row_count long, null_count long, nn long, "
         + ", ".join(f"{n} long" for n in FLAGS) + ", " + ", ".join(f"bm{w} long" for w in range(_BUCKET_WORDS))
         + ", small array<double>, mean double, m2 double, lo double, hi double")
STATE_NAMES = [f.split()[0] for f in STATE.split(", ")]


def _bucket_bitmaps(x, bucket, prefix: str) -> list:
    """``bit_or`` of one bit per value-hash bucket: a declarative aggregate
    (keeps whole-stage codegen), merged map-side."""
    out = []
    for w in range(_BUCKET_WORDS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (bucket - 64 * w).cast("int"))
        inside = x.isNotNull() & (bucket >= 64 * w) & (bucket < 64 * (w + 1))
        out.append(F.bit_or(F.when(inside, bit)).alias(f"{prefix}{w}"))
    return out


def _occupied(row) -> int:
    """Number of occupied buckets (a lower bound on distinct values)."""
    words = [row[f"bm{w}"] or 0 for w in range(_BUCKET_WORDS)]
    return sum(bin(v & ((1 << 64) - 1)).count("1") for v in words)


def _small_sets(df: DataFrame, cols: Sequence[str], limit: int) -> dict[str, list[float]]:
    """The distinct numbers of each column that has at most ``limit`` of them."""
    if not cols:
        return {}
    schema = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column"), try_number(col(c), schema[c]).alias("value"))
             for c in cols]
    values = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).distinct()
    # A column of more is given by one more than the limit, so no array grows with the data.
    salted = values.groupBy("column", F.pmod(F.xxhash64("value"), F.lit(64)).alias("salt")).agg(
        F.slice(F.sort_array(F.collect_list("value")), 1, limit + 1).alias("some"))
    found = salted.groupBy("column").agg(F.flatten(F.collect_list("some")).alias("some")).collect()
    out: dict[str, list[float]] = {c: [] for c in cols}
    out.update({r["column"]: sorted(r["some"]) for r in found})
    return {c: v for c, v in out.items() if len(v) <= limit}


def profile_state(df: DataFrame, columns: Sequence[str] | None = None,
                  limit: int = C.NUMERIC_CATEGORICAL_THRESHOLD) -> DataFrame:
    """A row for each column, in ``STATE``'s form: rows, missing and present cells,
    how many look like a number, a truth word, Y or N, a dict, a list or hold a
    comma, a bit map of the numbers' hashes, the numbers themselves if there are
    at most ``limit``, and their moments. States of parts of a table merge
    (:func:`merge_profiles`); types, null shares and summaries follow from a state.

    Every cell is parsed once into a flag struct; ``inline`` turns a row into
    one row per column and a narrow ``groupBy(position)`` aggregate (partial
    map-side, at most one row per column per partition) counts the flags. The
    aggregation buffer has a fixed width whatever the number of columns, so
    whole-stage codegen stays on (a single wide aggregate with several fields
    per column exceeds Spark's codegen field limit and runs interpreted). Distinct
    numbers only matter up to ``limit``: the bit maps give a lower bound, and only
    the columns within it (few values in practice) are read again."""
    spark = df.sparkSession
    cols = list(columns) if columns is not None else list(df.columns)
    schema = {f.name: f.dataType for f in df.schema.fields}
    no = F.lit(False)
    cells = []
    for i, c in enumerate(cols):
        dt = schema[c]
        x = try_number(col(c), dt)
        if is_numeric_type(dt):
            present, flags = x.isNotNull(), [x.isNotNull(), no, no, no, no, no]
        else:
            s = value_text(col(c), dt)
            present = s.isNotNull()
            flags = [looks_numeric(s), looks_truth(s), looks_boolean(s), starts_with_after_space(s, "{"),
                     starts_with_after_space(s, "["), s.contains(",")]
        cells.append(F.struct(F.lit(i).alias("pos"), x.alias("x"), present.alias("nn"), is_missing(col(c), dt).alias("missing"),
                              *[f.alias(n) for f, n in zip(flags, FLAGS)]))
    if not cells:
        return spark.createDataFrame([], STATE)
    long = df.select(F.inline(F.array(*cells))).withColumn("b", F.pmod(F.xxhash64("x"), F.lit(64 * _BUCKET_WORDS)))
    found = {r["pos"]: r.asDict() for r in long.groupBy("pos").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("missing").alias("null_count"),
        *[F.count_if(F.col(n) & F.col("nn")).alias(n) for n in ("nn", *FLAGS)], *_bucket_bitmaps(F.col("x"), F.col("b"), "bm"),
        F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    empty = {n: 0 for n in ("row_count", "null_count", "nn", *FLAGS)} | {f"bm{w}": 0 for w in range(_BUCKET_WORDS)} | {
        n: None for n in ("mean", "m2", "lo", "hi")}      # no rows at all: every count is zero
    rows = [found.get(i, empty) | {"column": c, "position": i} for i, c in enumerate(cols)]
    few = [r["column"] for r in rows if r["num"] == r["nn"] and _occupied(r) <= limit]
    small = _small_sets(df, few, limit)
    rows = [r | {"small": small.get(r["column"]), **{f"bm{w}": r[f"bm{w}"] or 0 for w in range(_BUCKET_WORDS)}} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in STATE_NAMES) for r in rows], STATE)


def merge_profiles(states: DataFrame, limit: int = C.NUMERIC_CATEGORICAL_THRESHOLD) -> DataFrame:
    """The state of all parts from the rows of several states. A part's small set
    is missing where it has too many numbers, or text; then so is the whole's."""
    whole = Window.partitionBy("column", "position")
    # Only parts with numbers have moments.
    n = F.when(F.col("mean").isNotNull(), F.col("num"))
    held = states.withColumn("_mean", F.sum(n * F.col("mean")).over(whole) / F.sum(n).over(whole))
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("small"))))
    few = (F.count("small") == F.count(F.lit(1))) & (F.size(every) <= limit)
    out = held.groupBy("column", "position").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_count", "nn", *FLAGS)], *[F.bit_or(f"bm{w}").alias(f"bm{w}") for w in range(_BUCKET_WORDS)],
        F.when(few, every).alias("small"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + n * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return out.select(*STATE_NAMES)


def types_of(state: DataFrame, no_list: Sequence[str] = (), limit: int = C.NUMERIC_CATEGORICAL_THRESHOLD) -> DataFrame:
    """``(column, position, type, hint)`` of a state (see :func:`detect_types`)."""
    rows = []
    for r in sorted(state.collect(), key=lambda r: r["position"]):      # one row per column
        c, hint, nn = r["column"], None, r["nn"]
        share = {n: r[n] / nn if nn else 0.0 for n in FLAGS}
        if r["num"] == nn:
            kind = C.NUMERIC_CATEGORICAL if r["small"] is not None and len(r["small"]) <= limit else C.NUMERIC
        elif r["tf"] == nn:
            kind = C.NUMERIC_CATEGORICAL
        elif r["yn"] == nn:
            kind = C.BOOLEAN
        elif c not in no_list and share["br"] > C.DICT_SHARE:
            kind, hint = C.DICT_JSON, C.HINT_DICT
        elif c not in no_list and share["sq"] > C.LIST_SHARE:
            kind, hint = C.LIST_JSON, C.HINT_JSON
        elif c not in no_list and share["cm"] > C.COMMA_SHARE:
            kind, hint = C.LIST_JSON, C.HINT_CSV
        else:
            kind = C.CATEGORICAL
        rows.append((c, r["position"], kind, hint))
    return state.sparkSession.createDataFrame(rows, "column string, position int, type string, hint string")


def nulls_of(state: DataFrame, threshold: float = C.NULL_THRESHOLD) -> DataFrame:
    """:func:`null_profile` of a state."""
    ratio = F.coalesce(F.try_divide(F.col("null_count").cast("double"), F.col("row_count").cast("double")), F.lit(0.0))
    return state.select("column", "position", "null_count", "row_count", ratio.alias("null_ratio")).withColumn(
        "dropped", F.col("null_ratio") > F.lit(float(threshold)))


def summary_of(state: DataFrame) -> DataFrame:
    """``(column, count, min, max, mean)`` of the numbers of each column of a state."""
    return state.select("column", F.when(F.col("mean").isNull(), F.lit(0)).otherwise(F.col("num")).cast("long").alias("count"),
                        F.col("lo").alias("min"), F.col("hi").alias("max"), F.coalesce("mean", F.lit(0.0)).alias("mean"))


def add_profile(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Scan ``df``, the rows that are new, and add their state at ``path``."""
    profile_state(df, columns).coalesce(1).write.mode("append").parquet(path)


def stored_profile(spark, path: str) -> DataFrame:
    """The state of all rows whose states were added at ``path``."""
    return merge_profiles(spark.read.schema(STATE).parquet(path))


def detect_types(df: DataFrame, columns: Sequence[str] | None = None,
                 order_cols: Sequence[str] | None = None,
                 sample_rows: int | None = None,
                 no_list: Sequence[str] = (),
                 numeric_categorical_threshold: int = C.NUMERIC_CATEGORICAL_THRESHOLD,
                 dense_id: bool = False) -> DataFrame:
    """``(column, position, type, hint)`` for each column.

    First matching rule on the non-null values: all number-like -> numeric
    (``numeric_categorical`` when at most ``numeric_categorical_threshold``
    distinct numbers); all ``True``/``False`` (three spellings each) ->
    numeric_categorical; all ``Y``/``N`` after stripping -> boolean; unless the
    column is in ``no_list``: share starting with ``{`` > 0.5 -> dict_json
    (hint dict), share starting with ``[`` > 0.5 -> list_json (hint json),
    share containing a comma > 0.3 -> list_json (hint csv); else categorical.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    sample = type_sample(df.select(*[col(c) for c in dict.fromkeys([*cols, *(order_cols or [])])]),
                         order_cols, sample_rows, dense_id)
    if sample_rows is not None:
        # At most ``sample_rows`` rows, read by up to two aggregates: keep them.
        sample = sample.cache()
    types = types_of(profile_state(sample, cols, numeric_categorical_threshold), no_list, numeric_categorical_threshold)
    if sample_rows is not None:
        sample.unpersist()
    return types


def type_histogram(types: DataFrame) -> DataFrame:
    """Number of columns per semantic type."""
    return types.groupBy("type").agg(F.count("*").alias("n_columns"))
