"""Exact quantiles (linear interpolation between order statistics) for many
columns at once, by narrowing.

A wanted rank is looked for in an interval of its column, at first all finite
values. One pass counts, for every open interval, how many values fall into each
of a fixed number of bins and the least and greatest value there: a partial
aggregate whose size depends on the columns, ranks and bins only. The bin that
holds the rank is the next interval, and the values before it are known. Bins are
of equal width in one pass and of equal ratio in the next, so neither a dense
cluster nor a heavy tail keeps the intervals from shrinking. An interval whose
least and greatest value agree is found (a value that fills a third of the table
costs one bin), one of few values is read.

No value is ever an exchange key and no column is sorted; the driver holds bin
counts and a bounded number of values for each rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.names import col
from tablewright.functions.text import try_number

#: Values of an interval that are read, and bins of one pass over all intervals.
READ_VALUES, PASS_BINS = 2_000, 16_384
MOST_BINS, FEWEST_BINS = 1_024, 64
#: The least exponent of a positive DOUBLE.
LEAST_EXPONENT = -1_074.0

QUANTILES = "column string, prob double, value double"


def numeric_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value DOUBLE)`` for every non-null numeric cell of ``cols``."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column"), try_number(col(c), schema[c]).alias("value"))
             for c in cols]
    return df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def _ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """Per column: how many values are below, within and above the finite ones,
    and the least and greatest finite value."""
    x, inf = F.col("value"), F.lit(float("inf"))
    finite = F.when(F.abs(x) < inf, x)
    rows = numeric_long(df, cols).groupBy("column").agg(
        F.count_if(x == -inf).alias("below"), F.count(finite).alias("count"), F.count_if(x == inf).alias("above"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()
    return {r["column"]: r.asDict() for r in rows}


def _exponent(x: Column) -> Column:
    """A monotone scale of equal ratios, with a place for 0."""
    return F.signum(x) * (F.log2(F.greatest(F.abs(x), F.lit(2.0 ** LEAST_EXPONENT))) - F.lit(LEAST_EXPONENT) + 1)


def bin_counts(df: DataFrame, intervals: Sequence[tuple[str, float, float]], bins: int, by_ratio: bool) -> DataFrame:
    """``(interval, bin, count, lo, hi)``: how the values of each interval (column,
    least, greatest; both closed, disjoint within a column) fall into ``bins``."""
    table = df.sparkSession.createDataFrame([(k, c, lo, hi) for k, (c, lo, hi) in enumerate(intervals)],
                                            "interval int, of string, least double, greatest double")
    x, a, b = F.col("value"), F.col("least"), F.col("greatest")
    if by_ratio:
        x, a, b = map(_exponent, (x, a, b))
    # Halves, so that the width of no interval overflows; flat scales have one bin.
    share = F.coalesce(F.try_divide(x / 2 - a / 2, b / 2 - a / 2), F.lit(0.0))
    at = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    # A row for each open interval: bounded by columns and ranks.
    held = numeric_long(df, list(dict.fromkeys(c for c, _, _ in intervals))).join(
        F.broadcast(table), (F.col("column") == F.col("of")) & (F.col("value") >= F.col("least")) & (F.col("value") <= F.col("greatest")))
    return held.groupBy("interval", at.alias("bin")).agg(
        F.count("*").alias("count"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def order_statistics(df: DataFrame, ranks: dict[str, Sequence[int]], ranges: dict[str, dict] | None = None) -> dict[tuple[str, int], float]:
    """The value of each rank (from 0 on, in rising order) of the numeric values of
    each column. Ranks outside the column's values are left out."""
    ranges = _ranges(df, list(ranks)) if ranges is None else ranges
    out: dict[tuple[str, int], float] = {}
    # (column, least, greatest) -> (values in it, values of the column before it, ranks looked for)
    open_: dict[tuple[str, float, float], tuple[int, int, list[int]]] = {}
    for c, wanted in ranks.items():
        r = ranges.get(c)
        if not r:
            continue
        inside = []
        for k in sorted(set(wanted)):
            if 0 <= k < r["below"]:
                out[c, k] = -math.inf
            elif 0 <= k - r["below"] < r["count"]:
                inside.append(k)
            elif 0 <= k - r["below"] - r["count"] < r["above"]:
                out[c, k] = math.inf
        if inside:
            open_[c, r["lo"], r["hi"]] = (r["count"], r["below"], inside)
    by_ratio = False
    while open_:
        for key, (n, before, wanted) in list(open_.items()):
            if key[1] == key[2]:
                out.update(((key[0], k), key[1]) for k in wanted)
                del open_[key]
        small = {key: x for key, x in open_.items() if x[0] <= READ_VALUES}
        if small:
            out.update(_read(df, small))
        keys = [key for key in open_ if key not in small]
        if not keys:
            break
        bins = max(FEWEST_BINS, min(MOST_BINS, PASS_BINS // len(keys)))
        counted: dict[int, list] = {}
        for r in bin_counts(df, keys, bins, by_ratio).collect():
            counted.setdefault(r["interval"], []).append(r)
        narrowed = {}
        for number, key in enumerate(keys):
            _, before, wanted = open_[key]
            for r in sorted(counted[number], key=lambda r: r["bin"]):
                mine = [k for k in wanted if before <= k < before + r["count"]]
                if mine:
                    narrowed[key[0], r["lo"], r["hi"]] = (r["count"], before, mine)
                before += r["count"]
        open_, by_ratio = narrowed, not by_ratio
    return out


def _read(df: DataFrame, intervals: dict) -> dict[tuple[str, int], float]:
    """Ranks of intervals of at most ``READ_VALUES`` values each."""
    by_column: dict[str, list] = {}
    for key in intervals:
        by_column.setdefault(key[0], []).append(key)
    wanted = F.lit(False)
    for c, keys in by_column.items():
        inside = F.lit(False)
        for _, lo, hi in keys:
            inside = inside | F.col("value").between(lo, hi)
        wanted = wanted | ((F.col("column") == c) & inside)
    values: dict[str, list[float]] = {}
    for r in numeric_long(df, list(by_column)).where(wanted).collect():
        values.setdefault(r["column"], []).append(r["value"])
    out = {}
    for (c, lo, hi), (_, before, ranks) in intervals.items():
        held = sorted(v for v in values[c] if lo <= v <= hi)
        out.update(((c, k), held[k - before]) for k in ranks)
    return out


def interpolated(low: float, high: float, position: float) -> float:
    """Between the values at the floor and the ceiling of a position."""
    a, b = math.floor(position), math.ceil(position)
    return low if a == b or low == high else (b - position) * low + (position - a) * high


def rank_pairs(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], tuple[float, float, float]]:
    """``{(column, prob): (value below, value above, position)}`` for the position
    ``(n - 1) * prob`` of each column with values; what a monotone function does to
    a column, it does to these."""
    ranges = _ranges(df, cols)
    at = {(c, float(p)): (r["below"] + r["count"] + r["above"] - 1) * float(p) for c, r in ranges.items() for p in probs}
    ranks = {c: [f(at[c, float(p)]) for p in probs for f in (math.floor, math.ceil)] for c in ranges}
    found = order_statistics(df, ranks, ranges)
    return {(c, p): (found[c, math.floor(x)], found[c, math.ceil(x)], x) for (c, p), x in at.items()}


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    return {key: interpolated(*pair) for key, pair in rank_pairs(df, cols, probs).items()} if cols else {}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(column, prob, value)`` for each numeric column with at least one
    value and each probability in ``probs``."""
    found = quantile_values(df, list(cols), probs)
    return df.sparkSession.createDataFrame([(c, p, v) for (c, p), v in found.items()], QUANTILES)
