"""Category statistics and label dictionaries.

Everything starts from ``(column, value, count)`` — one ``groupBy`` whose
partial aggregation collapses repeated values inside each partition, so hot
values cost one row per partition. Modes and summaries are further
aggregates over that table; dictionary codes are positions in value order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.functions.names import col
from tablewright.functions.text import value_text
from tablewright.operators.ordinal import positions


#: A value of this share of its column's rows is frequent.
FREQUENT = 256
#: Bytes of a dictionary that may stand in a plan as a literal, and of an entry besides its text.
INLINE_BYTES, ENTRY_BYTES = 65_536, 40
#: Places over which rows that need no match are spread.
SPREAD = 4_096


def category_long(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """``(*extra, column, value)`` with the category key text of every
    non-null cell of ``cols``."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.struct(F.lit(c).alias("column"), value_text(col(c), schema[c]).alias("value"))
             for c in cols]
    return (df.select(*[col(e) for e in extra], F.inline(F.array(*cells)))
            .where(F.col("value").isNotNull()))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` over non-null values."""
    return category_long(df, cols).groupBy("column", "value").agg(F.count("*").alias("count"))


def modes(counts: DataFrame) -> DataFrame:
    """``(column, mode, count)``: most frequent value, ties to the smallest
    value. The greatest count of each column first (a hash aggregate of numbers,
    combined map-side), then the least of the few values that have it."""
    most = counts.groupBy("column").agg(F.max("count").alias("_most"))        # one row per column
    return _least_of(counts, most).select("column", F.col("_mode").alias("mode"), F.col("_most").alias("count"))


def _least_of(counts: DataFrame, most: DataFrame) -> DataFrame:
    """``most`` (column, _most and others) with ``_mode``, the least value of that count."""
    top = counts.join(F.broadcast(most.select("column", "_most")), "column").where(F.col("count") == F.col("_most"))
    return most.join(F.broadcast(top.groupBy("column").agg(F.min("value").alias("_mode"))), "column")


def category_summary(counts: DataFrame) -> DataFrame:
    """``(column, count, num_unique_values)``."""
    return counts.groupBy("column").agg(F.sum("count").cast("long").alias("count"),
                                        F.count("*").cast("long").alias("num_unique_values"))


def label_dictionary(counts: DataFrame, distinct_limit: int = 1_000_000,
                     sizes: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """``(column, value, code)``: codes 0.. in value (code point) order.

    Columns with at most ``distinct_limit`` values are numbered with a window
    per column; bigger ones by the distributed position helper, so no single
    task sorts a huge dictionary."""
    distinct = counts.select("column", "value")
    if sizes is None:
        sizes = _dictionary_sizes(distinct)
    small = [c for c, (n, _) in sizes.items() if n <= distinct_limit]
    large = [c for c, (n, _) in sizes.items() if n > distinct_limit]
    parts = []
    if small:
        w = Window.partitionBy("column").orderBy("value")
        parts.append(distinct.where(F.col("column").isin(small))
                     .withColumn("code", (F.row_number().over(w) - 1).cast("long")))
    if large:
        parts.append(positions(distinct.where(F.col("column").isin(large)), ["value"], ["column"], "code"))
    if not parts:
        return counts.sparkSession.createDataFrame([], "column string, value string, code long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_categories(counts: DataFrame, n: int = C.TOP_N_CATEGORIES, salts: int | None = None) -> DataFrame:
    """``(column, rank, value, count, more_exist)``: the ``n`` most frequent
    values per column (count desc, value asc), flagging truncated columns.

    Two rounds of top-k: first per (column, hash salt of the value), so no
    task sorts all values of a high-cardinality column, then per column over
    at most ``salts * n`` candidates. The global top ``n`` is always among
    the per-salt top ``n``, so the result is exact."""
    salts = salts or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("count"), F.asc("value")]
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64("value"), F.lit(salts)))
    w1 = Window.partitionBy("column", "_salt").orderBy(*order)
    candidates = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n)
    w2 = Window.partitionBy("column").orderBy(*order)
    ranked = candidates.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n)
    sizes = counts.groupBy("column").agg(F.count("*").alias("_n"))  # one row per column
    return (ranked.join(F.broadcast(sizes), "column")
            .select("column", F.col("rank").cast("int").alias("rank"), "value",
                    F.col("count").cast("long").alias("count"),
                    (F.col("_n") > n).alias("more_exist")))


def _dictionary_sizes(dictionary: DataFrame) -> dict[str, tuple[int, int]]:
    """Entries and bytes of each column's dictionary."""
    rows = dictionary.groupBy("column").agg(F.count("*").alias("n"), F.sum(ENTRY_BYTES + F.octet_length("value")).alias("b")).collect()
    return {r["column"]: (int(r["n"]), int(r["b"])) for r in rows}


def _map_literal(pairs) -> F.Column:
    if not pairs:
        return None
    keys = F.array(*[F.lit(k) for k, _ in pairs])
    vals = F.array(*[F.lit(v) for _, v in pairs])
    return F.map_from_arrays(keys, vals)


def category_stats(counts: DataFrame) -> tuple[dict[str, str], dict[str, tuple[int, int]]]:
    """Modes, and entries and bytes of the dictionary, per column in one small aggregate."""
    sizes = counts.groupBy("column").agg(F.max("count").alias("_most"), F.count("*").alias("_n"),
                                         F.sum(ENTRY_BYTES + F.octet_length("value")).alias("_bytes"))
    rows = _least_of(counts, sizes).collect()
    return ({r["column"]: r["_mode"] for r in rows}, {r["column"]: (int(r["_n"]), int(r["_bytes"])) for r in rows})


def frequent_values(counts: DataFrame) -> DataFrame:
    """``(column, value)`` of the values that hold ``1 / FREQUENT`` of their column's
    rows or more: at most ``FREQUENT`` for each column, whatever the data."""
    totals = counts.groupBy("column").agg(F.sum("count").alias("_total"))      # one row per column
    return counts.join(F.broadcast(totals), "column").where(F.col("count") * FREQUENT >= F.col("_total")).select("column", "value")


def _short(text: F.Column) -> F.Column:
    """A text itself, or the digest of a long one: a map literal stays small."""
    return F.when(F.octet_length(text) <= 64, text).otherwise(F.concat(F.lit("\0"), F.sha2(text, 256)))


def _lookup(df: DataFrame, cols: Sequence[str], dictionary: DataFrame, key: str, val: str,
            key_expr, out_cast: str, inline_limit: int, broadcast_bytes: int,
            sizes: Mapping[str, tuple[int, int]] | None, counts: DataFrame | None, fill: Mapping[str, str] | None) -> DataFrame:
    """Small dictionaries, by entries and bytes, become map literals. Larger ones
    are joined: broadcast if their counted bytes allow it; otherwise frequent keys
    are found in a map literal, too, and only the rest meets the dictionary in a
    shuffle. Rows that need no match (null or frequent keys) are spread over the
    shuffle by their content, so that no task gets them all."""
    if sizes is None:
        sizes = _dictionary_sizes(dictionary.where(F.col("column").isin(list(cols))))
    inline = [c for c in cols if sizes.get(c, (0, 0))[0] <= inline_limit and sizes.get(c, (0, 0))[1] <= INLINE_BYTES]
    joined = [c for c in cols if c not in inline]
    entries = dictionary.select("column", F.col(key).alias("_k"), F.col(val).alias("_v"), F.col("value").alias("_text"))
    maps: dict[str, list] = {c: [] for c in inline}
    for r in entries.where(F.col("column").isin(inline)).collect() if inline else []:
        maps[r["column"]].append((r["_k"], r["_v"]))
    frequent: dict[str, list] = {c: [] for c in joined}
    shuffled = [c for c in joined if sizes[c][1] > broadcast_bytes]
    if shuffled and counts is not None:
        hot = frequent_values(counts.where(F.col("column").isin(shuffled))).select("column", F.col("value").alias("_text"))
        short = _short(F.col("_k")) if key == "value" else F.col("_k")
        for r in entries.join(F.broadcast(hot), ["column", "_text"]).select("column", short.alias("_k"), "_v").collect():
            frequent[r["column"]].append((r["_k"], r["_v"]))
    filled: dict[str, object] = {}
    if fill:
        wanted = df.sparkSession.createDataFrame([(c, fill[c]) for c in cols if c in fill], "column string, _text string")
        # One row per column.
        filled = {r["column"]: r["_v"] for r in entries.join(F.broadcast(wanted), ["column", "_text"]).select("column", "_v").collect()}
    out = df
    for c in cols:
        k = key_expr(c)

        def done(found: F.Column, k=k, c=c) -> F.Column:
            return F.when(k.isNull(), F.lit(filled[c]).cast(out_cast)).otherwise(found) if c in filled else found

        if c in maps:
            m = _map_literal(maps[c])
            out = out.withColumn(c, done(F.lit(None).cast(out_cast) if m is None else F.try_element_at(m, k).cast(out_cast)))
            continue
        side = entries.where(F.col("column") == c).select(F.col("_k"), F.col("_v").cast(out_cast).alias("_v"))
        if c not in shuffled:
            out = out.withColumn("_k", k).join(F.broadcast(side), "_k", "left").withColumn(c, done(F.col("_v"), F.col("_k"))).drop("_k", "_v")
            continue
        m = _map_literal(frequent[c])
        hit = F.lit(None).cast(out_cast) if m is None else F.try_element_at(m, _short(k) if key == "value" else k).cast(out_cast)
        spread = F.pmod(F.xxhash64(*[col(x) for x in out.columns]), F.lit(SPREAD)) + 1
        # One key of both: a constant salt by itself would be optimised away.
        salted = lambda x, salt: F.struct(x.alias("k"), salt.cast("long").alias("salt"))
        tmp = out.withColumn("_hit", hit).withColumn("_null", k.isNull()).withColumn("_at", F.when(
            F.col("_null") | F.col("_hit").isNotNull(), salted(F.lit(None).cast(side.schema["_k"].dataType), spread)).otherwise(salted(k, F.lit(0))))
        found = tmp.join(side.select(salted(F.col("_k"), F.lit(0)).alias("_at"), "_v"), "_at", "left")
        value = F.coalesce("_hit", "_v")
        if c in filled:
            value = F.when(F.col("_null"), F.lit(filled[c]).cast(out_cast)).otherwise(value)
        out = found.withColumn(c, value).select(*[col(x) for x in out.columns])
    return out.select(*[col(x) for x in df.columns])


def label_encode(df: DataFrame, cols: Sequence[str], dictionary: DataFrame,
                 inline_limit: int = C.INLINE_DICTIONARY_LIMIT, broadcast_bytes: int = C.BROADCAST_BYTES,
                 sizes: Mapping[str, tuple[int, int]] | None = None, counts: DataFrame | None = None,
                 fill: Mapping[str, str] | None = None) -> DataFrame:
    """Replace each column in ``cols`` by its code (BIGINT; null when the value
    is not in the dictionary). Missing cells get the code of the column's value in
    ``fill``; they are coded before they are filled, so they never make that
    value the hot key of a join. ``counts`` (value counts) names frequent values."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    return _lookup(df, cols, dictionary, "value", "code",
                   lambda c: value_text(col(c), schema[c]), "bigint", inline_limit, broadcast_bytes, sizes, counts, fill)


def label_decode(df: DataFrame, cols: Sequence[str], dictionary: DataFrame,
                 inline_limit: int = C.INLINE_DICTIONARY_LIMIT, broadcast_bytes: int = C.BROADCAST_BYTES,
                 sizes: Mapping[str, tuple[int, int]] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Inverse of :func:`label_encode`: codes back to the original text."""
    return _lookup(df, cols, dictionary, "code", "value",
                   lambda c: col(c).cast("long"), "string", inline_limit, broadcast_bytes, sizes, counts, None)
