"""Clean stage: drop sparse columns, type the rest, impute, label-encode and
move list-valued columns to side tables.

Spark jobs, in order: one null-count aggregate; one typing aggregate over the
type sample; exact medians; one (column, value) count aggregate (written to
the checkpoint folder, it feeds modes, summaries and the dictionary); the dictionary numbering. The
main table itself is a single projection over the input (plus a join only for
dictionaries too large to inline).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.config import PrepConfig
from tablewright.functions.names import col
from tablewright.functions.text import is_numeric_type, number_or_truth_text, try_number, value_text
from tablewright.operators import categories as cat
from tablewright.operators.lists import explode_list
from tablewright.operators.profile import detect_types, null_profile
from tablewright.operators.quantiles import quantile_values
from tablewright.session import materialize


@dataclass
class Cleaned:
    table: DataFrame
    profile: DataFrame
    types: DataFrame
    type_of: dict[str, str]
    hints: dict[str, str]
    fill_values: DataFrame
    counts: DataFrame
    dictionary: DataFrame
    side_tables: dict[str, DataFrame] = field(default_factory=dict)
    id_col: str = "row_id"

    def columns_of(self, *kinds: str) -> list[str]:
        return [c for c, t in self.type_of.items() if t in kinds]


def medians(df: DataFrame, cols) -> DataFrame:
    """``(column, median)``: exact median of the numeric values; 0.0 for a
    column without values."""
    found = quantile_values(df, cols, [0.5])
    return df.sparkSession.createDataFrame([(c, found.get((c, 0.5), 0.0)) for c in cols], "column string, median double")


def fill_table(df: DataFrame, type_of: dict, med: dict, mode: dict) -> DataFrame:
    """``(column, type, fill_value)`` as text: median for numeric columns,
    mode for category-like ones, empty text otherwise."""
    rows = []
    for c, t in type_of.items():
        if t == C.NUMERIC:
            rows.append((c, t, str(med.get(c, 0.0))))
        elif t in C.CATEGORY_LIKE:
            rows.append((c, t, mode.get(c, "")))
        else:
            rows.append((c, t, ""))
    return df.sparkSession.createDataFrame(rows, "column string, type string, fill_value string")


def impute(df: DataFrame, numeric_fill: dict, category_fill: dict) -> DataFrame:
    """Numeric columns -> DOUBLE with unparseable/missing values set to the
    fill value; category-like columns -> key text with missing set to the
    mode. A single projection."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in numeric_fill:
            out.append(F.coalesce(try_number(col(c), schema[c]), F.lit(float(numeric_fill[c]))).alias(c))
        elif c in category_fill:
            out.append(F.coalesce(value_text(col(c), schema[c]), F.lit(category_fill[c])).alias(c))
        else:
            out.append(col(c))
    return df.select(*out)


def clean(df: DataFrame, id_col: str = "row_id", cfg: PrepConfig = PrepConfig()) -> Cleaned:
    """Run the clean stage on ``df``, which must carry a unique ``id_col``;
    with ``cfg.dense_row_id`` (default) it is a dense 0-based row id as made
    by :func:`tablewright.operators.ordinal.assign_row_id` or
    :func:`tablewright.sources.csv.read_raw_csv`."""
    data_cols = [c for c in df.columns if c != id_col]
    profile = null_profile(df, cfg.null_threshold, data_cols)
    prow = profile.select("column", "position", "dropped").collect()  # one row per column
    kept = [r["column"] for r in sorted(prow, key=lambda r: r["position"]) if not r["dropped"]]
    types = detect_types(df, kept, order_cols=[id_col], sample_rows=cfg.type_sample_rows,
                         no_list=cfg.no_list,
                         numeric_categorical_threshold=cfg.numeric_categorical_threshold,
                         dense_id=cfg.dense_row_id)
    trows = types.collect()
    type_of = {r["column"]: r["type"] for r in sorted(trows, key=lambda r: r["position"])}
    hints = {r["column"]: r["hint"] for r in trows if r["hint"]}

    numeric = [c for c, t in type_of.items() if t == C.NUMERIC]
    category = [c for c, t in type_of.items() if t in C.CATEGORY_LIKE]
    listy = [c for c, t in type_of.items() if t in C.LIST_LIKE]

    # Number-like text typed numeric_categorical is keyed on its number
    # ("3", "3.0" and " 3" are one category, printed "3").
    schema = {f.name: f.dataType for f in df.schema.fields}
    for c in category:
        if type_of[c] == C.NUMERIC_CATEGORICAL and not is_numeric_type(schema[c]):
            df = df.withColumn(c, number_or_truth_text(col(c), schema[c]))

    found = quantile_values(df, numeric, [0.5])
    med = {c: found.get((c, 0.5), 0.0) for c in numeric}

    spark = df.sparkSession
    if category:
        counts = materialize(cat.value_counts(df, category), "value-counts")
    else:
        counts = spark.createDataFrame([], "column string, value string, count long")
    mode, sizes = cat.category_stats(counts)
    category_fill = {c: mode.get(c, "") for c in category}
    dictionary = cat.label_dictionary(counts, cfg.single_task_distinct_limit, sizes=sizes)
    if category:
        dictionary = materialize(dictionary, "dictionary")

    main = df.select(col(id_col), *[col(c) for c in type_of if c not in listy])
    main = impute(main, {c: med.get(c, 0.0) for c in numeric}, {})
    main = cat.label_encode(main, category, dictionary, cfg.inline_dictionary_limit,
                            cfg.broadcast_bytes, sizes=sizes, counts=counts, fill=category_fill)

    side = {c: explode_list(df, c, hints.get(c), id_col) for c in listy}
    return Cleaned(table=main, profile=profile, types=types, type_of=type_of, hints=hints,
                   fill_values=fill_table(df, type_of, med, mode), counts=counts,
                   dictionary=dictionary, side_tables=side, id_col=id_col)
