"""The four stages chained: clean -> eda -> preprocess -> load.

Each stage takes DataFrames and returns DataFrames; nothing is handed over
through local files. :func:`run_all` writes every output under one folder
(on a cluster: a shared path).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import config as C
from tablewright.config import PrepConfig
from tablewright.functions.names import col
from tablewright.operators import categories as cat
from tablewright.operators import features as FT
from tablewright.operators import lists as L
from tablewright.operators import numeric as N
from tablewright.operators.profile import detect_types, null_profile
from tablewright.plans import derived
from tablewright.plans.clean import Cleaned, clean
from tablewright.sinks.files import write_metadata, write_table
from tablewright.sinks.messages import write_messages


def column_report(spark: SparkSession, folder: str, cfg: PrepConfig = PrepConfig()) -> DataFrame:
    """Per column of the gapped lineitem table: null share, drop decision and
    semantic type (null for dropped columns)."""
    g = derived.lineitem_with_gaps(spark, folder)
    profile = null_profile(g.drop("row_id"), cfg.null_threshold)
    kept = [r["column"] for r in profile.where(~F.col("dropped")).select("column").collect()]
    types = detect_types(g, kept, order_cols=["row_id"], sample_rows=cfg.type_sample_rows,
                         no_list=cfg.no_list,
                         numeric_categorical_threshold=cfg.numeric_categorical_threshold,
                         dense_id=True)
    return (profile.join(F.broadcast(types.drop("position")), "column", "left")
            .select("column", "position", "null_count", "row_count", "null_ratio", "dropped", "type", "hint")
            .orderBy("position"))


# --- eda ---------------------------------------------------------------------

@dataclass
class Eda:
    summary: DataFrame
    top_categories: DataFrame
    outliers: DataFrame
    box: DataFrame
    histogram: DataFrame
    kde: DataFrame
    pearson: DataFrame | None
    scatter: DataFrame | None
    lists: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    log_transformed: dict[str, float] = field(default_factory=dict)


def summary_stats(cleaned: Cleaned) -> DataFrame:
    """``(column, type, statistic, value)``: count/min/max/mean for numeric
    columns, count/num_unique_values for category-like ones and
    count (0)/total_items_parsed/num_unique_elements for list columns."""
    spark = cleaned.table.sparkSession
    numeric = cleaned.columns_of(C.NUMERIC)
    category = cleaned.columns_of(*C.CATEGORY_LIKE)
    parts = []

    def melt(df, stats):
        cells = [F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value")) for s in stats]
        return df.select("column", F.inline(F.array(*cells)))

    if numeric:
        parts.append(melt(N.numeric_summary(cleaned.table, numeric), ["count", "min", "max", "mean"]))
    if category:
        codes = cat.value_counts(cleaned.table, category)
        parts.append(melt(cat.category_summary(codes), ["count", "num_unique_values"]))
    for c, side in cleaned.side_tables.items():
        if cleaned.type_of[c] != C.LIST_JSON:          # the items of a dict column are not summarised
            parts.append(spark.createDataFrame([(c, "count", 0.0)], "column string, statistic string, value double"))
            continue
        counts = L.item_counts(L.row_item_sets_from_side(side))
        summary = L.list_summary(c, counts).withColumn("count", F.lit(0))
        parts.append(melt(summary, ["count", "total_items_parsed", "num_unique_elements"]))
    if not parts:
        return spark.createDataFrame([], "column string, type string, statistic string, value double")
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    types = spark.createDataFrame(list(cleaned.type_of.items()), "column string, type string")
    return F.broadcast(types).join(stats, "column").select("column", "type", "statistic", "value")


def eda(cleaned: Cleaned, cfg: PrepConfig = PrepConfig(), pearson_rows: int | None = None) -> Eda:
    t = cleaned.table
    numeric = cleaned.columns_of(C.NUMERIC)
    category = cleaned.columns_of(*C.CATEGORY_LIKE)

    codes = cat.value_counts(t, category)
    top = cat.top_categories(codes, cfg.top_n_categories)
    # top holds at most top_n_categories rows per column: it is the side to
    # broadcast; the dictionary is scanned once.
    labels = cleaned.dictionary.select("column", F.col("code").cast("string").alias("value"),
                                       F.col("value").alias("label"))
    # A numeric category is shown as its code.
    labels = labels.where(F.col("column").isin(cleaned.columns_of(C.CATEGORICAL, C.BOOLEAN)))
    found = labels.join(F.broadcast(top.select("column", "value")), ["column", "value"])
    decoded = top.join(F.broadcast(found), ["column", "value"], "left").withColumn("label", F.coalesce("label", "value"))

    plot, mins = N.plot_values(t, numeric, cfg.skew_log_threshold)
    pearson = scatter = None
    if len(numeric) >= 2:
        dense = cfg.dense_row_id
        sample = t if pearson_rows is None else N.head(t, [cleaned.id_col], pearson_rows, dense)
        pearson = N.pearson(sample, numeric)
        scatter = N.scatter_points(N.head(t, [cleaned.id_col], cfg.scatter_sample_rows, dense),
                                   numeric, cleaned.id_col)

    lists = {}
    for c, side in cleaned.side_tables.items():
        if cleaned.type_of[c] != C.LIST_JSON:
            continue
        sets = L.row_item_sets_from_side(side)
        counts = L.item_counts(sets)
        top_items = L.top_items(counts, cfg.top_n_cooccurrence)
        pairs = L.pair_counts(sets, top_items)
        lists[c] = {"item_counts": counts, "pair_counts": pairs,
                    "cooccurrence": L.cooccurrence_matrix(counts, pairs, top_items)}

    ranks = N.quartile_ranks(t, numeric)         # one search for outliers and boxes
    return Eda(summary=summary_stats(cleaned), top_categories=decoded,
               outliers=N.iqr_outliers(t, numeric, ranks=ranks),
               box=N.box_stats(plot, numeric, ranks=N.plotted_ranks(ranks, mins)),
               histogram=N.histogram(plot, numeric, cfg.histogram_bins),
               kde=N.kde(plot, numeric, cfg.kde_points, cfg.kde_bandwidth),
               pearson=pearson, scatter=scatter, lists=lists, log_transformed=mins)


# --- preprocessing -----------------------------------------------------------

@dataclass
class Prepared:
    features: DataFrame
    routes: DataFrame
    scaler: DataFrame
    ohe_mappings: DataFrame
    pca_variance: DataFrame | None
    pca: DataFrame | None
    loadings: object = None


def routes_of(cleaned: Cleaned, cfg: PrepConfig = PrepConfig()) -> list[tuple[str, str, int]]:
    """How each column is prepared, by its type and categories; nothing is fitted."""
    sizes = {r["column"]: int(r["n"]) for r in
             cleaned.dictionary.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return FT.feature_routes(cleaned.type_of, sizes, cfg.ohe_max_cardinality)


def route_table(spark: SparkSession, routes) -> DataFrame:
    return spark.createDataFrame([(c, r, n, i) for i, (c, r, n) in enumerate(routes)],
                                 "column string, route string, cardinality long, position int")


def preprocess(cleaned: Cleaned, cfg: PrepConfig = PrepConfig(), remove_outliers: bool = False) -> Prepared:
    spark = cleaned.table.sparkSession
    t = cleaned.table
    routes = routes_of(cleaned, cfg)
    numeric = [c for c, r, _ in routes if r == "numeric"]
    ohe = [c for c, r, _ in routes if r == "one_hot"]
    label = [c for c, r, _ in routes if r == "label"]
    if remove_outliers and numeric:
        t = N.remove_outliers(t, numeric)

    scaler = FT.scaler_fit(t, numeric) if numeric else spark.createDataFrame(
        [], "column string, mean double, std double")
    params = {r["column"]: (r["mean"], r["std"]) for r in scaler.collect()}
    scaled = FT.standardize(t, params)

    cats = {}
    if ohe:
        rows = cleaned.dictionary.where(F.col("column").isin(ohe)).collect()  # <= ohe_max per column
        for c in ohe:
            cats[c] = sorted([(r["code"], r["value"]) for r in rows if r["column"] == c], key=lambda x: x[1])
    # One projection: standardised numbers, indicators, label codes.
    features = scaled.select(col(cleaned.id_col), *[col(c) for c in numeric],
                             *FT.all_indicators({c: cats[c] for c in ohe}, [cleaned.id_col, *numeric, *label]),
                             *[col(c) for c in label])
    route_df = route_table(spark, routes)
    ohe_df = spark.createDataFrame([(c, [v for _, v in cats[c]]) for c in ohe],
                                   "column string, categories array<string>")
    pca_var = pca = loadings = None
    if numeric:
        loadings, ratios = FT.pca_fit(scaled, numeric)
        pca_var = FT.pca_variance(spark, ratios)
        pca = FT.pca_project(scaled, numeric, loadings, keep=[cleaned.id_col])
    return Prepared(features=features, routes=route_df, scaler=scaler, ohe_mappings=ohe_df,
                    pca_variance=pca_var, pca=pca, loadings=loadings)


# --- everything ----------------------------------------------------------------

def run_all(df: DataFrame, out: str, id_col: str = "row_id", cfg: PrepConfig = PrepConfig(),
            sink_format: str = "json", remove_outliers: bool = False) -> dict:
    """Run every stage on ``df`` (with a unique ``id_col``) and write the
    outputs under ``out``. Messages go to ``sink_format`` (``kafka`` for a
    broker, a file format otherwise)."""
    spark, out = df.sparkSession, out.rstrip("/")

    def again(table: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
        """Written once; the next stage reads it instead of the plan behind it."""
        write_table(table, path, fmt)
        return spark.read.format(fmt).schema(table.schema).load(path)

    cl = clean(again(df, f"{out}/raw"), id_col, cfg)
    cl = replace(cl, table=again(cl.table, f"{out}/clean"),
                 side_tables={c: again(side, f"{out}/lists/{c}", "json") for c, side in cl.side_tables.items()})
    write_metadata(cl.types, f"{out}/meta/types")
    write_metadata(cl.fill_values, f"{out}/meta/fill_values")
    write_table(cl.dictionary, f"{out}/meta/encodings", fmt="json")  # grows with the data
    write_metadata(cl.profile, f"{out}/meta/null_profile")

    ed = eda(cl, cfg)
    write_metadata(ed.summary, f"{out}/eda/summary_stats")
    write_metadata(ed.top_categories, f"{out}/eda/top_categories")
    write_metadata(ed.outliers, f"{out}/eda/outliers")
    write_metadata(ed.box, f"{out}/eda/box")
    write_metadata(ed.histogram, f"{out}/eda/histogram")
    write_metadata(ed.kde, f"{out}/eda/kde")
    if ed.pearson is not None:
        write_metadata(ed.pearson, f"{out}/eda/pearson")
        write_table(ed.scatter, f"{out}/eda/scatter")
    for c, parts in ed.lists.items():
        write_metadata(parts["cooccurrence"], f"{out}/eda/cooccurrence/{c}")

    pr = preprocess(cl, cfg, remove_outliers)
    write_table(pr.features, f"{out}/preprocessed")
    if pr.pca is not None:
        write_table(pr.pca, f"{out}/pca")
    save_params(pr, out)

    features = spark.read.parquet(f"{out}/preprocessed")
    if sink_format == "kafka":
        write_messages(features, "kafka")
    else:
        write_messages(features, sink_format, f"{out}/messages")
    return {"clean": cl, "eda": ed, "prepared": pr}


def save_params(pr: Prepared, out: str) -> None:
    """Write the fitted preprocessing parameters under ``out/meta``: routes,
    scaler, one-hot mappings, PCA variance and loadings (a few rows per
    column each). The category dictionary is written by the clean stage."""
    out = out.rstrip("/")
    write_metadata(pr.routes, f"{out}/meta/routes")
    write_metadata(pr.scaler, f"{out}/meta/scaler")
    write_metadata(pr.ohe_mappings, f"{out}/meta/ohe_mappings")
    if pr.pca is not None:
        write_metadata(pr.pca_variance, f"{out}/meta/pca_explained_variance")
        numeric = [r["column"] for r in pr.scaler.select("column").collect()]
        spark = pr.routes.sparkSession
        write_metadata(FT.loadings_table(spark, numeric, pr.loadings), f"{out}/meta/pca_loadings")


def apply_saved(df: DataFrame, out: str, id_col: str = "row_id") -> tuple[DataFrame, DataFrame | None]:
    """Re-apply the parameters :func:`run_all` wrote under ``out`` to a new
    cleaned table: standardise, one-hot, keep label codes, and project on the
    saved PCA loadings. Columns that ``df`` lacks are left out, and without one of
    its columns there is no projection. Returns ``(features, pca)``."""
    spark = df.sparkSession
    out = out.rstrip("/")
    routes = [r for r in spark.read.json(f"{out}/meta/routes").orderBy("position").collect() if r["column"] in df.columns]
    params = {c: p for c, p in FT.scaler_from(spark.read.json(f"{out}/meta/scaler")).items() if c in df.columns}
    cats = FT.categories_from(spark.read.json(f"{out}/meta/ohe_mappings"), spark.read.json(f"{out}/meta/encodings"))
    numeric = [r["column"] for r in routes if r["route"] == "numeric"]
    ohe = [r["column"] for r in routes if r["route"] == "one_hot"]
    label = [r["column"] for r in routes if r["route"] == "label"]
    scaled = FT.standardize(df, params)
    features = scaled.select(col(id_col), *[col(c) for c in numeric],
                             *FT.all_indicators({c: cats.get(c, []) for c in ohe}, [id_col, *numeric, *label]),
                             *[col(c) for c in label])
    pca = None
    if numeric:
        cols, load = FT.loadings_from(spark.read.json(f"{out}/meta/pca_loadings"))
        if set(cols) <= set(df.columns):
            pca = FT.pca_project(scaled, cols, load, keep=[id_col])
    return features, pca
