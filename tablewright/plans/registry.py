"""Registered queries: one callable ``(spark, folder) -> DataFrame`` per
operator, each over whole benchmark tables (or columns derived from them by
value rules, see :mod:`tablewright.plans.derived`).

Floating outputs are rounded (6 decimals, densities 12) so that results are
comparable across engines whose summation order differs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import config as C
from tablewright.config import PrepConfig
from tablewright.functions.names import col
from tablewright.functions.text import try_number
from tablewright.operators import categories as cat
from tablewright.operators import lists as L
from tablewright.operators.lists import explode_list
from tablewright.operators import numeric as N
from tablewright.operators.profile import detect_types, null_profile, type_histogram
from tablewright.operators import features as FT
from tablewright.operators import moments as M
from tablewright.operators import profile as PR
from tablewright.operators.ordinal import assign_row_id
from tablewright.plans import derived, stages
from tablewright.plans.clean import clean, impute, medians
from tablewright.session import scratch_path
from tablewright.sinks.delivery import deliver, file_transport, totals
from tablewright.sinks.messages import to_messages
from tablewright.sinks.files import write_table
from tablewright.sources.side_tables import read_side_table, write_side_table
from tablewright.sources.csv import read_raw_csv, write_csv
from tablewright.sources.tables import spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WHOLE = PrepConfig(type_sample_rows=None)


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_NUMERIC = ["value", "value_sq", "user_id"]


# --- profile ---------------------------------------------------------------

@query("null_profile")
def q_null_profile(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder, with_row_id=False).drop("row_id")
    return rounded(null_profile(g, C.NULL_THRESHOLD))


TYPE_TABLES = ("events", "orders", "customer", "part")


# Whole-table typing is CPU bound (regular expressions per cell): the raw
# scans are spread over the task slots first (a no-op for a scan that already
# has more partitions than slots).

@query("column_types")
def q_column_types(spark, folder):
    parts = []
    for name in TYPE_TABLES:
        t = spread(table(spark, folder, name))
        parts.append(detect_types(t, sample_rows=None).withColumn("table_name", F.lit(name)))
    g = spread(derived.lineitem_with_gaps(spark, folder, with_row_id=False).drop("row_id"))
    parts.append(detect_types(g, sample_rows=None).withColumn("table_name", F.lit("lineitem_gaps")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("type_histogram")
def q_type_histogram(spark, folder):
    g = spread(derived.lineitem_with_gaps(spark, folder, with_row_id=False).drop("row_id"))
    return type_histogram(detect_types(g, sample_rows=None))


@query("coerce_numeric")
def q_coerce_numeric(spark, folder):
    e = table(spark, folder, "events")
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))
    t = e.select("event_id", raw.alias("raw"))
    return t.select("event_id", "raw", try_number(F.col("raw"), T.StringType()).alias("number"))


@query("incremental_profile")
def q_incremental_profile(spark, folder):
    """Types and null shares of a table that arrives in two parts: each is scanned
    once and adds its state; nothing is read again."""
    g = derived.lineitem_with_gaps(spark, folder, with_row_id=False).drop("row_id")
    path = scratch_path(spark, "profile-state")
    for part in (0, 1):
        PR.add_profile(g.where(F.col("l_orderkey") % 2 == part), path)
    state = PR.stored_profile(spark, path)
    types = PR.types_of(state).drop("position")          # a row for each column
    return PR.nulls_of(state).join(F.broadcast(types), "column").select(
        "column", "position", "null_count", "row_count", "type", "hint")


# --- clean statistics ------------------------------------------------------

@query("medians")
def q_medians(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder, with_row_id=False)
    return rounded(medians(g, ["l_orderkey", "l_quantity", "l_extendedprice", "l_tax"]))


@query("value_counts")
def q_value_counts(spark, folder):
    li = table(spark, folder, "lineitem")
    return cat.value_counts(li, ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"])


@query("value_counts_big_ids")
def q_value_counts_big_ids(spark, folder):
    # Ids above 2^53, which DOUBLE cannot tell apart.
    e = table(spark, folder, "events").select((F.col("user_id") + F.lit(2**53)).alias("big_id"))
    return cat.value_counts(e, ["big_id"])


@query("modes")
def q_modes(spark, folder):
    o = table(spark, folder, "orders")
    return cat.modes(cat.value_counts(o, ["o_orderstatus", "o_orderpriority", "o_custkey"]))


@query("impute")
def q_impute(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder)
    med = {r["column"]: r["median"] for r in medians(g, ["l_quantity"]).collect()}
    mode = {r["column"]: r["mode"] for r in
            cat.modes(cat.value_counts(g, ["l_tax", "l_returnflag", "l_open"])).collect()}
    t = g.select("row_id", "l_quantity", "l_tax", "l_returnflag", "l_open")
    return rounded(impute(t, med, mode))


@query("table_roundtrip")
def q_table_roundtrip(spark, folder):
    """The imputed table written as parquet partitioned by ``l_open`` and
    read back."""
    path = scratch_path(spark, "imputed")
    write_table(q_impute(spark, folder), path, partition_by=["l_open"])
    return spark.read.parquet(path).select("row_id", "l_quantity", "l_tax", "l_returnflag", "l_open")


PART_CATEGORIES = ["p_brand", "p_type", "p_name", "p_size"]


def _part_dictionary(spark, folder):
    p = table(spark, folder, "part")
    return p, cat.label_dictionary(cat.value_counts(p, PART_CATEGORIES))


@query("label_dictionary")
def q_label_dictionary(spark, folder):
    return _part_dictionary(spark, folder)[1]


@query("label_encode")
def q_label_encode(spark, folder):
    p, d = _part_dictionary(spark, folder)
    return cat.label_encode(p.select("p_partkey", *PART_CATEGORIES), PART_CATEGORIES, d)


@query("label_encode_tail")
def q_label_encode_tail(spark, folder):
    """The same codes where no dictionary fits a literal or a broadcast."""
    p, d = _part_dictionary(spark, folder)
    counts = cat.value_counts(p, PART_CATEGORIES)
    return cat.label_encode(p.select("p_partkey", *PART_CATEGORIES), PART_CATEGORIES, d, inline_limit=0, broadcast_bytes=0, counts=counts)


@query("label_decode")
def q_label_decode(spark, folder):
    p, d = _part_dictionary(spark, folder)
    enc = cat.label_encode(p.select("p_partkey", *PART_CATEGORIES), PART_CATEGORIES, d)
    return cat.label_decode(enc, PART_CATEGORIES, d)


@query("top_categories")
def q_top_categories(spark, folder):
    p = table(spark, folder, "part")
    return cat.top_categories(cat.value_counts(p, PART_CATEGORIES), C.TOP_N_CATEGORIES)


@query("categorical_summary")
def q_categorical_summary(spark, folder):
    o = table(spark, folder, "orders")
    return cat.category_summary(cat.value_counts(o, ["o_orderstatus", "o_orderpriority", "o_custkey"]))


@query("clean_table")
def q_clean_table(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder)
    return rounded(clean(g, "row_id", WHOLE).table)


@query("clean_dictionary")
def q_clean_dictionary(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder, with_row_id=False)
    return clean(g, "row_id", WHOLE).dictionary


# --- lists -----------------------------------------------------------------

@query("explode_csv_list")
def q_explode_csv_list(spark, folder):
    d = table(spark, folder, "documents")
    return L.explode_list(d, "text", C.HINT_CSV, "doc_id")


@query("explode_json_list")
def q_explode_json_list(spark, folder):
    p = derived.part_with_tags(spark, folder)
    return L.explode_list(p, "p_tags", C.HINT_JSON, "p_partkey")


@query("side_table_roundtrip")
def q_side_table_roundtrip(spark, folder):
    """Exploded tag lists written as JSON Lines and read back, together with a
    side table that was never written (reads as empty)."""
    p = derived.part_with_tags(spark, folder)
    path = scratch_path(spark, "part-tags")
    write_side_table(L.explode_list(p, "p_tags", C.HINT_JSON, "p_partkey"), path)
    missing = read_side_table(spark, scratch_path(spark, "never-written"))
    return read_side_table(spark, path).unionByName(missing)


@query("explode_dict")
def q_explode_dict(spark, folder):
    e = table(spark, folder, "events")
    return L.explode_list(e, "props", C.HINT_DICT, "event_id")


def _tag_sets(spark, folder):
    p = derived.part_with_tags(spark, folder)
    return L.row_item_sets(p, "p_tags", C.HINT_JSON)


@query("item_counts")
def q_item_counts(spark, folder):
    return L.item_counts(_tag_sets(spark, folder))


@query("top_pair_counts")
def q_pair_counts(spark, folder):
    sets = _tag_sets(spark, folder)
    top = L.top_items(L.item_counts(sets), C.TOP_N_COOCCURRENCE)
    return L.pair_counts(sets, top)


@query("cooccurrence_matrix")
def q_cooccurrence_matrix(spark, folder):
    sets = _tag_sets(spark, folder)
    counts = L.item_counts(sets)
    top = L.top_items(counts, C.TOP_N_COOCCURRENCE)
    return L.cooccurrence_matrix(counts, L.pair_counts(sets, top), top)


@query("list_summary")
def q_list_summary(spark, folder):
    tags = L.list_summary("p_tags", L.item_counts(_tag_sets(spark, folder)))
    d = table(spark, folder, "documents")
    text = L.list_summary("text", L.item_counts(L.row_item_sets(d, "text", C.HINT_CSV)))
    return tags.unionByName(text)


# --- numeric EDA -----------------------------------------------------------

@query("numeric_summary")
def q_numeric_summary(spark, folder):
    return rounded(N.numeric_summary(table(spark, folder, "lineitem"), LINEITEM_NUMERIC))


@query("iqr_outliers")
def q_iqr_outliers(spark, folder):
    e = derived.events_with_square(spark, folder)
    return rounded(N.iqr_outliers(e, EVENT_NUMERIC))


@query("remove_outliers")
def q_remove_outliers(spark, folder):
    e = derived.events_with_square(spark, folder)
    return rounded(N.remove_outliers(e, ["value", "value_sq"]).select("event_id", "value", "value_sq"))


@query("skewness_adjusted")
def q_skewness(spark, folder):
    e = derived.events_with_square(spark, folder)
    return rounded(N.skewness(e, EVENT_NUMERIC))


@query("log_transform_skewed")
def q_log_transform(spark, folder):
    e = derived.events_with_square(spark, folder).select("event_id", "value", "value_sq")
    plot, _ = N.plot_values(e, ["value", "value_sq"])
    return rounded(plot)


@query("box_stats")
def q_box_stats(spark, folder):
    e = derived.events_with_square(spark, folder).select("event_id", "value", "value_sq")
    plot, _ = N.plot_values(e, ["value", "value_sq"])
    return rounded(N.box_stats(plot, ["value", "value_sq"]))


@query("histogram50")
def q_histogram(spark, folder):
    li = table(spark, folder, "lineitem")
    return rounded(N.histogram(li, LINEITEM_NUMERIC, C.HISTOGRAM_BINS), overrides={"density": 12})


@query("kde200")
def q_kde(spark, folder):
    li = table(spark, folder, "lineitem")
    return rounded(N.kde(li, LINEITEM_NUMERIC, C.KDE_POINTS, C.KDE_BANDWIDTH), overrides={"density": 12})


@query("pearson_full")
def q_pearson_full(spark, folder):
    return rounded(N.pearson(table(spark, folder, "lineitem"), LINEITEM_NUMERIC), 9)


KEY = derived.LINEITEM_ORDER


@query("pearson_head")
def q_pearson_head(spark, folder):
    sample = N.head(table(spark, folder, "lineitem"), KEY, C.SCATTER_SAMPLE_ROWS)
    return rounded(N.pearson(sample, LINEITEM_NUMERIC), 9)


@query("head_sample")
def q_head_sample(spark, folder):
    li = table(spark, folder, "lineitem")
    out = N.head(li, KEY, C.SCATTER_SAMPLE_ROWS)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("scatter_points")
def q_scatter(spark, folder):
    sample = N.head(table(spark, folder, "lineitem"), KEY, C.SCATTER_SAMPLE_ROWS)
    pts = N.scatter_points(sample.withColumn("row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber")),
                           ["l_quantity", "l_extendedprice", "l_discount"], "row_key")
    return pts


# --- features ----------------------------------------------------------------

def _orders_clean(spark, folder):
    o = assign_row_id(table(spark, folder, "orders"), ["o_orderkey"])
    return clean(o, "row_id", WHOLE)


@query("feature_routing")
def q_feature_routing(spark, folder):
    # Routes follow from types and categories: no row ids, nothing fitted.
    o = table(spark, folder, "orders").withColumn("row_id", F.lit(None).cast("long"))
    return stages.route_table(spark, stages.routes_of(clean(o, "row_id", WHOLE), WHOLE))


@query("preprocessed")
def q_preprocessed(spark, folder):
    return rounded(stages.preprocess(_orders_clean(spark, folder), WHOLE).features)


@query("saved_features")
def q_saved_features(spark, folder):
    """Fit on orders, persist every parameter (dictionary, routes, scaler,
    one-hot mappings, PCA loadings), read them back and re-apply them to the
    cleaned table: the same features as ``preprocessed``."""
    cl = _orders_clean(spark, folder)
    out = scratch_path(spark, "orders-params")
    write_table(cl.dictionary, f"{out}/meta/encodings", fmt="json")
    stages.save_params(stages.preprocess(cl, WHOLE), out)
    features, _ = stages.apply_saved(cl.table, out)
    return rounded(features)


@query("one_hot")
def q_one_hot(spark, folder):
    o = table(spark, folder, "orders")
    cols = ["o_orderstatus", "o_orderpriority"]
    d = cat.label_dictionary(cat.value_counts(o, cols))
    coded = cat.label_encode(o.select("o_orderkey", *cols), cols, d)
    sizes = {r["column"]: r["count"] for r in d.groupBy("column").count().collect()}
    cols = [c for c in cols if sizes.get(c, 0) <= C.OHE_MAX_CARDINALITY]
    rows = d.where(F.col("column").isin(cols)).collect()  # at most ohe_max_cardinality entries per column
    cats = {c: sorted([(r["code"], r["value"]) for r in rows if r["column"] == c], key=lambda x: x[1])
            for c in cols}
    return FT.one_hot(coded, cats, keep=["o_orderkey"])


@query("scaler_params")
def q_scaler_params(spark, folder):
    return rounded(FT.scaler_fit(table(spark, folder, "lineitem"), LINEITEM_NUMERIC))


def _scaled_lineitem(spark, folder):
    li = table(spark, folder, "lineitem")
    params = {r["column"]: (r["mean"], r["std"]) for r in FT.scaler_fit(li, LINEITEM_NUMERIC).collect()}
    return FT.standardize(li.select("l_orderkey", "l_linenumber", *LINEITEM_NUMERIC), params)


@query("standardize")
def q_standardize(spark, folder):
    return rounded(_scaled_lineitem(spark, folder))


def _scaled_events(spark, folder):
    # Columns whose correlation matrix has well separated eigenvalues.
    e = derived.events_with_square(spark, folder).select("event_id", *EVENT_NUMERIC)
    return FT.standardize(e, FT.scaler_from(FT.scaler_fit(e, EVENT_NUMERIC)))


@query("pca_variance")
def q_pca_variance(spark, folder):
    scaled = _scaled_events(spark, folder)
    _, ratios = FT.pca_fit(scaled, EVENT_NUMERIC)
    return rounded(FT.pca_variance(spark, ratios))


@query("pca_project")
def q_pca_project(spark, folder):
    scaled = _scaled_events(spark, folder)
    loadings, _ = FT.pca_fit(scaled, EVENT_NUMERIC)
    return rounded(FT.pca_project(scaled, EVENT_NUMERIC, loadings, keep=["event_id"]))


WIDE_EVENTS = ["value", "value_sq", "value_cu", "user_id", "event_id"]


@query("pca_wide")
def q_pca_wide(spark, folder):
    """Variances and loadings of five columns, by power iteration over the table."""
    e = derived.events_with_square(spark, folder).withColumn("value_cu", F.col("value_sq") * F.col("value"))
    scaled = FT.standardize(e.select(*WIDE_EVENTS), FT.scaler_from(FT.scaler_fit(e, WIDE_EVENTS)))
    loadings, ratios = FT.pca_fit(scaled, WIDE_EVENTS)
    table_ = FT.loadings_table(spark, WIDE_EVENTS, loadings).join(F.broadcast(FT.pca_variance(spark, ratios)), "component")   # a few rows
    return rounded(table_.select("component", "column", "loading", "explained_variance_ratio"), 5)


@query("incremental_fit")
def q_incremental_fit(spark, folder):
    """Scaler parameters and correlations of a table that arrives in three parts:
    each is scanned once and adds its moments."""
    li = table(spark, folder, "lineitem")
    path = scratch_path(spark, "moments")
    for part in range(3):
        M.add_to_state(li.where(F.pmod("l_orderkey", F.lit(3)) == part), LINEITEM_NUMERIC, path)
    state = M.stored_state(spark, path)
    scaler = M.scaler_of(M.columns_of(state)).withColumnRenamed("column", "col_x")      # a row for each column
    return rounded(M.pearson_of(state).join(F.broadcast(scaler), "col_x"), 6)


def _clean_mixed(spark, folder):
    return clean(derived.part_mixed(spark, folder), "p_partkey", PrepConfig(dense_row_id=False))


@query("clean_mixed")
def q_clean_mixed(spark, folder):
    return rounded(_clean_mixed(spark, folder).table)


@query("clean_mixed_types")
def q_clean_mixed_types(spark, folder):
    return _clean_mixed(spark, folder).types


@query("clean_mixed_lists")
def q_clean_mixed_lists(spark, folder):
    sides = _clean_mixed(spark, folder).side_tables
    out = [side.select(F.lit(c).alias("column"), "row_id", "value") for c, side in sides.items()]
    return functools.reduce(DataFrame.unionByName, out)


@query("explode_python_list")
def q_explode_python_list(spark, folder):
    return explode_list(derived.part_with_literals(spark, folder), "p_literal", "json", "p_partkey")


@query("summary_stats")
def q_summary_stats(spark, folder):
    g = derived.lineitem_with_gaps(spark, folder, with_row_id=False)
    return rounded(stages.summary_stats(clean(g, "row_id", WHOLE)))


# --- sources and sinks -------------------------------------------------------

def _orders_for_messages(spark, folder):
    o = table(spark, folder, "orders")
    return o.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("json_messages")
def q_json_messages(spark, folder):
    return to_messages(_orders_for_messages(spark, folder))


@query("delivered_messages")
def q_delivered_messages(spark, folder):
    """Orders delivered as messages to files in the shared folder: the writer's
    account, and the messages as they arrived."""
    path = scratch_path(spark, "delivered")
    account = totals(deliver(_orders_for_messages(spark, folder), file_transport(path)))
    return spark.read.text(path).crossJoin(F.broadcast(account))      # the account is one row


@query("csv_roundtrip")
def q_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "documents-csv")
    write_csv(table(spark, folder, "documents").orderBy("doc_id"), path)
    back = read_raw_csv(spark, path)
    return back.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
                       F.col("n_chars").cast("long").alias("n_chars"))


# --- text-heavy tables, array lists, streaming load --------------------------

TEXT_TABLES = ("documents", "pages", "conversations", "labels", "embeddings", "benchmark")


@query("column_types_text")
def q_column_types_text(spark, folder):
    parts = [detect_types(spread(table(spark, folder, name)), sample_rows=None)
             .withColumn("table_name", F.lit(name)) for name in TEXT_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("explode_array_list")
def q_explode_array_list(spark, folder):
    e = table(spark, folder, "embeddings")
    side = L.explode_list(e, "embedding", C.HINT_JSON, "vec_id")
    # Element text round-trips to the same FLOAT exactly.
    return side.select("row_id", F.col("value").cast("float").alias("value"))


@query("loaded_once")
def q_loaded_once(spark, folder):
    """Orders that arrive as files, loaded with a ledger; then every batch is run
    again, as after a stop between a batch's data and its checkpoint."""
    from tablewright.streaming import messages as stream
    src, out = scratch_path(spark, "orders-once-src"), scratch_path(spark, "orders-once-out")
    rows = _orders_for_messages(spark, folder)
    rows.repartition(3, "o_orderkey").write.parquet(src)
    stream.load_once(spark, src, rows.schema, out, scratch_path(spark, "orders-once-ckpt")).awaitTermination()
    # A batch that is run again finds its entry in the ledger and writes nothing.
    done = stream.ledger(spark, out).orderBy("batch").collect()
    for entry in done:
        stream.write_batch_once(to_messages(rows).select("value"), entry["batch"], out, entry["stream"])
    return stream.loaded_messages(spark, out)


@query("streamed_messages")
def q_streamed_messages(spark, folder):
    from tablewright.streaming.messages import stream_messages
    src = scratch_path(spark, "orders-stream-src")
    out = scratch_path(spark, "orders-stream-out")
    rows = _orders_for_messages(spark, folder)
    rows.write.parquet(src)
    q = stream_messages(spark, src, rows.schema, fmt="json", path=out,
                        checkpoint=scratch_path(spark, "orders-stream-ckpt"), max_files_per_trigger=4)
    q.awaitTermination()
    return spark.read.schema("value string").json(out)
