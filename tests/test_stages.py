from pyspark.sql import functions as F

from tablewright.config import PrepConfig
from tablewright.plans.clean import clean
from tablewright.plans.stages import apply_saved, eda, preprocess, run_all


def messy(spark):
    rows = []
    for i in range(60):
        rows.append((i,
                     None if i % 7 == 0 else str(i * 1.5),              # numeric text with gaps
                     ["red", "blue", None][i % 3],                       # categorical with gaps
                     "Y" if i % 2 else "N",                               # boolean
                     f'["t{i % 4}", "t{(i + 1) % 4}"]' if i % 5 else None,  # list
                     None if i % 10 else "rare",                         # 90 % missing -> dropped
                     str(i % 4)))                                         # number text, 4 values
    return spark.createDataFrame(rows, "row_id long, amount string, color string, flag string, "
                                       "tags string, sparse string, level string")


def test_clean_stage(spark):
    cl = clean(messy(spark), "row_id", PrepConfig(type_sample_rows=None))
    assert cl.type_of == {"amount": "numeric", "color": "categorical", "flag": "boolean",
                          "tags": "list_json", "level": "numeric_categorical"}
    t = cl.table
    assert t.columns == ["row_id", "amount", "color", "flag", "level"]
    assert t.where(F.col("amount").isNull() | F.col("color").isNull()).count() == 0
    d = {(r.column, r.value): r.code for r in cl.dictionary.collect()}
    assert d[("color", "blue")] == 0 and d[("color", "red")] == 1
    assert d[("level", "0")] == 0 and ("level", "0.0") not in d
    assert cl.side_tables["tags"].count() == 2 * sum(1 for i in range(60) if i % 5)


def test_eda_and_preprocess(spark):
    cl = clean(messy(spark), "row_id", PrepConfig(type_sample_rows=None))
    e = eda(cl)
    stats = {(r.column, r.statistic): r.value for r in e.summary.collect()}
    assert stats[("tags", "num_unique_elements")] == 4
    assert stats[("amount", "count")] == 60
    assert e.lists["tags"]["cooccurrence"].count() == 10
    p = preprocess(cl)
    routes = [(r.column, r.route) for r in p.routes.orderBy("position").collect()]
    # The list column is routed as passthrough but lives in its side table,
    # so it never reaches the feature table.
    assert routes == [("amount", "numeric"), ("color", "one_hot"), ("flag", "one_hot"), ("level", "one_hot"),
                      ("tags", "passthrough")]
    assert p.features.columns == ["row_id", "amount", "color__blue", "color__red", "flag__N", "flag__Y",
                                  "level__0", "level__1", "level__2", "level__3"]
    assert p.pca_variance is not None and p.pca_variance.count() == 1


def test_run_all_writes_outputs_and_reapplies(spark, tmp_dir):
    res = run_all(messy(spark), tmp_dir, "row_id", PrepConfig(type_sample_rows=None))
    assert spark.read.parquet(f"{tmp_dir}/preprocessed").count() == 60
    assert spark.read.text(f"{tmp_dir}/messages").count() == 60
    assert spark.read.json(f"{tmp_dir}/meta/encodings").count() > 0
    features, pca = apply_saved(res["clean"].table, tmp_dir)
    saved = spark.read.parquet(f"{tmp_dir}/preprocessed")
    assert sorted(map(tuple, features.collect())) == sorted(map(tuple, saved.select(*features.columns).collect()))
    first = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/pca").collect()))
    again = sorted(map(tuple, pca.collect()))
    assert all(abs(a[1] - b[1]) < 1e-9 and a[0] == b[0] for a, b in zip(first, again))


def test_csv_end_to_end(spark, tmp_dir):
    """Written as all-text CSV, read back with NA tokens, run through every stage."""
    from tablewright.plans import derived
    from tablewright.sources.csv import read_raw_csv, write_csv
    g = derived.lineitem_with_gaps(spark, "/root/testdata/sf0.001", with_row_id=False).drop("row_id")
    write_csv(g, f"{tmp_dir}/raw")
    raw = read_raw_csv(spark, f"{tmp_dir}/raw")
    assert dict(raw.dtypes)["l_quantity"] == "string"
    res = run_all(raw, f"{tmp_dir}/out", "row_id", PrepConfig())
    cl = res["clean"]
    assert "l_note" not in cl.type_of                      # > 70 % missing
    assert cl.type_of["l_quantity"] == "numeric"
    assert cl.type_of["l_open"] == "boolean"
    assert cl.type_of["l_shipyear"] == "numeric_categorical"
    assert cl.table.count() == g.count()
    assert spark.read.text(f"{tmp_dir}/out/messages").count() == g.count()


def test_late_text_is_kept(spark):
    df = spark.range(12_000).selectExpr("id AS row_id", "CASE WHEN id < 10000 THEN CAST(id AS STRING) ELSE concat('t', id % 700) END AS v")
    cl = clean(df, "row_id")
    assert cl.type_of["v"] == "categorical"


def test_box_whiskers_stay_outside_the_box(spark):
    from tablewright.operators.numeric import box_stats

    r = box_stats(spark.createDataFrame([(0.0,), (0.0,), (0.0,), (100.0,)], "x double"), ["x"]).first()
    assert (r.q3, r.whisker_hi, r.whisker_lo) == (25.0, 25.0, 0.0)


def test_saved_parameters_skip_absent_columns(spark, tmp_dir):
    """Columns that a new table lacks are left out; without one of the numeric
    ones there is no projection."""
    res = run_all(messy(spark), tmp_dir, "row_id", PrepConfig(type_sample_rows=None))
    whole = res["clean"].table
    features, pca = apply_saved(whole, tmp_dir)
    routes = {r["column"]: r["route"] for r in res["prepared"].routes.collect()}
    assert pca is not None and {"numeric", "one_hot"} <= set(routes.values())
    for column, route in routes.items():
        if column not in whole.columns:          # a list is in a table of its own
            continue
        less, less_pca = apply_saved(whole.drop(column), tmp_dir)
        gone = [c for c in features.columns if c == column or c.startswith(f"{column}__")]
        assert gone and less.columns == [c for c in features.columns if c not in gone]
        assert (less_pca is None) == (route == "numeric")
        assert sorted(map(tuple, less.collect())) == sorted(map(tuple, features.select(*less.columns).collect()))
