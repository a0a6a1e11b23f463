import json
import os

import numpy as np
import pytest

from tablewright.operators import features as FT
from tablewright.sinks.messages import to_messages, write_messages
from tablewright.sources.csv import read_raw_csv, write_csv
from tablewright.sources.side_tables import read_side_table, write_side_table


def test_feature_routes_order_and_threshold():
    types = {"n": "numeric", "c15": "categorical", "c16": "categorical", "l": "list_json", "b": "boolean",
             "d": "dict_json"}
    card = {"c15": 15, "c16": 16, "b": 2}
    assert FT.feature_routes(types, card, 15) == [
        ("n", "numeric", 0), ("c15", "one_hot", 15), ("b", "one_hot", 2), ("c16", "label", 16),
        ("l", "passthrough", 0)]


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, c double")
    p = {r.column: (r.mean, r["std"]) for r in FT.scaler_fit(df, ["a", "c"]).collect()}
    assert p["a"] == pytest.approx((3.0, np.std([1, 2, 3, 6])))
    assert p["c"] == (5.0, 1.0)
    z = FT.standardize(df, p).toPandas()
    assert z.c.tolist() == [0.0] * 4 and z.a.mean() == pytest.approx(0.0)


def test_one_hot_unknown_and_case_collisions(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,), (9,)], "x int")
    cats = [(0, "A"), (1, "a"), (2, "unknown")]
    out = FT.one_hot(df, {"x": cats})
    assert out.columns == ["x__A", "x__a__1", "x__unknown"]
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1), (0, 0, 1)]


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    x = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    load, ratios = FT.pca_fit(df, cols)
    assert load.shape == (4, 3)
    s = np.linalg.svd(x - x.mean(0), compute_uv=False)
    np.testing.assert_allclose(ratios, (s ** 2 / (s ** 2).sum())[:3], rtol=1e-6)
    for j in range(3):
        assert load[np.argmax(np.abs(load[:, j])), j] > 0
    proj = FT.pca_project(df, cols, load).toPandas().to_numpy()
    np.testing.assert_allclose(proj, x @ load, rtol=1e-9, atol=1e-9)


def test_messages_are_valid_json_with_nulls(spark):
    df = spark.createDataFrame([(1, float("nan"), None, "é")], "a long, b double, c string, d string")
    v = json.loads(to_messages(df).first().value)
    assert v == {"a": 1, "b": None, "c": None, "d": "é"}


def test_write_messages_to_files(spark, tmp_dir):
    df = spark.range(10).withColumnRenamed("id", "x")
    assert write_messages(df, "text", os.path.join(tmp_dir, "m")) == 10
    back = spark.read.text(os.path.join(tmp_dir, "m"))
    assert sorted(json.loads(r.value)["x"] for r in back.collect()) == list(range(10))


def test_csv_roundtrip_na_tokens_and_newlines(spark, tmp_dir):
    rows = [(0, 'line one\nline "two", three', "NA"), (1, "", "n/a"), (2, "ok", "x")]
    df = spark.createDataFrame(rows, "id long, text string, tag string")
    path = os.path.join(tmp_dir, "csv")
    write_csv(df, path)
    back = read_raw_csv(spark, path).orderBy("row_id").collect()
    assert [r.text for r in back] == ['line one\nline "two", three', None, "ok"]
    assert [r.tag for r in back] == [None, None, "x"]
    assert [r.row_id for r in back] == [0, 1, 2]


def test_side_table_missing_reads_empty(spark, tmp_dir):
    assert read_side_table(spark, os.path.join(tmp_dir, "absent")).count() == 0
    df = spark.createDataFrame([(1, "a"), (1, "b")], "row_id long, value string")
    write_side_table(df, os.path.join(tmp_dir, "side"))
    assert sorted(tuple(r) for r in read_side_table(spark, os.path.join(tmp_dir, "side")).collect()) == [
        (1, "a"), (1, "b")]


def test_streaming_load_to_files(spark, tmp_dir):
    from tablewright.streaming.messages import stream_messages
    src = os.path.join(tmp_dir, "src")
    spark.range(5).withColumnRenamed("id", "x").write.parquet(src)
    out = os.path.join(tmp_dir, "out")
    q = stream_messages(spark, src, "x long", fmt="json", path=out,
                        checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    vals = sorted(json.loads(r.value)["x"] for r in spark.read.json(out).collect())
    assert vals == list(range(5))


def test_one_hot_names_differ_across_columns(spark):
    df = spark.createDataFrame([(0, 0, 7), (1, 1, 8)], "a int, a__b int, A__B__C int")
    cats = {"a": [(0, "b__c"), (1, "x")], "a__b": [(0, "c"), (1, "C__0")]}
    out = FT.one_hot(df, cats, keep=["A__B__C"])
    assert len({c.lower() for c in out.columns}) == 5 and out.columns[:3] == ["A__B__C", "a__b__c__0", "a__x"]
    assert [tuple(r) for r in out.collect()] == [(7, 1, 0, 1, 0), (8, 0, 1, 0, 1)]
