"""States that merge: adding a file scans only it, and what follows from the
merged state equals a scan of everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import features as FT
from tablewright.operators import moments as M
from tablewright.operators import numeric as N
from tablewright.operators import profile as P

TEXT = {
    "whole": ["1", "2", " 3", "2.0"], "mixed": ["1", "2", "x", "4"], "late": ["1", "2", "3", "Y"], "truth": ["True", "false", "TRUE", None],
    "flag": ["Y", " N", "Y", None], "lists": ["[1]", "[2", "x", "[a,b]"], "dicts": ['{"a": 1}', "{}", "{", "x"], "commas": ["a,b", "c", "d,e", "f"],
    "none": [None, None, None, None], "nan": ["nan", "1", "inf", "2"], "words": ["a", "b", "c", "d"]}


def text_table(spark, rows):
    return spark.createDataFrame([tuple(TEXT[c][k % 4] for c in TEXT) + (float(k), k % 30, k % 5 if k % 3 else None) for k in rows],
                                 ", ".join(f"{c} string" for c in TEXT) + ", x double, many long, few long")


@pytest.mark.parametrize("cut", [0, 1, 3, 40, 90])
def test_merged_profiles_equal_a_whole_scan(spark, cut):
    whole = text_table(spark, range(90))
    parts = [P.profile_state(text_table(spark, r)) for r in (range(cut), range(cut, 90))]
    merged = P.merge_profiles(parts[0].unionByName(parts[1]))
    for found in (P.types_of, P.nulls_of, P.summary_of):
        a, b = (sorted(map(repr, f.collect())) for f in (found(merged), found(P.profile_state(whole))))
        assert a == b if found is not P.summary_of else len(a) == len(b)
    assert sorted(map(tuple, P.types_of(merged).collect())) == sorted(map(tuple, P.detect_types(whole).collect()))
    assert sorted(map(tuple, P.nulls_of(merged).collect())) == sorted(map(tuple, P.null_profile(whole).collect()))
    a, b = ({r["column"]: r for r in f.collect()} for f in (P.summary_of(merged), N.numeric_summary(whole, whole.columns)))
    for c in whole.columns:
        assert a[c]["count"] == b[c]["count"] and a[c]["min"] == b[c]["min"] and a[c]["mean"] == pytest.approx(b[c]["mean"])


def test_small_sets_grow_past_the_threshold(spark):
    part = lambda lo, hi: P.profile_state(spark.range(lo, hi).withColumnRenamed("id", "x"), limit=20)
    kinds = lambda s: [r["type"] for r in P.types_of(s).collect()]
    assert kinds(part(0, 20)) == ["numeric_categorical"] and kinds(part(0, 21)) == ["numeric"]
    assert kinds(P.merge_profiles(part(0, 12).unionByName(part(5, 20)))) == ["numeric_categorical"]
    assert kinds(P.merge_profiles(part(0, 12).unionByName(part(5, 21)))) == ["numeric"]
    assert kinds(P.merge_profiles(part(0, 5).unionByName(part(0, 100)))) == ["numeric"]


def test_adding_a_file_scans_only_it(spark, tmp_dir):
    for k, rows in enumerate((range(30), range(30, 90))):
        text_table(spark, rows).coalesce(1).write.parquet(f"{tmp_dir}/in/{k}")
        P.add_profile(spark.read.parquet(f"{tmp_dir}/in/{k}"), f"{tmp_dir}/state")
    stored = P.stored_profile(spark, f"{tmp_dir}/state")
    assert not any("/in/" in f for f in spark.read.parquet(f"{tmp_dir}/state").inputFiles())
    assert sorted(map(tuple, P.types_of(stored).collect())) == sorted(map(tuple, P.detect_types(text_table(spark, range(90))).collect()))
    assert P.types_of(P.profile_state(text_table(spark, range(0)))).count() == len(TEXT) + 3


# moments ------------------------------------------------------------------------------------------
def numbers(rng, n):
    x = rng.normal(size=(n, 7)) @ rng.normal(size=(7, 7)) + 1e6
    x[:, 5] = 0.1
    x[rng.random(n) < 0.2, 2] = np.nan
    return x


def frame(spark, x):
    cols = [f"c{k}" for k in range(x.shape[1])]
    return spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)), cols


def test_merged_moments_equal_a_whole_fit(spark, tmp_dir):
    import pandas as pd

    x = numbers(np.random.default_rng(2), 500)
    whole, cols = frame(spark, x)
    for part in (x[:1], x[1:200], x[200:]):
        M.add_to_state(frame(spark, part)[0], cols, f"{tmp_dir}/moments")
    merged = M.stored_state(spark, f"{tmp_dir}/moments")
    a, b = ({r["column"]: r for r in s.collect()} for s in (M.scaler_of(M.columns_of(merged)), FT.scaler_fit(whole, cols)))
    for k, c in enumerate(cols):
        assert a[c]["mean"] == pytest.approx(np.nanmean(x[:, k]), rel=1e-12) and a[c]["std"] == pytest.approx(b[c]["std"], rel=1e-9)
    assert a["c5"]["std"] == 1.0
    want, got = pd.DataFrame(x, columns=cols).corr(), {(r[0], r[1]): r[2] for r in M.pearson_of(merged).collect()}
    assert len(got) == 49
    for i in cols:
        for j in cols:
            assert got[i, j] is None if "c5" in (i, j) else got[i, j] == pytest.approx(want.loc[i, j], abs=1e-8)


def test_fit_from_a_state_equals_a_fit_of_the_table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    df, cols = frame(spark, x)
    scaler, loadings, ratios = M.fitted(M.merge_pairs(M.pair_state(df.limit(100), cols).unionByName(
        M.pair_state(df.exceptAll(df.limit(100)), cols))), cols)
    again, same = FT.pca_fit(FT.standardize(df, scaler), cols)
    np.testing.assert_allclose(ratios, same, atol=1e-9)
    np.testing.assert_allclose(loadings, again, atol=1e-6)


def test_pearson_of_sixty_columns_is_one_scan_with_generated_code(spark, tmp_dir):
    import pandas as pd

    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 60))
    x[:, 1] = x[:, 0] * 2
    x[rng.random((80, 60)) < 0.05] = np.nan
    df, cols = frame(spark, x)
    df.write.parquet(f"{tmp_dir}/wide")
    df = spark.read.parquet(f"{tmp_dir}/wide")
    got = {(r[0], r[1]): r[2] for r in N.pearson(df, cols).collect()}
    want = pd.DataFrame(x, columns=cols).corr()
    assert len(got) == 3600 and all(got[i, j] == pytest.approx(want.loc[i, j], abs=1e-9) for i in cols for j in cols)
    plan = M.pair_state(df, cols)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    final = M.pair_state(df, cols)
    final.collect()
    lines = final._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    assert all("*(" in line for line in lines if "HashAggregate(keys=[bx" in line) and any("HashAggregate(keys=[bx" in line for line in lines)


def test_states_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert sorted(map(tuple, N.pearson(df, ["a", "b"]).collect())) == [("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", None)]
    assert sorted(map(tuple, FT.scaler_fit(df, ["a"]).collect())) == [("a", None, 1.0)]


# components ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("p, k", [(60, None), (60, 5), (1, None), (2, None)])
def test_components_equal_a_decomposition(spark, p, k):
    rng = np.random.default_rng(p)
    x = rng.normal(size=(400, p)) * np.linspace(3, 0.3, p) @ np.linalg.qr(rng.normal(size=(p, p)))[0]
    x = x - x.mean(0)
    df, cols = frame(spark, x)
    loadings, ratios = FT.pca_fit(df, cols, k)
    values, vectors = np.linalg.eigh(x.T @ x / len(x))
    n = k or FT.pca_components(p)
    want = vectors[:, ::-1][:, :n]
    want = want * np.sign(want[np.abs(want).argmax(0), np.arange(n)])
    np.testing.assert_allclose(ratios, values[::-1][:n] / values.sum(), atol=1e-9)
    np.testing.assert_allclose(loadings, want, atol=1e-6)


def test_components_need_every_value(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises(Exception, match="impute"):
        FT.pca_fit(df, ["a", "b"])


def test_densities_have_no_row_for_each_point(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"))
    plan = N.kde(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "hashpartitioning(value" not in plan
