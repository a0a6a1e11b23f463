import math

import numpy as np
import pandas as pd
import pytest

from tablewright.operators import numeric as N


@pytest.fixture()
def data(spark):
    rng = np.random.default_rng(3)
    n = 800
    x = rng.lognormal(size=n)
    y = 2 * x + rng.normal(size=n)
    z = np.where(np.arange(n) % 9 == 0, np.nan, rng.normal(size=n))
    const = np.full(n, 4.0)
    pdf = pd.DataFrame({"x": x, "y": y, "z": z, "const": const})
    rows = [tuple(None if (isinstance(v, float) and math.isnan(v)) else float(v) for v in r)
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "x double, y double, z double, const double"), pdf


def test_skewness_matches_pandas(spark, data):
    df, pdf = data
    got = {r.column: r.skewness for r in N.skewness(df, ["x", "z", "const"]).collect()}
    assert got["x"] == pytest.approx(pdf.x.skew(), rel=1e-9)
    assert got["z"] == pytest.approx(pdf.z.skew(), rel=1e-9)
    assert got["const"] == 0.0


def test_log_transform_only_skewed(spark, data):
    df, pdf = data
    plot, mins = N.plot_values(df, ["x", "z"])
    assert set(mins) == {"x"}
    got = np.array([r.x for r in plot.select("x").collect()])
    np.testing.assert_allclose(np.sort(got), np.sort(np.log1p(pdf.x - pdf.x.min())), rtol=1e-12)


def test_histogram_matches_numpy(spark, data):
    df, pdf = data
    h = N.histogram(df, ["x", "const"], 50).toPandas()
    for c in ["x", "const"]:
        counts, edges = np.histogram(pdf[c], bins=50)
        dens, _ = np.histogram(pdf[c], bins=50, density=True)
        part = h[h.column == c].sort_values("bin")
        assert list(part["count"]) == list(counts)
        np.testing.assert_allclose(part.density, dens, rtol=1e-9)
        np.testing.assert_allclose(part.bin_lo, edges[:-1], rtol=1e-9, atol=1e-12)


def test_kde_matches_gaussian_formula(spark, data):
    df, pdf = data
    k = N.kde(df, ["y", "const"], 200, 0.6).toPandas()
    assert set(k.column) == {"y"}          # zero variance: no curve
    y = pdf.y.to_numpy()
    h = 0.6 * y.std(ddof=1)
    grid = np.linspace(y.min(), y.max(), 200)
    expect = np.exp(-0.5 * ((grid[:, None] - y[None, :]) / h) ** 2).sum(axis=1) / (len(y) * h * math.sqrt(2 * math.pi))
    part = k.sort_values("point")
    np.testing.assert_allclose(part.x, grid, rtol=1e-12)
    np.testing.assert_allclose(part.density, expect, rtol=1e-9)


def test_pearson_pairwise_complete(spark, data):
    df, pdf = data
    got = {(r.col_x, r.col_y): r.pearson
           for r in N.pearson(df, ["x", "y", "z", "const"]).collect()}
    expect = pdf.corr()
    for a in ["x", "y", "z"]:
        for b in ["x", "y", "z"]:
            assert got[(a, b)] == pytest.approx(expect.loc[a, b], rel=1e-9)
    assert got[("x", "const")] is None and got[("const", "const")] is None


def test_iqr_outliers_and_box(spark, data):
    df, pdf = data
    x = pdf.x.to_numpy()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    o = N.iqr_outliers(df, ["x"]).first()
    assert o.n_outliers == int(((x < lo) | (x > hi)).sum())
    b = N.box_stats(df, ["x"]).first()
    inside = x[(x >= lo) & (x <= hi)]
    assert (b.whisker_lo, b.whisker_hi) == (inside.min(), inside.max())
    assert b.median == pytest.approx(med)
    kept = N.remove_outliers(df, ["x"]).count()
    assert kept == len(x) - o.n_outliers


def test_numeric_summary(spark, data):
    df, pdf = data
    s = {r.column: r for r in N.numeric_summary(df, ["z"]).collect()}["z"]
    assert s["count"] == pdf.z.count() and s["mean"] == pytest.approx(pdf.z.mean())


def test_head_paths_agree(spark):
    rows = [(i, (i * 7919) % 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long").repartition(12)
    plain = [tuple(r) for r in N.head(df, ["k", "id"], 50).collect()]
    tree = [tuple(r) for r in N.head(df, ["k", "id"], 50, groups=3).collect()]
    assert tree == plain == sorted(rows, key=lambda r: (r[1], r[0]))[:50]
    dense = sorted(tuple(r) for r in N.head(df, ["id"], 50, dense_id=True).collect())
    assert dense == rows[:50]


def test_per_column_statistics_keep_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    got = {r["column"]: r for r in N.numeric_summary(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["min"], got["a"]["max"], got["a"]["mean"]) == (2, 1.0, 3.0, 2.0)
    assert (got["b"]["count"], got["b"]["min"], got["b"]["max"], got["b"]["mean"]) == (0, None, None, 0.0)
    empty = spark.createDataFrame([], "a double")
    assert [tuple(r) for r in N.numeric_summary(empty, ["a"]).collect()] == [("a", 0, None, None, 0.0)]
    sk = {r["column"]: (r["n"], r["skewness"]) for r in N.skewness(df, ["a", "b"]).collect()}
    assert sk == {"a": (2, None), "b": (0, None)}
