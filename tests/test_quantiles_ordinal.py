import numpy as np
import pytest

from tablewright.operators.ordinal import assign_row_id, positions
from tablewright.operators import quantiles as Q
from tablewright.operators.quantiles import exact_quantiles


@pytest.fixture()
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    a = rng.normal(size=n)
    a[: n // 3] = 5.0                      # one value holds a third of the rows
    b = rng.integers(0, 7, size=n).astype(float)
    rows = [(float(x), float(y) if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "a double, b double"), a, b


@pytest.mark.parametrize("read", [1, 30, 2000])  # narrowing down to one value, a few passes, reading after one
def test_quantiles_match_numpy(spark, skewed, read, monkeypatch):
    df, a, b = skewed
    monkeypatch.setattr(Q, "READ_VALUES", read)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.1]
    got = {(r.column, r.prob): r.value for r in exact_quantiles(df, ["a", "b"], probs).collect()}
    b_present = np.array([y for i, y in enumerate(b) if i % 10])
    for p in probs:
        assert got[("a", p)] == pytest.approx(np.percentile(a, p * 100), abs=1e-12)
        assert got[("b", p)] == pytest.approx(np.percentile(b_present, p * 100), abs=1e-12)


def test_quantiles_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).count() == 0


def test_quantiles_of_hard_scales(spark, monkeypatch):
    """Heavy tails, values across zero, extremes, infinities and a cluster far from
    the rest: a few passes each, and the same as sorting."""
    monkeypatch.setattr(Q, "READ_VALUES", 2)
    monkeypatch.setattr(Q, "PASS_BINS", 64)
    rng = np.random.default_rng(5)
    columns = {
        "tail": 2.0 ** rng.uniform(-1000, 1000, 400), "signed": rng.choice([-1, 1], 400) * 10.0 ** rng.uniform(-300, 300, 400),
        "far": np.where(np.arange(400) < 2, 1e300, 1 + rng.random(400) * 1e-9), "extreme": rng.choice([-1.7e308, 1.7e308, 5e-324, 0.0, -5e-324], 400),
        "endless": np.where(np.arange(400) % 3 == 0, np.inf, np.where(np.arange(400) % 3 == 1, -np.inf, rng.normal(size=400))),
        "whole": rng.integers(-3, 3, 400).astype(float)}
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in columns.values()])), ", ".join(f"{c} double" for c in columns))
    ranks = [0, 1, 99, 133, 134, 200, 266, 267, 398, 399, 400, -1]
    passes = []
    counts = Q.bin_counts
    monkeypatch.setattr(Q, "bin_counts", lambda *a: passes.append(1) or counts(*a))
    got = Q.order_statistics(df, {c: ranks for c in columns})
    want = {(c, k): np.sort(v)[k] for c, v in columns.items() for k in ranks if 0 <= k < 400}
    assert got == want and len(passes) <= 16


def test_quantiles_shuffle_bins_only(spark, skewed):
    """The passes exchange counts of bins; no exchange has a value as its key."""
    df, a, _ = skewed
    plan = Q.bin_counts(df, [("a", float(a.min()), float(a.max()))], 64, False)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 1 and "interval" in keys[0] and "value" not in keys[0]


def test_row_ids_dense_and_ordered(spark):
    rows = [(i % 17, (i * 7919) % 1000, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, k int, payload int")
    out = assign_row_id(df, ["k", "payload"]).orderBy("row_id").collect()
    assert [r.row_id for r in out] == list(range(500))
    keys = [(r.k, r.payload) for r in out]
    assert keys == sorted(keys)


def test_positions_within_groups(spark):
    rows = [(f"c{i % 3}", f"v{i:03d}") for i in range(90)]
    df = spark.createDataFrame(rows, "column string, value string")
    out = positions(df, ["value"], ["column"], "code").collect()
    by = {}
    for r in out:
        by.setdefault(r.column, []).append((r.code, r.value))
    for col, pairs in by.items():
        pairs.sort()
        assert [c for c, _ in pairs] == list(range(30))
        assert [v for _, v in pairs] == sorted(v for _, v in pairs)
