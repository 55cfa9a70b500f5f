"""Profiling operators on hand-made edge frames."""

import math

import numpy as np
import pytest

from tabspark.operators import profiling as P


def test_missing_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    got = {r["column_name"]: (r["missing"], r["missing_pct"]) for r in P.missing_profile(df).collect()}
    assert got == {"x": (2, 50.0), "s": (1, 25.0)}
    only = [r["column_name"] for r in P.missing_profile(df, only_missing=True).collect()]
    assert sorted(only) == ["s", "x"]


def test_describe_single_row_and_empty(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    r = P.describe_numeric(one, ["x"]).first()
    assert (r["count"], r["mean"], r["std"], r["q25"], r["q50"], r["max"]) == (1, 3.0, None, 3.0, 3.0, 3.0)
    empty = spark.createDataFrame([], "x double")
    r = P.describe_numeric(empty, ["x"]).first()
    assert r["count"] == 0 and r["mean"] is None and r["q50"] is None


def test_correlation_constant_is_null_and_diag_one(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=50)
    y = 2 * x + rng.normal(size=50) * 0.1
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y)], "x double, y double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "y", "c"]).collect()}
    assert got[("x", "x")] == 1.0
    assert got[("x", "y")] == round(float(np.corrcoef(x, y)[0, 1]), 4)
    assert got[("x", "c")] is None and got[("c", "c")] is None


def test_correlation_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 6.5), (4.0, 8.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "y"]).collect()}
    xs, ys = np.array([1.0, 3.0, 4.0]), np.array([2.0, 6.5, 8.0])
    assert got[("x", "y")] == round(float(np.corrcoef(xs, ys)[0, 1]), 4)


def test_histogram_last_bin_closed_and_zero_filled(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (10.0,)], "x double")
    h = {r["bin"]: r["n"] for r in P.histogram(df, "x", bins=5).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 0, 4: 2}
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r["bin"]: r["n"] for r in P.histogram(const, "x", bins=3).collect()} == {0: 2, 1: 0, 2: 0}


def test_outliers_strict_bounds(spark):
    x = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    q1, q3 = np.quantile(x, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    r = P.outlier_profile(df, ["x"]).first()
    assert r["outlier_count"] == sum(1 for v in x if v < lo or v > hi) == 1
    assert r["upper_bound"] == round(hi, 4)
    assert P.outlier_profile(spark.createDataFrame([(1.0,), (1.0,)], "x double"), ["x"]).count() == 0


def test_box_stats_whiskers(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=200), [8.0, -9.0]])
    df = spark.createDataFrame([(float(v), "a") for v in x], "x double, k string")
    r = P.box_stats(df, ["x"], by="k").first()
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = x[(x >= lo) & (x <= hi)]
    assert r["median"] == round(med, 4)
    assert r["whisker_lo"] == round(inside.min(), 4) and r["whisker_hi"] == round(inside.max(), 4)
    assert r["n_fliers"] == len(x) - len(inside)


def test_kde_integrates_to_counts(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    k = sorted((r["point"], r["x"], r["density_count"]) for r in P.kde(df, "x", points=200, bins=30).collect())
    h = x.std(ddof=1) * len(x) ** -0.2
    g = k[100][1]
    dens = np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
    assert k[100][2] == pytest.approx(dens * len(x) * (x.max() - x.min()) / 30, abs=1e-3)


def test_top_variance_ties_by_name(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (3.0, 3.0, 0.0)], "b double, a double, c double")
    assert [r["feature"] for r in P.top_variance(df, ["b", "a", "c"], 2).collect()] == ["a", "b"]


def test_multi_column_histograms_and_kdes_equal_single(spark):
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b)) for a, b in zip(rng.normal(size=300), rng.exponential(size=300))]
    df = spark.createDataFrame(rows, "a double, b double")
    multi = {(r["feature"], r["bin"]): r["n"] for r in P.histograms(df, ["a", "b"], 30).collect()}
    for f in ("a", "b"):
        single = {r["bin"]: r["n"] for r in P.histogram(df, f, 30).collect()}
        assert {k[1]: v for k, v in multi.items() if k[0] == f} == single
    mk = {(r["feature"], r["point"]): r["density_count"] for r in P.kdes(df, ["a", "b"]).collect()}
    for f in ("a", "b"):
        sk = {r["point"]: r["density_count"] for r in P.kde(df, f).collect()}
        assert all(abs(mk[(f, p)] - v) < 1e-3 for p, v in sk.items())
    assert P.top_variance_features(df, ["a", "b"], 1) == ["a"] or P.top_variance_features(df, ["a", "b"], 1) == ["b"]


def test_correlation_is_null_where_constant_on_common_rows(spark):
    """Constant on the rows that have both, though not on the whole column; and no common row at all."""
    rows = [(0.1, 1.0, None, None), (0.1, 2.0, 5.0, None), (0.1, 3.5, 6.0, None), (0.7, None, 7.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r.feature_a, r.feature_b): r["corr"] for r in P.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert len(got) == 16 and got["a", "b"] is None and got["b", "a"] is None and got["b", "d"] is None and got["d", "d"] is None
    assert got["a", "a"] == 1.0 and got["b", "c"] == 1.0 and got["a", "c"] == round(float(np.corrcoef([0.1, 0.1, 0.7], [5, 6, 7])[0, 1]), 4)


def test_co_moments_merge_like_one_batch():
    """Large means and missing cells: merged states equal NumPy on the rows that have both."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5000, 4)) * [1, 1e-3, 50, 1] + [1e9, 1, -7, 0]
    x[:, 3] += x[:, 2] / 40
    x[rng.random(x.shape) < 0.3] = np.nan
    t = P.CoMoments(4)
    for part in np.array_split(x, [1, 10, 800, 801, 3000]):
        t.merge(P.CoMoments.of(part))
    for i in range(4):
        for j in range(4):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            assert t.n[i, j] == both.sum() and t.lo[i, j] == a.min() and t.hi[i, j] == a.max()
            np.testing.assert_allclose(t.mean[i, j], a.mean(), rtol=1e-13)
            np.testing.assert_allclose(t.c[i, j], ((a - a.mean()) * (b - b.mean())).sum(), rtol=1e-6, atol=1e-3)
            np.testing.assert_allclose(t.m2[i, j], ((a - a.mean()) ** 2).sum(), rtol=1e-6)


def test_one_scan_for_all_pairs(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.range(5000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    assert len(P.correlation_matrix(df.mapInPandas(count, df.schema), ["a", "b"]).collect()) == 4 and seen.value == 5000


@pytest.mark.parametrize("kind", ["normal", "integers", "heavy"])
def test_gauss_cells_equal_direct_sums(kind):
    rng = np.random.default_rng(1)
    x = {"normal": rng.normal(5, 2, 4000), "integers": rng.integers(0, 30, 4000).astype(float), "heavy": np.exp(rng.normal(0, 3, 4000))}[kind]
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    cells = P.GaussCells(grid, h)
    for part in np.array_split(x, 7):
        cells.add(part)
    cells.add(np.zeros(0))
    want = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1)
    np.testing.assert_allclose(cells.sums(), want, atol=len(x) * 2e-15, rtol=1e-11)
