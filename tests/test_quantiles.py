"""Exact interval-narrowing quantiles against NumPy on crafted data."""

import numpy as np
import pytest

from tabspark.operators.quantiles import exact_quantiles, order_statistics, wide_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def _frame(spark, values, groups=None):
    rows = [(int(g) if groups is not None else 0, None if v is None else float(v))
            for g, v in zip(groups if groups is not None else [0] * len(values), values)]
    return spark.createDataFrame(rows, "g int, v double")


@pytest.mark.parametrize("kind", ["normal", "heavy", "hot", "ints", "tiny"])
def test_matches_numpy_with_forced_narrowing(spark, kind):
    rng = np.random.default_rng(7)
    n = 3000
    if kind == "normal":
        x = rng.normal(size=n)
    elif kind == "heavy":
        x = np.exp(rng.normal(0, 6, size=n))  # spans many orders of magnitude
    elif kind == "hot":
        x = rng.normal(size=n)
        x[: n // 3] = 1.2345  # one value holds a third of the rows
    elif kind == "ints":
        x = rng.integers(0, 7, size=n).astype(float)
    else:
        x = np.array([5.0])
    df = _frame(spark, list(x))
    got = exact_quantiles(df, ["g"], "v", PROBS, buckets=8, final_rows=50)[(0,)]
    assert got[0] == len(x)
    np.testing.assert_allclose(got[1], np.quantile(x, PROBS), rtol=1e-12, atol=0)


def test_groups_nulls_and_nan(spark):
    rng = np.random.default_rng(3)
    vals, groups = [], []
    for g, size in ((0, 500), (1, 37), (2, 1)):
        vals += list(rng.normal(g, 1, size))
        groups += [g] * size
    vals += [None, float("nan")]
    groups += [1, 1]
    df = _frame(spark, vals, groups)
    got = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], buckets=4, final_rows=10)
    for g in (0, 1, 2):
        x = np.array([v for v, gg in zip(vals, groups) if gg == g and v is not None and v == v])
        assert got[(g,)][0] == len(x)
        np.testing.assert_allclose(got[(g,)][1], np.quantile(x, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_order_statistics_ranks(spark):
    x = [3.0, 1.0, 2.0, 2.0, 9.0, -4.0]
    df = _frame(spark, x)
    got = order_statistics(df, ["g"], "v", lambda n: list(range(n)), buckets=2, final_rows=1)[(0,)]
    assert [got[1][r] for r in range(len(x))] == sorted(x)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(df, ["g"], "v", [0.5]) == {}


@pytest.mark.parametrize("kind", ["inf", "log-uniform", "signs", "denormal"])
def test_any_scale_ends_by_narrowing(spark, kind):
    """Intervals reach few rows on any data: no round limit, no large sort at the end."""
    rng = np.random.default_rng(1)
    if kind == "inf":
        x = np.r_[rng.normal(size=4990), [np.inf] * 5, [-np.inf] * 5]
    elif kind == "log-uniform":
        x = 10.0 ** rng.uniform(-250, 249, 5000)
    elif kind == "signs":
        x = np.r_[10.0 ** rng.uniform(-300, 300, 2500), -(10.0 ** rng.uniform(-300, 300, 2400)), np.zeros(100)]
    else:
        x = np.r_[rng.integers(1, 2000, 4000) * 5e-324, [1.7e308, -1.7e308]]
    want = np.sort(x)
    ranks = [0, len(x) // 4, len(x) // 2, len(x) - 6, len(x) - 1]
    got = order_statistics(_frame(spark, list(x)), ["g"], "v", lambda n: ranks, final_rows=20)[(0,)]
    assert [got[1][r] for r in ranks] == [want[r] for r in ranks]


def _scans(spark, df, run):
    """How often ``run`` reads the rows of ``df``, by a counter in a pass-through stage."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = df.count()
    run(df.mapInPandas(count, df.schema))
    return seen.value / rows


@pytest.mark.parametrize("final_rows,most", [(100_000, 2), (300, 3)])
def test_at_most_three_scans(spark, final_rows, most):
    """Whatever the number of rows and columns: a sketch, a narrowing one if needed, and the counts."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 3))
    df = spark.createDataFrame([(int(i % 2), *map(float, r)) for i, r in enumerate(x)], "g int, a double, b double, c double").repartition(4).cache()
    got = {}

    def run(d):
        got.update(wide_quantiles(d, ["a", "b", "c"], [0.1, 0.5, 0.9], ["g"], final_rows=final_rows, moments=True))
    assert _scans(spark, df, run) <= most
    for g in (0, 1):
        for i, f in enumerate("abc"):
            col = x[g::2, i]
            n, q, m = got[(f, g)]
            np.testing.assert_allclose(q, np.quantile(col, [0.1, 0.5, 0.9]), rtol=1e-12)
            np.testing.assert_allclose([m["s"]["a"], m["s"]["m"] / (n - 1), m["lo"], m["hi"]], [col.mean(), col.var(ddof=1), col.min(), col.max()], rtol=1e-9)


def test_a_rank_that_the_sketch_misses_is_searched_again(spark, monkeypatch):
    from tabspark.operators import quantiles as QN
    monkeypatch.setattr(QN, "rank_error", lambda k: 0.0)  # bounds far too tight for this sketch
    x = np.random.default_rng(5).permutation(30_000).astype(float)
    got = QN.order_statistics(_frame(spark, list(x)), ["g"], "v", lambda n: [7, 9_999, 15_001, 29_990], buckets=8, final_rows=200)[(0,)]
    assert got == (30_000, {7: 7.0, 9_999: 9_999.0, 15_001: 15_001.0, 29_990: 29_990.0})
