"""Null and NaN values are missing, never a result."""

import math

import pytest

from tabspark.operators.history import best_epoch
from tabspark.operators.profiling import outlier_profile, outlier_rows
from tabspark.operators.scale import fit_scaler

NAN = float("nan")


def test_best_epoch_skips_null_and_nan(spark):
    rows = [("a", 1, 0.9), ("a", 2, None), ("a", 3, NAN), ("a", 4, 0.5), ("b", 1, None)]
    h = spark.createDataFrame(rows, "run_id string, epoch long, value double")
    assert sorted(map(tuple, best_epoch(h).collect())) == [("a", 1, 0.9), ("b", None, None)]
    assert ("a", 4, 0.5) in set(map(tuple, best_epoch(h, "min").collect()))


def test_nan_is_no_outlier(spark):
    rows = [(k, float(k % 5)) for k in range(50)] + [(50, NAN), (51, NAN), (52, 1000.0), (53, None)]
    df = spark.createDataFrame(rows, "id long, x double")
    row = outlier_profile(df, ["x"]).first()
    assert (row.outlier_count, row.max) == (1, 1000.0)
    assert [r.id for r in outlier_rows(df, ["x"], "id").collect()] == [52]


def test_scaler_leaves_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (NAN,), (None,)], "x double")
    model = fit_scaler(df, ["x"])
    assert (model.mean["x"], model.scale["x"]) == (pytest.approx(2.0), pytest.approx(1.0)) and not math.isnan(model.mean["x"])


def test_target_correlation_of_pair_complete_rows(spark):
    import numpy as np

    from tabspark.operators import profiling as P
    nan = float("nan")
    rows = [(1.0, 5.0, 1), (2.0, 5.0, 0), (None, 6.0, None), (4.0, nan, 1), (8.0, 5.0, 0), (3.0, 5.0, 1)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    got = {r["feature"]: r["corr"] for r in P.target_correlation(df, ["a", "b"], "y").collect()}
    want = np.corrcoef([1, 2, 4, 8, 3], [1, 0, 1, 0, 1])[0, 1]
    assert got == {"a": round(float(want), 4), "b": None}  # b is constant where y is known
    assert [r["corr"] for r in P.target_correlation(df.limit(0), ["a"], "y").collect()] == [None]


def test_report_without_a_label_and_with_unmapped_targets(spark):
    from tabspark.operators import profiling as P
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, None)], "a double, y int")
    keys = [(r["section"], r["key"]) for r in P.eda_report(df, ["a"], "y").collect()]
    assert ("target", "no_class") in keys and ("target", "class_1") in keys
    assert not any(s == "target" for s, _ in [(r["section"], r["key"]) for r in P.eda_report(df, ["a"], None).collect()])
