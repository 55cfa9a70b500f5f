"""Hand-made edge frames (FIXTURES.md §4) across operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import metrics as M
from tabspark.operators import profiling as P
from tabspark.operators.mlp import MlpClassifier
from tabspark.operators.mlp_math import MlpParams
from tabspark.operators.prepare import align_features, assert_width
from tabspark.operators.scale import fit_scaler
from tabspark.operators.split import stratified_split
from tabspark.schema import DEFECT_SCHEMA, FEATURES


def test_all_null_feature(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "x double, z double")
    d = {r["feature"]: r for r in P.describe_numeric(df, ["x", "z"]).collect()}
    assert d["z"]["count"] == 0 and d["z"]["mean"] is None and d["z"]["q50"] is None
    assert d["x"]["q50"] == 2.0
    corr = {(r["feature_a"], r["feature_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "z"]).collect()}
    assert corr[("x", "z")] is None and corr[("x", "x")] == 1.0
    assert P.outlier_profile(df, ["x", "z"]).count() == 0
    sc = fit_scaler(df, ["x", "z"])
    assert sc.scale["z"] == 1.0 and sc.mean["z"] == 0.0


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, label int, prediction int, score double")
    assert P.shape(df).first()["n_rows"] == 0
    assert P.histogram(df, "x").count() == 0
    assert P.kde(df, "x").count() == 0
    r = M.roc_auc(df, "label", "score").first()
    assert (r["roc_auc"], r["n_pos"], r["n_neg"]) == (0.0, 0, 0)
    c = M.confusion(df).first()
    assert c["tp"] is None or c["tp"] == 0
    assert stratified_split(df.withColumn("id", F.lit(1)), "label", "id").count() == 0


def test_single_class_split_and_weights(spark):
    df = spark.createDataFrame([(i, 1) for i in range(10)], "id long, label int")
    sp = {r["split"]: r["count"] for r in stratified_split(df, "label", "id").groupBy("split").count().collect()}
    assert sp == {"test": 2, "val": 1, "train": 7}
    assert M.class_weight_list(df, "label", 2) == [1.0, 1.0]


def test_missing_and_extra_feature_columns(spark):
    cols = [f for f in FEATURES if f != "n"] + ["extra"]
    df = spark.createDataFrame([tuple(1.0 for _ in cols)], cols)
    with pytest.raises(ValueError):
        assert_width(df.schema)
    out = align_features(df)
    assert out.columns == ["extra"] + FEATURES
    assert out.first()["n"] == 0.0
    assert_width(DEFECT_SCHEMA)


def test_training_with_empty_partitions(spark):
    rng = np.random.default_rng(0)
    rows = [tuple(float(v) for v in rng.normal(size=3)) + (int(rng.integers(0, 2)),) for _ in range(6)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    res = MlpClassifier(MlpParams(hidden_sizes=[4], max_epochs=2, batch_size=2), ["a", "b", "c"], "label",
                        num_partitions=16).fit(df, df)
    h = {r["metric"] for r in res.history.collect()}
    assert {"train_loss", "val_f1"} <= h
    assert res.best.transform(df).count() == 6
