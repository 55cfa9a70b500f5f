"""Metrics against brute force on small fixtures."""

import itertools
import math

import numpy as np
import pytest

from tabspark.operators import metrics as M


def brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    if not pos or not neg:
        return 0.0
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_roc_auc_with_ties(spark, parts):
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 400)
    scores = np.round(rng.random(400) + labels * 0.3, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(labels, scores)], "label int, score double")
    got = M.roc_auc(df, "label", "score", num_partitions=parts).first()
    assert got["roc_auc"] == round(brute_auc(labels, scores), 4)
    assert got["n_pos"] == int(labels.sum())


def test_roc_auc_one_class_and_all_tied(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.5)], "label int, score double")
    assert M.roc_auc(df, "label", "score").first()["roc_auc"] == 0.0
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "label int, score double")
    assert M.roc_auc(df, "label", "score").first()["roc_auc"] == 0.5


def test_binary_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = M.binary_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    assert r["accuracy"] == round(2 / 3, 4)
    c = M.confusion(df).first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (0, 0, 2, 1)


def test_class_weights_balanced_and_missing(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = M.class_weight_list(df, "label", 2)
    assert w == pytest.approx([8 / (2 * 6), 8 / (2 * 2)])
    w3 = M.class_weight_list(df, "label", 3)
    assert w3 == [1.0, 1.0, 1.0]
    cc = {r["label"]: r["n"] for r in M.class_counts(df, "label", 3).collect()}
    assert cc == {0: 6, 1: 2, 2: 0}


def test_focal_and_ce_losses(spark):
    logits = [[0.2, -1.0, 0.5], [1.5, 0.1, -0.3], [0.0, 0.0, 0.0]]
    y = [2, 0, 1]
    alpha = [0.5, 1.0, 2.0]
    df = spark.createDataFrame([(l, t) for l, t in zip(logits, y)], "logits array<double>, y int")
    z = np.array(logits)
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    pt = p[np.arange(3), y]
    a = np.array(alpha)[y]
    focal = float(np.mean(a * (1 - pt) ** 2 * -np.log(pt)))
    assert M.mean_loss(df, "logits", "y", "focal", alpha).first()["loss"] == round(focal, 4)
    eps = 0.1
    w = np.array(alpha)
    per = (1 - eps) * a * -np.log(pt) + eps / 3 * (-(np.log(p) * w).sum(1))
    ce = float(per.sum() / a.sum())
    assert M.mean_loss(df, "logits", "y", "ce", alpha, smoothing=eps).first()["loss"] == round(ce, 4)


def test_latency_summary(spark):
    x = [0.01, 0.02, 0.03, 0.5, 0.04]
    df = spark.createDataFrame([(v,) for v in x], "lat double")
    r = M.latency_summary(df, "lat").first()
    assert r["total_requests"] == 5
    assert r["p95_latency"] == round(float(np.percentile(x, 95)), 4)
    assert r["throughput"] == round(5 / sum(x), 4)
    assert math.isclose(r["avg_latency"], round(float(np.mean(x)), 4))


def test_evaluation_scores_each_row_once(spark):
    import pandas as pd
    from pyspark.sql import functions as F
    scored = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        scored.add(len(x))
        return (x * 7 % 5) / 5

    rows = [(i, i % 3 % 2) for i in range(87)] + [(87, None)]
    df = spark.createDataFrame(rows, "id bigint, label int").repartition(4)
    df = df.withColumn("defect_probability", score(F.col("id").cast("double")))
    df = df.withColumn("prediction", (F.col("defect_probability") > 0.5).cast("int"))
    got = M.evaluation(df)
    assert scored.value == 88
    want = M.binary_metrics(df).first().asDict() | {"roc_auc": M.roc_auc(df, "label", "defect_probability").first()["roc_auc"]}
    assert got == want
    assert M.evaluation(df.limit(0)) == {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": 0.0}


def test_an_absent_class_is_named(spark):
    import warnings

    import pytest

    from tabspark.operators.metrics import class_weight_list
    df = spark.createDataFrame([(0,), (0,), (2,)], "label int")
    with pytest.warns(RuntimeWarning, match="class 1:"):
        assert class_weight_list(df, "label", 3) == [1.0, 1.0, 1.0]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert class_weight_list(df.where("label = 0"), "label", 1) == [1.0]
