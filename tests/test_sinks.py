"""Sinks (S3, S4, S6-S9) and mini-batching (T5)."""

import json
import os

import numpy as np
from pyspark.sql import functions as F

from tabspark.operators import mlp_math as MM
from tabspark.operators.mlp import fixed_model
from tabspark.schema import FEATURES
from tabspark.sources import files as IO


def _df(spark, n=12):
    rng = np.random.default_rng(0)
    rows = [(i,) + tuple(float(v) for v in rng.uniform(1, 9, 21)) + (i % 3 == 0 and "TRUE" or "FALSE",)
            for i in range(n)]
    return spark.createDataFrame(rows, ["id"] + FEATURES + ["defects"])


def test_table_splits_metadata_predictions_metrics(spark, tmp_out):
    df = _df(spark)
    IO.write_table(df, f"{tmp_out}/raw")
    assert spark.read.parquet(f"{tmp_out}/raw").count() == 12
    sp = df.withColumn("split", F.when(F.col("id") < 8, "train").when(F.col("id") < 10, "val").otherwise("test"))
    IO.write_splits(sp, f"{tmp_out}/splits")
    assert sorted(d for d in os.listdir(f"{tmp_out}/splits") if d.startswith("split=")) == [
        "split=test", "split=train", "split=val"]
    test = IO.read_split(spark, f"{tmp_out}/splits", "test")
    assert test.count() == 2
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "split" in plan
    meta = {r["split"]: r["n_samples"] for r in IO.write_split_metadata(sp, f"{tmp_out}/meta").collect()}
    assert meta == {"train": 8, "val": 2, "test": 2}
    files = [f for f in os.listdir(f"{tmp_out}/meta") if f.endswith(".json")]
    first = json.loads(open(os.path.join(tmp_out, "meta", files[0])).readline())
    assert first["feature_names"] == FEATURES and first["scaler"] == "StandardScaler"
    scored = fixed_model(FEATURES).transform(df)
    IO.write_predictions(scored, f"{tmp_out}/pred_csv", fmt="csv")
    back = spark.read.option("header", True).csv(f"{tmp_out}/pred_csv")
    assert back.count() == 12 and "prediction" in back.columns and "logits" not in back.columns
    IO.write_metrics(spark.createDataFrame([(0.5, 0.25)], "accuracy double, f1 double"), f"{tmp_out}/metrics")
    assert spark.read.json(f"{tmp_out}/metrics").first()["accuracy"] == 0.5
    unl = IO.unlabelled_features(df.drop("defects"))
    assert unl.columns == ["id"] + FEATURES


def test_minibatches_seeded_and_of_all_rows():
    p = MM.MlpParams(input_size=3, hidden_sizes=[4], dropout=0.0, batch_size=32)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(100, 3)), rng.integers(0, 2, 100)

    def run(seed, **kw):
        w = MM.init_weights(p, 1)
        m = {k: np.zeros_like(v) for k, v in w.items()}
        v = {k: np.zeros_like(a) for k, a in w.items()}
        steps, _, seen, _ = MM.train_partition(p, w, m, v, 0, 1e-3, x, y, np.ones(2), np.random.default_rng(seed), **kw)
        return steps, seen, MM.flatten(p, w)
    s1, n1, w1 = run(5)
    s2, n2, w2 = run(5)
    assert (s1, n1) == (4, 100)  # three full batches of 32 and one of 4
    assert run(5, drop_last=True)[:2] == (3, 96)  # the last one left out
    np.testing.assert_array_equal(w1, w2)
    assert not np.array_equal(w1, run(6)[2])
    # a partition smaller than one batch keeps its rows as one batch
    w = MM.init_weights(p, 1)
    z = {k: np.zeros_like(a) for k, a in w.items()}
    steps, _, seen, _ = MM.train_partition(p, w, z, {k: a.copy() for k, a in z.items()}, 0, 1e-3,
                                           x[:5], y[:5], np.ones(2), np.random.default_rng(0))
    assert (steps, seen) == (1, 5)
