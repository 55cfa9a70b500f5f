"""MLP kernels and Spark scoring/training (reference test shapes on DataFrames)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tabspark.operators import history as H
from tabspark.operators import mlp_math as MM
from tabspark.operators.minibatch import places, round_keys
from tabspark.operators.mlp import MlpClassifier, MlpModel, PreprocessScorer, fixed_model
from tabspark.operators.mlp_math import MlpParams
from tabspark.operators.scale import IdentityScaler, ScalerModel, fit_scaler
from tabspark.schema import FEATURES


def _rows(n, seed=42):
    rng = np.random.default_rng(seed)
    return [(i,) + tuple(float(v) for v in rng.uniform(1, 100, 21)) + (int(rng.integers(0, 2)),) for i in range(n)]


def _df(spark, n=10, seed=42):
    return spark.createDataFrame(_rows(n, seed), ["id"] + FEATURES + ["label"])


def test_forward_shape_no_nan():
    p = MlpParams(input_size=21, hidden_sizes=[64, 32], dropout=0.2)
    out = MM.predict_logits(p, MM.init_weights(p), np.random.default_rng(0).normal(size=(4, 21)))
    assert out.shape == (4, 2) and not np.isnan(out).any()


def test_training_step_loss_positive_and_validation():
    p = MlpParams(input_size=5, hidden_sizes=[10, 5], dropout=0.1)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(8, 5)), rng.integers(0, 2, 8)
    w = MM.init_weights(p)
    logits, cache, _ = MM.forward(p, w, x, train=True, rng=rng)
    loss, grad = MM.loss_and_grad(p, logits, y, np.ones(2))
    assert loss > 0 and grad.shape == (8, 2)
    vloss, _ = MM.loss_and_grad(p, MM.predict_logits(p, w, x), y, np.ones(2))
    assert np.isfinite(vloss)


def test_schedule_and_layer_sizes():
    p = MlpParams(learning_rate=0.01)
    assert MM.lr_at(p, 0) == 0.01
    assert MM.lr_at(p, 10) == 0.01  # warm restart after T0 = 10 epochs
    assert MM.lr_at(p, 5) == pytest.approx(1e-6 + (0.01 - 1e-6) * 0.5)
    assert MM.hidden_sizes_for(21) == [64, 32, 16]


def test_finite_difference_gradients():
    for bn in (True, False):
        for focal in (True, False):
            p = MlpParams(input_size=4, hidden_sizes=[5, 3], dropout=0.0, use_batchnorm=bn,
                          use_focal_loss=focal, num_classes=3)
            w = MM.init_weights(p, 3)
            rng = np.random.default_rng(0)
            x, y, alpha = rng.normal(size=(6, 4)), rng.integers(0, 3, 6), np.array([0.5, 1.0, 2.0])

            def L(ww):
                lg = MM.forward(p, ww, x, train=True, rng=np.random.default_rng(1))[0]
                return MM.loss_and_grad(p, lg, y, alpha)[0]
            lg, cache, _ = MM.forward(p, w, x, train=True, rng=np.random.default_rng(1))
            g = MM.backward(p, w, cache, MM.loss_and_grad(p, lg, y, alpha)[1])
            for name, shape, tr in MM.param_shapes(p):
                if not tr:
                    continue
                for idx in list(np.ndindex(*shape))[:6]:
                    w2 = {k: v.copy() for k, v in w.items()}
                    w2[name][idx] += 1e-6
                    a = L(w2)
                    w2[name][idx] -= 2e-6
                    assert (a - L(w2)) / 2e-6 == pytest.approx(g[name][idx], abs=1e-6)


def test_predict_columns_and_types(spark):
    df = _df(spark)
    out = fixed_model(FEATURES).transform(df)
    r = out.first()
    assert isinstance(r["prediction"], int) and isinstance(r["is_defect"], bool)
    assert 0.0 <= r["defect_probability"] <= 1.0 and r["confidence"] >= 0.5
    assert abs(sum(r["probabilities"]) - 1.0) < 1e-12
    assert out.count() == 10
    logits = fixed_model(FEATURES).transform(df, output="logits").first()["logits"]
    assert len(logits) == 2


def test_scaler_identity_and_scaled_mean(spark):
    df = _df(spark)
    assert IdentityScaler(FEATURES).transform(df) is df
    sc = fit_scaler(df, FEATURES)
    scaled = sc.transform(df).agg(*[F.avg(F.col(f"`{f}`")).alias(f"m{i}") for i, f in enumerate(FEATURES)]).first()
    assert all(abs(v) < 1 for v in scaled)
    pop = sc.transform(df).agg(F.stddev_pop(F.col("loc"))).first()[0]
    assert pop == pytest.approx(1.0)
    const = spark.createDataFrame([(1.0,), (1.0,)], "loc double")
    assert fit_scaler(const, ["loc"]).scale["loc"] == 1.0


def test_batches_keep_sizes(spark):
    # three frames of 3/4/3 rows scored in one pass keep their sizes
    frames = [_df(spark, n, seed) for n, seed in ((3, 1), (4, 2), (3, 3))]
    tagged = frames[0].withColumn("batch_id", F.lit(0))
    for i, f in enumerate(frames[1:], 1):
        tagged = tagged.unionByName(f.withColumn("batch_id", F.lit(i)))
    out = PreprocessScorer(None, fixed_model(FEATURES)).transform(tagged)
    sizes = {r["batch_id"]: r["count"] for r in out.groupBy("batch_id").count().collect()}
    assert sizes == {0: 3, 1: 4, 2: 3}


def test_save_load_identity(spark, tmp_out):
    m = fixed_model(FEATURES)
    m.write(spark, f"{tmp_out}/model")
    back = MlpModel.read(spark, f"{tmp_out}/model")
    for k, v in m.weights.items():
        np.testing.assert_array_equal(back.weights[k], v)
    df = _df(spark)
    sc = fit_scaler(df, FEATURES)
    sc.write(spark, f"{tmp_out}/scaler")
    sb = ScalerModel.read(spark, f"{tmp_out}/scaler", FEATURES)
    assert sb.mean == sc.mean and sb.scale == sc.scale


def test_fit_history_matches_window_replay(spark):
    from tabspark.plans import catalog as C
    sp = C.split_metrics(spark, SF01).persist()
    scaled = C.fitted_scaler(sp).transform(sp)
    res = MlpClassifier(MlpParams(max_epochs=6, patience=2), FEATURES, "label", num_partitions=2).fit(
        scaled.where("split = 'train'"), scaled.where("split = 'val'"))
    hist = res.history.where("metric = 'val_f1'").select("run_id", "epoch", "value")
    assert hist.count() >= 3
    be = H.best_epoch(hist).first()
    assert be["best_epoch"] == res.best_epoch
    st = H.early_stop(hist, patience=2).first()
    assert (st["stop_epoch"] if st["early_stopped"] else None) == res.stopped_epoch
    # the best model scores the validation split
    out = res.best.transform(scaled.where("split = 'val'"))
    assert out.count() == scaled.where("split = 'val'").count()


def test_one_partition_fit_equals_sequential_numpy(spark):
    """With one partition the distributed fit is plain sequential mini-batch
    training (reference semantics): replay it with NumPy and compare weights."""
    rng = np.random.default_rng(3)
    n, k = 150, 4
    x = rng.normal(size=(n, k)).astype(np.float32).astype(np.float64)
    y = (x[:, 0] + 0.3 * rng.normal(size=n) > 0.5).astype(int)
    rows = [tuple(float(v) for v in x[i]) + (int(y[i]),) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label int").coalesce(1)
    p = MlpParams(hidden_sizes=[6, 3], max_epochs=3, patience=10, batch_size=16)
    res = MlpClassifier(p, ["a", "b", "c", "d"], "label").fit(df, df)

    pp = p.replace(input_size=k)
    w = MM.init_weights(pp)
    m = {name: np.zeros_like(a) for name, a in w.items()}
    v = {name: np.zeros_like(a) for name, a in w.items()}
    counts = np.bincount(y, minlength=2)
    alpha = n / (2 * counts)
    t = 0
    for epoch in range(3):
        order = np.argsort(places(n, round_keys(pp.seed, epoch)))  # the epoch's global order; 6 rows of 150 are left out
        batches = [(x[i], y[i]) for i in (order[s:s + 16] for s in range(0, 144, 16))]
        steps, *_ = MM.train_batches(pp, w, m, v, t, MM.lr_at(pp, epoch), batches, alpha,
                                     np.random.default_rng([pp.seed, epoch, 0]))
        t += steps
    assert res.steps == [(e, 144, 9) for e in range(3)]
    for name in w:
        # pre-batch-norm biases have zero gradient: only ~1e-12 Adam noise differs there
        np.testing.assert_allclose(res.last.weights[name], w[name], rtol=1e-9, atol=1e-10)


def test_resume_after_restart_equals_uninterrupted(spark, tmp_out):
    rng = np.random.default_rng(9)
    rows = [tuple(float(v) for v in rng.normal(size=3)) + (int(rng.integers(0, 2)),) for _ in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    feats = ["a", "b", "c"]
    p = MlpParams(hidden_sizes=[5], max_epochs=4, patience=10, batch_size=16)
    full = MlpClassifier(p, feats, "label", num_partitions=2).fit(df, df)
    # "driver dies" after two epochs, then a new fit resumes from the shared folder
    MlpClassifier(p.replace(max_epochs=2), feats, "label", num_partitions=2).fit(df, df, resume_dir=f"{tmp_out}/st")
    resumed = MlpClassifier(p, feats, "label", num_partitions=2).fit(df, df, resume_dir=f"{tmp_out}/st")
    for name in full.last.weights:
        np.testing.assert_allclose(resumed.last.weights[name], full.last.weights[name], rtol=1e-12, atol=1e-15)
    assert resumed.history.count() == full.history.count() == 4 * 11
    assert resumed.best_epoch == full.best_epoch


def test_an_epoch_sees_every_row():
    """Also the last, smaller batch; a last row of its own joins the batch before it."""
    from tabspark.operators import mlp_math as MM
    p = MlpParams(batch_size=8)
    rng = np.random.default_rng(0)
    for n in (2, 7, 8, 9, 17, 30):
        w = MM.init_weights(p)
        m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
        x, y = rng.normal(size=(n, p.input_size)), rng.integers(0, 2, n)
        steps, _, seen, conf = MM.train_partition(p, w, m, v, 0, 1e-3, x, y, np.ones(2), np.random.default_rng(1))
        assert seen == n == conf.sum() and steps == max(1, (n - 1 + 7 - (n % 8 == 1) * 7) // 8)


def test_registered_fit_runs_the_configured_schedule(spark):
    from __spark_entry__ import queries
    p = MlpParams()
    rows = queries()["mlp_fit"](spark, "/root/testdata/sf0.001").where("metric = 'val_f1'").collect()
    f1 = {r.epoch: r.value for r in rows}
    best = min(e for e in f1 if f1[e] == max(f1.values()))
    assert p.t0 < len(f1) and p.patience < len(f1)  # a restart and an early stop can happen
    assert len(f1) == p.max_epochs or max(f1) - best == p.patience


def test_partitions_follow_the_rows(spark, monkeypatch):
    from tabspark.operators import mlp
    monkeypatch.setattr(mlp, "PARTITION_ROWS", 100)
    assert [mlp.partitions_for(spark.range(n)) for n in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]


def test_learner_steps_equal_tensorwise_adamw():
    """One array for all tensors gives the bits of an update a tensor, and only that array is updated."""
    for bn in (True, False):
        p = MlpParams(input_size=4, hidden_sizes=[6, 3], use_batchnorm=bn)
        rng = np.random.default_rng(2)
        w = MM.init_weights(p)
        m, v = ({n: np.zeros_like(a) for n, a in w.items()} for _ in range(2))
        start = {n: a.copy() for n, a in w.items()}
        learner, alpha, lr = MM.Learner(p, w, m, v, 0), np.array([0.7, 1.9]), 1e-2
        for t in range(1, 6):
            x, y = rng.normal(size=(9, 4)), rng.integers(0, 2, 9)
            logits, cache, running = MM.forward(p, w, x, train=True, rng=np.random.default_rng(t))
            g = MM.backward(p, w, cache, MM.loss_and_grad(p, logits, y, alpha)[1])
            for n, _, trainable in MM.param_shapes(p):
                if trainable:
                    m[n] = p.beta1 * m[n] + (1 - p.beta1) * g[n]
                    v[n] = p.beta2 * v[n] + (1 - p.beta2) * g[n] * g[n]
                    w[n] = (w[n] * (1 - lr * p.weight_decay)
                            - lr * (m[n] / (1 - p.beta1 ** t)) / (np.sqrt(v[n] / (1 - p.beta2 ** t)) + p.eps))
            w.update(running)
            loss, conf = learner.step(x, y, lr, alpha, np.random.default_rng(t))
            assert loss > 0 and sum(conf) == 9
        assert learner.step(x[:1], y[:1], lr, alpha, rng) is None and learner.t == 5
        for own, want in ((learner.w, w), (learner.m, m), (learner.v, v)):
            assert all(np.array_equal(own[n], want[n]) for n in want)
        assert all(np.shares_memory(learner.w[n], learner.flat[0]) for n, _, tr in MM.param_shapes(p) if tr)
        assert any(not np.array_equal(start[n], w[n]) for n in w)


def test_minibatches_of_a_stream_of_arrow_batches():
    """Mini-batches that span Arrow batches, also empty ones, come whole and in order; a null feature is NaN."""
    import pyarrow as pa
    from tabspark.operators.mlp import _batches
    b = np.repeat([0, 2, 4, 6], [32, 32, 32, 7]).astype(np.int64)
    n = len(b)
    t = pa.table({"x0": pa.array([None, *np.arange(1.0, n)], pa.float32()), "x1": pa.array(-np.arange(n), pa.float32()),
                  "y": pa.array(np.arange(n) % 2, pa.int32()), "__b": b})
    for size in (1, 5, 32, 50, 200):
        stream = [t.slice(0, 0).combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], t.schema)], t.to_batches(size)]
        got = list(_batches((r for part in stream for r in part), 2))
        assert [x.shape for x, _ in got] == [(32, 2)] * 3 + [(7, 2)]
        x, y = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        assert np.isnan(x[0, 0]) and np.array_equal(x[1:, 0], np.arange(1.0, n)) and np.array_equal(x[:, 1], -np.arange(n))
        assert np.array_equal(y, np.arange(n) % 2) and y.dtype == np.int64
    assert list(_batches(iter([]), 2)) == []
