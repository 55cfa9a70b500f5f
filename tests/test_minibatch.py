"""Mini-batch plans, the tree of vector sums, and trials side by side."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import minibatch as B
from tabspark.operators import mlp, tuning
from tabspark.operators.mlp import MlpClassifier
from tabspark.operators.mlp_math import MlpParams


@pytest.mark.parametrize("n", [1, 2, 3, 5, 31, 32, 97, 1000, 65_537])
def test_places_are_a_permutation(n):
    seen = [B.places(n, B.round_keys(7, e)) for e in range(3)]
    for p in seen:
        assert np.array_equal(np.sort(p), np.arange(n))
    if n > 90:
        assert not np.array_equal(seen[0], seen[1])
        # far from the identity: neighbours part, and a run of rows spreads over all batches
        assert np.abs(np.diff(seen[0])).mean() > n / 6
        assert n < 1000 or len(set((seen[0][: n // 3] * 10 // n).tolist())) == 10  # 33 rows may miss one in ten


@pytest.mark.parametrize("n,drop", [(0, True), (1, True), (20, True), (32, True), (33, True), (33, False), (34, False), (100, True), (100, False)])
def test_plan_covers_the_table(spark, n, drop):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("k"))
    rows = B.minibatch_plan(df, "k", epochs=2, drop_last=drop).collect()
    left_out = n % 32 if drop and n > 32 else 0
    for e in (0, 1):
        own = [r for r in rows if r.epoch == e]
        assert len({r.id for r in own}) == len(own) == n - left_out
        sizes = {}
        for r in own:
            sizes[r.batch] = sizes.get(r.batch, 0) + 1
        assert sorted(sizes) == list(range(B.batch_count(n, 32, drop)))
        assert all(v == 32 for b, v in sizes.items() if b < len(sizes) - 1)
        assert not sizes or sizes[len(sizes) - 1] == {(33, False): 33, (34, False): 2, (100, False): 4}.get((n, drop), min(n, 32))
        want = B.places(n, B.round_keys(42, e))
        assert all(want[(r.id - 3) // 7] == r.place for r in own)


def test_in_batches_keeps_batches_whole(spark):
    df, n = B.numbered(spark.range(1000).repartition(5).checkpoint())
    d = B.in_batches(df, n, 32, 1, 0, True, 4).withColumn("p", F.spark_partition_id())
    got = d.groupBy("__b").agg(F.count("*").alias("n"), F.countDistinct("p").alias("parts"), F.first("p").alias("p")).collect()
    assert len(got) == 31 and all(r.n == 32 and r.parts == 1 and r.p == r["__b"] % 4 for r in got)


@pytest.mark.parametrize("parts", [1, 2, 7, 30])
def test_tree_sums_equal_plain_sums(spark, parts):
    rng = np.random.default_rng(parts)
    vecs = {(r, p): rng.normal(size=5 + r) for r in range(3) for p in range(parts) if (r, p) != (1, 0)}
    df = spark.createDataFrame([(r, p, v.tolist()) for (r, p), v in vecs.items()], B.VECTORS).repartition(3)
    got = B.vector_sums(df, parts)
    for r in {r for r, _ in vecs}:
        np.testing.assert_allclose(got[r], sum(v for (q, _), v in vecs.items() if q == r), rtol=1e-12)
    again = B.vector_sums(df.repartition(5), parts)
    assert all(np.array_equal(got[r], again[r]) for r in got)  # the order of addition does not depend on the shuffle


def test_shuffled_rows_of_the_tree(spark):
    """One vector a task at the first level, the square root of them at the second."""
    df = spark.range(0, 100, 1, 100).select(F.lit(0).alias("run"), F.col("id").cast("int").alias("part"), F.array(F.lit(1.0)).alias("vec"))
    s = 10
    first = (df.withColumn("s", F.col("part") % s).repartitionById(s, F.col("s")).sortWithinPartitions("run", "s", "part")
             .mapInArrow(B._adder("s"), B.VECTORS))
    assert first.count() == s and B.vector_sums(df, 100)[0].tolist() == [100.0]


def _table(spark, n, seed=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(int)
    return spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, label int")


def test_side_by_side_equals_one_after_another(spark, tmp_out, monkeypatch):
    feats, tr, va = ["a", "b", "c"], _table(spark, 150), _table(spark, 80, 3)
    base = MlpParams(hidden_sizes=[5], max_epochs=6, patience=3, batch_size=16, dropout=0.1)
    grid = [{}, {"learning_rate": 1e-6}, {"learning_rate": 1e-2, "hidden_sizes": [4, 3]}, {"batch_size": 50, "learning_rate": 5e-3}]
    finished, want, history = [], [], []
    for t, o in enumerate(grid):  # the sequential study
        def on_epoch(epoch, metrics, seen={}):
            seen[epoch] = metrics["val_f1"]
            return tuning.prune_epoch(dict(seen), finished, 1) is not None
        on_epoch.__defaults__ = ({},)
        res = MlpClassifier(base.replace(**o), feats, "label", num_partitions=2, run_id=f"trial-{t}").fit(tr, va, on_epoch=on_epoch)
        vals = {r.epoch: r.value for r in res.history.where("metric = 'val_f1'").collect()}
        pruned = tuning.prune_epoch(vals, finished, 1) is not None
        if not pruned:
            finished.append(vals)
        want.append((t, "PRUNED" if pruned else "COMPLETE", max(vals.values()), len(vals), res.best_epoch))
        history += [tuple(r) for r in res.history.collect()]

    jobs = []
    plain = mlp.Trainer.epoch
    monkeypatch.setattr(mlp.Trainer, "epoch", lambda self, runs, on_epoch=None: (jobs.append([r.run_id for r in runs]), plain(self, runs, on_epoch))[1])
    table, hist, _ = tuning.tune(tr, va, feats, "label", base, grid, num_partitions=2, resume_dir=f"{tmp_out}/study")
    got = [(r.trial, r.state, r.best_val_f1, r.epochs_run, r.best_epoch) for r in table.collect()]
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    np.testing.assert_allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9)
    key = lambda r: r[:3]
    a, b = sorted((tuple(r) for r in hist.collect()), key=key), sorted(history, key=key)
    assert [r[:3] for r in a] == [r[:3] for r in b]
    np.testing.assert_allclose([r[3] for r in a], [r[3] for r in b], rtol=1e-7, atol=1e-9)
    assert len(jobs) <= base.max_epochs and len(jobs[0]) == len(grid)  # rounds follow the longest trial
    # a restart reads the states and has nothing left to do
    jobs.clear()
    again, _, _ = tuning.tune(tr, va, feats, "label", base, grid, num_partitions=2, resume_dir=f"{tmp_out}/study")
    assert jobs == [] and [tuple(r) for r in again.collect()] == [tuple(r) for r in table.collect()]


def test_trials_wait_for_a_verdict():
    """A trial after one that may still be pruned goes on, and is cut back when the verdict is known."""
    class R:
        def __init__(self, values, over):
            self.rows, self.epoch, self.over = [("", e, "val_f1", v) for e, v in enumerate(values)], len(values), over
    first, second, third = R([.5, .6], False), R([.7, .7], False), R([.4, .8], False)
    s = tuning._Study([first, second, third], 1)
    s.settle()
    assert s.cut == {} and len(s.live()) == 3  # the second could still be pruned, so the third is not judged
    second.over = first.over = True
    s.settle()
    assert s.cut == {2: 0} and s.values(2) == {0: .4}


@pytest.mark.parametrize("drop", [True, False])
def test_a_place_is_computed_once(spark, drop):
    """The filter on the batch does not repeat the expression of the place."""
    d = spark.range(1000).withColumnRenamed("id", "__n")
    for q in (B.in_batches(d, 1000, 32, 1, 0, drop, 4), B.minibatch_plan(spark.range(1000), "id", 2, drop_last=drop)):
        plan = q._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("48271") == B.place_sql("__n", 1000, "ks").count("48271")
