"""History windows against a Python replay of early stopping / checkpointing."""

import numpy as np

from tabspark.operators import history as H


def replay(values, patience):
    best, wait, stop = -np.inf, 0, None
    best_ep = None
    for e, v in enumerate(values, 1):
        if v > best:
            best, wait, best_ep = v, 0, e
        else:
            wait += 1
            if wait >= patience and stop is None:
                stop = e
    return stop, best_ep


def test_early_stop_and_best_epoch(spark):
    rng = np.random.default_rng(11)
    runs = {r: list(np.round(rng.random(rng.integers(5, 40)), 2)) for r in range(20)}
    rows = [(r, e + 1, float(v)) for r, vs in runs.items() for e, v in enumerate(vs)]
    h = spark.createDataFrame(rows, "run_id int, epoch int, value double")
    es = {r["run_id"]: r for r in H.early_stop(h, patience=5).collect()}
    stops = {k: (r["stop_epoch"] if r["early_stopped"] else None) for k, r in es.items()}
    assert all(r["early_stopped"] or r["stop_epoch"] == r["n_epochs"] for r in es.values())
    best = {r["run_id"]: r["best_epoch"] for r in H.best_epoch(h).collect()}
    for r, vs in runs.items():
        s, b = replay(vs, 5)
        assert stops[r] == s
        assert best[r] == int(np.argmax(vs)) + 1  # ties → first
    bsf = H.best_so_far(h).where("run_id = 3").orderBy("epoch").collect()
    assert [x["best_so_far"] for x in bsf] == list(np.maximum.accumulate(runs[3]))


def test_prune_trials(spark):
    rows = [(0, 1, 0.5), (0, 2, 0.6), (1, 1, 0.9), (1, 2, 0.9), (2, 1, 0.1), (2, 2, 0.2)]
    h = spark.createDataFrame(rows, "run_id int, epoch int, value double")
    got = {r["run_id"]: (r["pruned"], r["pruned_at"]) for r in H.prune_trials(h).collect()}
    assert got == {0: (False, 2), 1: (False, 2), 2: (True, 1)}


def test_early_stop_ignores_partition_layout(spark):
    rows = [(0, i + 1, v) for i, v in enumerate([0.9, None, 0.5, 0.4, 0.3])]
    h = spark.createDataFrame(rows, "run_id int, epoch int, value double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            r = H.early_stop(h, patience=3).first()
            assert (r["stop_epoch"], r["early_stopped"]) == (4, True)
            assert [x["best_so_far"] for x in H.best_so_far(h).orderBy("epoch").collect()] == [0.9] * 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
