"""Hyper-parameter trials with median pruning (ML12, W5), side by side.

All trials are a bank of live models: one job an epoch trains every live trial
(``mlp.Trainer``), so the jobs of a study follow its longest trial, not their
number. The rule is that of trials run one after another: once ``n_startup``
trials have finished, a trial whose best-so-far is below the median of the
finished earlier trials' values at the same epoch is pruned (the median rule of
W5). Whether an earlier trial will finish can be unknown while it is live; a trial
after it then goes on, and is cut back to the epoch at which the rule holds once
that is known. Table and history are those of the sequential study.
"""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame

from tabspark.operators.mlp import Run, Trainer
from tabspark.operators.mlp_math import MlpParams
from tabspark.session import local_frame


def prune_epoch(values: dict[int, float], finished: list[dict[int, float]], n_startup: int) -> int | None:
    """The first epoch at which the median rule prunes a trial, given the finished trials before it."""
    best = -np.inf
    for epoch, v in sorted(values.items()):
        best = max(best, v)
        at = [h[epoch] for h in finished if epoch in h]
        if len(finished) >= n_startup and at and best < float(np.median(at)):
            return epoch
    return None


class _Study:
    """The state of every trial: live, or its end; a pruned one has its last epoch in ``cut``."""

    def __init__(self, runs: list[Run], n_startup: int):
        self.runs, self.n_startup, self.cut = runs, n_startup, {}

    def values(self, t: int) -> dict[int, float]:
        return {e: v for _, e, name, v in self.runs[t].rows if name == "val_f1" and e <= self.cut.get(t, e)}

    def settle(self) -> None:
        """Prunes what can be pruned by now. A trial is judged when every one before it is pruned, over, or sure to finish
        (fewer than ``n_startup`` can have finished before it)."""
        kept: list[int] = []
        for t, run in enumerate(self.runs):
            if t not in self.cut:
                known = min((self.runs[s].epoch for s in kept if not self.runs[s].over), default=run.epoch)
                values = {e: v for e, v in self.values(t).items() if e < known}
                epoch = prune_epoch(values, [self.values(s) for s in kept], self.n_startup)
                if epoch is not None:
                    self.cut[t] = epoch
            if t not in self.cut:
                kept.append(t)
                if not run.over and len(kept) > self.n_startup:
                    return  # it may still be pruned, so the trials after it wait

    def live(self) -> list[Run]:
        return [r for t, r in enumerate(self.runs) if t not in self.cut and not r.over]


def tune(train: DataFrame, val: DataFrame, features: list[str], label: str, base: MlpParams,
         grid: list[dict], n_startup: int = 1, num_partitions: int | None = None,
         resume_dir: str | None = None):
    """(table, history, base parameters) of the study. With ``resume_dir`` every trial keeps its
    per-epoch state there (run id ``trial-<i>``), so a restarted study continues where it stopped."""
    trainer = Trainer(train, val, features, label, num_partitions, base.num_classes)
    runs = [Run(base.replace(**o).replace(input_size=len(features)), f"trial-{t}") for t, o in enumerate(grid)]
    if resume_dir:
        for r in runs:
            r.load(trainer.spark, resume_dir)
    study = _Study(runs, n_startup)
    study.settle()
    while live := study.live():
        now = [r for r in live if r.epoch == min(x.epoch for x in live)]  # those behind, after a restart
        trainer.epoch(now)
        if resume_dir:
            for r in now:
                r.save(trainer.spark, resume_dir)
        study.settle()
    trials, rows = [], []
    for t, (overrides, run) in enumerate(zip(grid, runs)):
        values = study.values(t)
        best = max(values.values(), default=None)
        trials.append((t, json.dumps(overrides, sort_keys=True), "PRUNED" if t in study.cut else "COMPLETE", best, len(values),
                       min((e for e, v in values.items() if v == best), default=-1)))
        rows += [r for r in run.rows if r[1] in values]
    table = local_frame(trainer.spark, trials, "trial int, params string, state string, best_val_f1 double, epochs_run int, best_epoch int")
    return table, local_frame(trainer.spark, rows, "run_id string, epoch int, metric string, value double"), asdict(base)
