"""Training-history operators.

A history has one row per (run, epoch, value). Running quantities over a
run's epochs use the ordered scan of ``operators.scan`` (two-level windows over range
partitions on (run, epoch)), so a run with a huge history is spread over many
tasks instead of one window partition; per-run results are plain grouped
aggregates (partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.scan import Spec, ordered_scan


EVENT_ORDER = ("ts", "event_id")


def event_runs(events: DataFrame) -> DataFrame:
    """events as an un-numbered history: user_id = run, order = (ts, event_id).
    Operators below number the epochs in the same scan that computes their
    running values (pass ``order_cols=EVENT_ORDER``)."""
    return events.select(F.col("user_id").alias("run_id"), "ts", "event_id", "value")


def events_history(events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """events as a history: user_id = run, epoch = rank of (ts, event_id) in the run."""
    out = ordered_scan(event_runs(events), ["run_id"], list(EVENT_ORDER), [Spec("epoch", "row_number")],
                       num_partitions)
    return out.select("run_id", "epoch", "value")


def _signed(history: DataFrame, mode: str) -> DataFrame:
    return history.withColumn("__v", F.col("value") if mode == "max" else -F.col("value"))


def _scan(history: DataFrame, specs, order_cols) -> DataFrame:
    """One ordered scan per run; numbers the epochs too when the history has none."""
    order = list(order_cols)
    if "epoch" not in history.columns:
        specs = [Spec("epoch", "row_number")] + list(specs)
    return ordered_scan(history, ["run_id"], order, list(specs))


def best_so_far(history: DataFrame, mode: str = "max", order_cols=("epoch",)) -> DataFrame:
    """Running best per run (W1); null and NaN values change nothing, and it is null before the first value."""
    h = _scan(_signed(history, mode), [Spec("__b", "cummax", "__v")], order_cols)
    best = F.col("__b") if mode == "max" else -F.col("__b")
    return h.select("run_id", "epoch", "value", best.alias("best_so_far"))


def last_improvement(history: DataFrame, mode: str = "max", order_cols=("epoch",)) -> DataFrame:
    """Adds ``last_improved``: the latest epoch <= this one with a strict
    improvement, i.e. the first epoch reaching the running best."""
    numbered = "epoch" not in history.columns
    spec = Spec("last_improved", "argmax_first", "__v", None if numbered else "epoch")
    h = _scan(_signed(history, mode), [spec], order_cols)
    return h.select("run_id", "epoch", "value", "last_improved")


def early_stop(history: DataFrame, patience: int = 10, mode: str = "max", order_cols=("epoch",)) -> DataFrame:
    """Per run: the epoch at which early stopping fires (first epoch with
    ``patience`` epochs since the last strict improvement), or null (W2)."""
    h = last_improvement(history, mode, order_cols)
    fired = F.when(F.col("epoch") - F.col("last_improved") >= patience, F.col("epoch"))
    agg = h.groupBy("run_id").agg(F.min(fired).alias("__s"), F.max("epoch").alias("n_epochs"))
    # stop_epoch = last epoch run (the firing epoch, or the last one when it never fires)
    return agg.select("run_id", F.coalesce("__s", "n_epochs").cast("bigint").alias("stop_epoch"),
                      F.col("__s").isNotNull().alias("early_stopped"), F.col("n_epochs").cast("bigint").alias("n_epochs"))


def best_epoch(history: DataFrame, mode: str = "max") -> DataFrame:
    """Top-1 checkpoint per run: best value, ties → first epoch (W3); null and NaN values are never
    best, and a run without any other has null results.
    A grouped ``min`` over (-value, epoch): partial aggregation, no window."""
    key = -F.col("value") if mode == "max" else F.col("value")
    seen = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    agg = history.groupBy("run_id").agg(F.min(F.when(seen, F.struct(key.alias("k"), F.col("epoch").alias("e")))).alias("m"))
    val = -F.col("m.k") if mode == "max" else F.col("m.k")
    return agg.select("run_id", F.col("m.e").alias("best_epoch"), val.alias("best_value"))


def median_rule(history: DataFrame, completed: DataFrame, patience: int, max_epochs: int) -> DataFrame:
    """(run_id, rule_state, rule_epochs, rule_best): the median rule of a study replayed over its history (W2, W3, W5
    together). Run ids are in order of trials; ``completed`` holds those that are said to have completed.

    A trial is PRUNED if its best-so-far falls below the median of the earlier completed trials' values at its last
    epoch and at no other; COMPLETE if it never does and ended by ``patience`` or at ``max_epochs``; else BROKEN.
    Histories have a row a trial and epoch, and are small next to the data that they were trained on."""
    b = last_improvement(history).join(best_so_far(history).select("run_id", "epoch", "best_so_far"), ["run_id", "epoch"])
    ends = b.groupBy("run_id").agg(F.max("epoch").alias("last"), F.max_by("last_improved", "epoch").alias("rule_best"))
    other = history.join(completed.select("run_id"), "run_id").select(F.col("run_id").alias("other"), F.col("epoch").alias("e"), F.col("value").alias("v"))
    at = b.join(other, (F.col("e") == F.col("epoch")) & (F.col("other") < F.col("run_id")), "left")
    at = at.groupBy("run_id", "epoch").agg(F.first("best_so_far").alias("best"), F.expr("percentile(v, 0.5)").alias("median"))
    fired = at.groupBy("run_id").agg(F.min(F.expr("CASE WHEN best < median THEN epoch END")).alias("fired"))
    state = F.expr(f"CASE WHEN fired = last THEN 'PRUNED' WHEN fired IS NULL AND (last - rule_best >= {patience} OR last = {max_epochs - 1})"
                   " THEN 'COMPLETE' ELSE 'BROKEN' END")
    return ends.join(fired, "run_id").select("run_id", state.alias("rule_state"), (F.col("last") + 1).alias("rule_epochs"), "rule_best")


def prune_trials(history: DataFrame, mode: str = "max", warmup: int = 0, order_cols=("epoch",)) -> DataFrame:
    """Median pruning (W5): a trial is pruned at the first step whose best-so-far
    is worse than the median of all trials' values reported at that step.

    Per-step medians are exact grouped quantiles, one plan for steps of any size, and are attached to the
    rows without gathering a step (``operators.skew``): every run has a first step."""
    from tabspark.operators.quantiles import grouped_quantiles
    from tabspark.operators.skew import attach
    b = best_so_far(history, mode, order_cols)
    med = grouped_quantiles(b, ["epoch"], "value", [0.5]).select("epoch", F.col("q0").alias("step_median"))
    rows = b.groupBy("epoch").agg(F.count(F.lit(1)).alias("__rows"))
    j = attach(b, med.join(rows, "epoch").checkpoint(eager=True), ["epoch"], "__rows", ["run_id"])
    worse = (F.col("best_so_far") < F.col("step_median")) if mode == "max" else (F.col("best_so_far") > F.col("step_median"))
    fired = F.when(worse & (F.col("epoch") > warmup), F.col("epoch"))
    agg = j.groupBy("run_id").agg(F.min(fired).alias("__p"), F.max("epoch").alias("__last"))
    # pruned_at = the pruning step, or the last reported step of a trial that was never pruned
    return agg.select("run_id", F.col("__p").isNotNull().alias("pruned"),
                      F.coalesce("__p", "__last").cast("bigint").alias("pruned_at"))
