"""Classification metrics and summaries.

All metrics are single aggregates over the scored table (partial/final
aggregation, one shuffle of tiny partial rows). ROC-AUC is exact with ties
and never ranks the whole table in one task (see ``roc_auc``).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions import sqltext as Q
from tabspark.functions.numeric import nonzero, round4, zero_div
from tabspark.operators.quantiles import wide_quantiles
from tabspark.session import local_frame


# ---------------------------------------------------------------- A14, A15
def class_counts(df: DataFrame, label: str, k: int) -> DataFrame:
    """Count per class 0..k-1, zero-filled."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    classes = spark.range(k).select(F.col("id").cast("int").alias("label"))
    # classes has k rows: bounded
    return (classes.join(F.broadcast(counts.where(F.col("label").between(0, k - 1))), "label", "left")
            .select("label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def class_weights(df: DataFrame, label: str, k: int) -> DataFrame:
    """Balanced weights n/(k*n_c); if any class is absent all weights are 1.0."""
    cc = class_counts(df, label, k)
    w = Window.partitionBy()  # over k rows
    total = F.sum("n").over(w)
    missing = F.max(F.when(F.col("n") == 0, 1).otherwise(0)).over(w)
    weight = F.when(missing == 1, F.lit(1.0)).otherwise(total / nonzero(F.lit(k) * F.col("n")))
    return cc.select("label", "n", weight.alias("weight"))


def class_weight_list(df: DataFrame, label: str, k: int) -> list[float]:
    """The weights by class; a ``RuntimeWarning`` names the classes that have no row, as all weights are 1.0 then."""
    rows = sorted(class_weights(df, label, k).collect(), key=lambda r: r["label"])
    if absent := [r["label"] for r in rows if not r["n"]]:
        warnings.warn(f"no rows of class {', '.join(map(str, absent))}: all class weights are 1.0", RuntimeWarning, stacklevel=2)
    return [float(r["weight"]) for r in rows]


# ---------------------------------------------------------------- A16, A17
def _confusion_aggs(label: Column, pred: Column):
    return [F.sum(F.when((label == 1) & (pred == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
            F.sum(F.when((label == 0) & (pred == 1), 1).otherwise(0)).cast("bigint").alias("fp"),
            F.sum(F.when((label == 0) & (pred == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
            F.sum(F.when((label == 1) & (pred == 0), 1).otherwise(0)).cast("bigint").alias("fn")]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tp, fp, tn, fn."""
    return df.agg(*_confusion_aggs(F.col(label), F.col(prediction)))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 with zero-division → 0."""
    return _ratios(confusion(df, label, prediction))


def _ratios(c: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec = zero_div(tp, tp + fp)
    rec = zero_div(tp, tp + fn)
    f1 = zero_div(2 * tp, 2 * tp + fp + fn)
    return c.select(round4(zero_div(tp + tn, tp + fp + tn + fn)).alias("accuracy"),
                    round4(prec).alias("precision"), round4(rec).alias("recall"), round4(f1).alias("f1"))


# ---------------------------------------------------------------- A18
def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            num_partitions: int | None = None) -> DataFrame:
    """Exact ROC-AUC with ties (Mann-Whitney): sum over distinct scores of
    pos_s * (neg_below_s + neg_s / 2) / (P * N). One class → 0.0.

    Plan: group by score (map-side combined; a hot score is one row), then a
    distributed ordered prefix sum of the negatives over the distinct scores
    (range partitions + carry-ins, ``operators.scan``), then one aggregate.
    """
    lab, s = F.col(label), F.col(score).cast("double")
    return _auc(df.where(lab.isNotNull() & s.isNotNull()).groupBy(s.alias("s")).agg(*_pos_neg(lab)), num_partitions)


def _pos_neg(lab: Column):
    return [F.sum(F.when(lab == 1, 1).otherwise(0)).cast("double").alias("pos"),
            F.sum(F.when(lab != 1, 1).otherwise(0)).cast("double").alias("neg")]


def _auc(g: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """ROC-AUC of (s, pos, neg) rows with distinct scores."""
    from tabspark.operators.scan import Spec, ordered_scan
    scanned = ordered_scan(g, [], ["s"], [Spec("below", "cumsum_excl", "neg")], num_partitions)
    terms = scanned.agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("u"),
                        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.coalesce(F.col("u") / nonzero(F.col("P") * F.col("N")), F.lit(0.0))
    return terms.select(round4(auc).alias("roc_auc"),
                        F.coalesce(F.col("P"), F.lit(0)).cast("bigint").alias("n_pos"),
                        F.coalesce(F.col("N"), F.lit(0)).cast("bigint").alias("n_neg"))


def evaluation(df: DataFrame, label: str = "label", prediction: str = "prediction",
               score: str = "defect_probability") -> dict:
    """accuracy, precision, recall, f1 and roc_auc of a scored frame, which is computed once: the counts
    per distinct score are written with ``checkpoint()`` and both parts read those. Rows without
    a score count for the confusion only; rows without a label count for nothing."""
    from tabspark.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    lab = F.col(label)
    g = (df.groupBy(F.col(score).cast("double").alias("s"))
         .agg(*_confusion_aggs(lab, F.col(prediction)), *_pos_neg(lab)).checkpoint(eager=True))
    out = _ratios(g.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "tn", "fn")])).first().asDict()
    auc = _auc(g.where("s IS NOT NULL AND pos + neg > 0").select("s", "pos", "neg"))
    return {**out, "roc_auc": auc.first()["roc_auc"]}


# ---------------------------------------------------------------- A19
def prediction_summary(df: DataFrame, prediction: str = "prediction",
                       probability: str = "defect_probability") -> DataFrame:
    """rows, predicted defects, mean defect probability."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.sum(F.when(F.col(prediction) == 1, 1).otherwise(0)).cast("bigint").alias("n_defects"),
                  round4(F.avg(probability)).alias("mean_probability"))


# ---------------------------------------------------------------- A20
def mean_loss(df: DataFrame, logits: str, label: str, kind: str = "focal", alpha: list[float] | None = None,
              gamma: float = 2.0, smoothing: float = 0.1) -> DataFrame:
    """Mean focal loss (plain mean) or weighted, label-smoothed cross entropy
    (sum of weighted terms / sum of target weights) of a scored table (A20).

    log-sum-exp is computed once per row as a column; the per-class terms are
    then element lambdas over the logits."""
    from tabspark.functions.arrays import with_log_sum_exp
    y = F.col(label)
    d = with_log_sum_exp(df.select(F.col(logits).alias("__z"), y.alias("__y")), "__z", "__lse")
    logp_y = F.element_at("__z", F.col("__y") + 1).cast("double") - F.col("__lse")
    w = F.array(*[F.lit(float(x)) for x in alpha]) if alpha else None
    wy = F.element_at(w, F.col("__y") + 1) if w is not None else F.lit(1.0)
    if kind == "focal":
        pt = F.exp(logp_y)
        term = wy * F.pow(1 - pt, F.lit(gamma)) * (-logp_y)
        return d.agg(round4(F.avg(term)).alias("loss"))
    lse = F.col("__lse")
    if w is not None:
        smooth = -F.aggregate(F.arrays_zip(F.col("__z").alias("z"), w.alias("w")), F.lit(0.0),
                              lambda acc, e: acc + e["w"] * (e["z"].cast("double") - lse))
    else:
        smooth = -F.aggregate("__z", F.lit(0.0), lambda acc, x: acc + (x.cast("double") - lse))
    term = (1 - smoothing) * wy * (-logp_y) + smoothing / F.size("__z") * smooth
    return d.agg(round4(F.sum(term) / nonzero(F.sum(wy))).alias("loss"))


# ---------------------------------------------------------------- A21
def latency_summary(df: DataFrame, latency: str, batch_size: int = 1) -> DataFrame:
    """Request count, mean, p50/p95/p99 (linear), min, max and throughput
    (samples / total latency) of a latency column (A21)."""
    spark = df.sparkSession
    base = df.select(F.col(latency).cast("double").alias("x"))
    r = base.agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.min("x").alias("mn"),
                 F.max("x").alias("mx"), F.sum("x").alias("total")).first()
    qs = wide_quantiles(base, ["x"], [0.5, 0.95, 0.99])[("x",)][1]
    thr = (r["n"] * batch_size / r["total"]) if r["total"] else None
    # fixed values: the names of the summary's columns
    row = [(int(r["n"]), int(r["n"]) * batch_size, batch_size, r["mean"], qs[0], qs[1], qs[2], r["mn"], r["mx"], thr)]
    out = local_frame(spark, row, "total_requests bigint, total_samples bigint, batch_size int, avg_latency double, "
                                     "p50_latency double, p95_latency double, p99_latency double, "
                                     "min_latency double, max_latency double, throughput double")
    return Q.rounded_select(out, ["total_requests", "total_samples", "batch_size"], out.columns[3:])
