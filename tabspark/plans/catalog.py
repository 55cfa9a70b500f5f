"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's parquet tables (or the metric table F derived
from them) and runs its whole input; nothing is sampled or capped except
where a limit is the feature (top-k reports, the 5-row head).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.api import BatchPredictor
from tabspark.functions.arrays import argmax, confidence, with_softmax
from tabspark.functions import sqltext as Q
from tabspark.functions.numeric import round4
from tabspark.operators import history as H
from tabspark.operators import metrics as M
from tabspark.operators import mlp as ML
from tabspark.operators import profiling as P
from tabspark.operators import split as S
from tabspark.operators.minibatch import minibatch_plan
from tabspark.operators.mlp_math import MlpParams
from tabspark.operators.prepare import align_features, features_array, prepare, rejected_targets, target_audit, width_check
from tabspark.operators.scale import IdentityScaler, fit_scaler
from tabspark.operators.tuning import tune
from tabspark.plans.frames import (FEATURES, LINEITEM_FEATURES, all_metrics, labelled_metrics, lineitem_frame,
                                   metrics_frame)
from tabspark.schema import DEFECT_SCHEMA, LABEL, TARGET, col
from tabspark.session import checkpoint_dir, scratch_path, ship_package
from tabspark.sources import files as IO
from tabspark.sources import requests as RQ
from tabspark.sources.tables import read_table
from tabspark.streaming import scoring as STR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        return run
    return deco


# ------------------------------------------------------------------ profiling
@query("shape")
def q_shape(spark, sf):
    return P.shape(metrics_frame(spark, sf))


@query("table_info")
def q_table_info(spark, sf):
    return P.table_info(read_table(spark, sf, "lineitem"))


@query("dtype_counts")
def q_dtype_counts(spark, sf):
    return P.dtype_counts(read_table(spark, sf, "lineitem")).select(
        "data_type", F.col("n_columns").cast("bigint").alias("n_columns"))


@query("variance_profile")
def q_variance_profile(spark, sf):
    v = P.variance_profile(lineitem_frame(spark, sf), LINEITEM_FEATURES)
    return v.select("feature", round4(F.col("variance")).alias("variance"))


@query("missing_profile")
def q_missing_profile(spark, sf):
    """Of all documents: those without a label miss their target."""
    return P.missing_profile(all_metrics(spark, sf))


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    return P.describe_numeric(lineitem_frame(spark, sf), LINEITEM_FEATURES)


@query("describe_metrics")
def q_describe_metrics(spark, sf):
    return P.describe_numeric(metrics_frame(spark, sf), FEATURES)


@query("target_distribution")
def q_target_distribution(spark, sf):
    return P.target_distribution(metrics_frame(spark, sf), TARGET)


@query("top_variance")
def q_top_variance(spark, sf):
    return P.top_variance(metrics_frame(spark, sf), FEATURES, 10)


@query("correlation_matrix")
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(labelled_metrics(spark, sf), FEATURES + [LABEL])


@query("target_correlation")
def q_target_correlation(spark, sf):
    return P.target_correlation(labelled_metrics(spark, sf), FEATURES, LABEL)


@query("top_correlations")
def q_top_correlations(spark, sf):
    return P.top_correlations(labelled_metrics(spark, sf), FEATURES, LABEL, 10)


@query("lineitem_correlation")
def q_lineitem_correlation(spark, sf):
    return P.correlation_matrix(lineitem_frame(spark, sf), LINEITEM_FEATURES + [LABEL])


@query("sparse_correlation")
def q_sparse_correlation(spark, sf):
    """Pairwise-complete correlation of columns with nulls, one of them constant wherever another has a value."""
    e = read_table(spark, sf, "events").selectExpr(
        "value", "CAST(event_id AS DOUBLE) AS event_id", "CASE WHEN user_id % 3 = 0 THEN value * value END AS part",
        "CASE WHEN user_id % 3 = 1 THEN CAST(user_id AS DOUBLE) WHEN user_id % 3 = 0 THEN 0.1D END AS flat", "CAST(NULL AS DOUBLE) AS none")
    return P.correlation_matrix(e, e.columns)


@query("outlier_profile")
def q_outlier_profile(spark, sf):
    return P.outlier_profile(metrics_frame(spark, sf), FEATURES)


@query("lineitem_outliers")
def q_lineitem_outliers(spark, sf):
    return P.outlier_profile(lineitem_frame(spark, sf), LINEITEM_FEATURES)


@query("events_outliers")
def q_events_outliers(spark, sf):
    return P.outlier_profile(read_table(spark, sf, "events"), ["value"])


@query("lineitem_deciles")
def q_lineitem_deciles(spark, sf):
    """Sketch and interval sizes so small that the intervals are narrowed and scanned at every size of the table."""
    return P.quantile_table(lineitem_frame(spark, sf), LINEITEM_FEATURES, [i / 10 for i in range(1, 10)], TARGET, k=64, final_rows=500)


@query("top_outliers")
def q_top_outliers(spark, sf):
    return P.top_outliers(metrics_frame(spark, sf), FEATURES, 5)


@query("outlier_rows")
def q_outlier_rows(spark, sf):
    return P.outlier_rows(metrics_frame(spark, sf), FEATURES, "id")


@query("histogram")
def q_histogram(spark, sf):
    return P.histogram(lineitem_frame(spark, sf), "l_extendedprice", 30)


@query("kde_curve")
def q_kde_curve(spark, sf):
    return P.kde(lineitem_frame(spark, sf), "l_extendedprice", 200, 30)


@query("feature_distributions")
def q_feature_distributions(spark, sf):
    """30-bin histograms (+ mean/std labels) of the top-10 variance features, one pass for all."""
    f = metrics_frame(spark, sf)
    m = P.moments(f, FEATURES)
    return P.histograms(f, P.top_variance_features(f, FEATURES, 10, m), 30, m)


@query("feature_kde")
def q_feature_kde(spark, sf):
    """KDE curves of the top-10 variance features, one NumPy pass for all."""
    f = metrics_frame(spark, sf)
    m = P.moments(f, FEATURES)
    return P.kdes(f, P.top_variance_features(f, FEATURES, 10, m), 200, 30, m)


@query("box_stats_by_target")
def q_box_stats_by_target(spark, sf):
    f = metrics_frame(spark, sf)
    top5 = [r["feature"] for r in P.top_variance(f, FEATURES, 10).collect()][:5]
    return P.box_stats(f, top5, by=TARGET)


@query("box_stats_outliers")
def q_box_stats_outliers(spark, sf):
    f = metrics_frame(spark, sf)
    cols = [r["feature"] for r in P.top_outliers(f, FEATURES, 10).collect()][:6]
    return P.box_stats(f, cols)


@query("lineitem_box_stats")
def q_lineitem_box_stats(spark, sf):
    return P.box_stats(lineitem_frame(spark, sf), LINEITEM_FEATURES, by=TARGET)


# ------------------------------------------------------------------ split / scale



def prepared_metrics(spark, sf):
    return prepare(metrics_frame(spark, sf))


def unlabelled_metrics(spark, sf):
    """Features of every document, for work that needs no label."""
    return prepare(all_metrics(spark, sf))


def split_metrics(spark, sf):
    return S.stratified_split(prepared_metrics(spark, sf), LABEL, "id", 0.2, 0.1, 42)


@query("normalize_target")
def q_normalize_target(spark, sf):
    f = metrics_frame(spark, sf)
    return prepare(f).select("id", LABEL)


@query("target_audit")
def q_target_audit(spark, sf):
    # labels.toxic as a target column holds 0/1 ints: every value is unmapped
    lab = read_table(spark, sf, "labels").select(F.col("toxic").alias(TARGET))
    return target_audit(lab)


@query("prepare")
def q_prepare(spark, sf):
    return prepared_metrics(spark, sf).select("id", *[col(c).cast("double").alias(c) for c in FEATURES], LABEL)


@query("stratified_split")
def q_stratified_split(spark, sf):
    return split_metrics(spark, sf).select("id", LABEL, "split")


@query("split_counts")
def q_split_counts(spark, sf):
    return S.split_counts(split_metrics(spark, sf), LABEL)


@query("orders_split_counts")
def q_orders_split_counts(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sp = S.stratified_split(o, "o_orderstatus", "o_orderkey", 0.2, 0.1, 42)
    return sp.groupBy("split", "o_orderstatus").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                                    F.sum("o_orderkey").cast("bigint").alias("key_sum"))


@query("split_metadata")
def q_split_metadata(spark, sf):
    sp = split_metrics(spark, sf)
    meta = IO.write_split_metadata(sp, scratch_path(spark, "split-metadata"))
    return meta.select("split", "n_samples", "n_features", "scaler", F.lit(0.2).alias("test_size"), F.lit(0.1).alias("val_size"))


@query("fit_scaler")
def q_fit_scaler(spark, sf):
    sp = split_metrics(spark, sf)
    model = fit_scaler(sp.where(F.col("split") == "train"), FEATURES)
    p = model.params(spark)
    return p.select("feature", round4(F.col("mean")).alias("mean"), round4(F.col("scale")).alias("scale"))


@query("scale_features")
def q_scale_features(spark, sf):
    sp = split_metrics(spark, sf).checkpoint(eager=True)  # written once, re-read by the later passes
    model = fit_scaler(sp.where(F.col("split") == "train"), FEATURES)
    out = model.transform(sp)
    return Q.rounded_select(out, ["id", "split", LABEL], FEATURES)


# ------------------------------------------------------------------ scalar functions, metrics


def scored_metrics(spark, sf):
    """F with a stand-in defect probability ``1 - l`` and its prediction."""
    f = labelled_metrics(spark, sf)
    p = (1 - F.col("l"))
    return f.select("id", LABEL, p.alias("defect_probability"),
                    (p > 0.5).cast("int").alias("prediction"))


@query("softmax")
def q_softmax(spark, sf):
    e = with_softmax(read_table(spark, sf, "embeddings"), "embedding", "probs")
    return e.select("vec_id", argmax(F.col("embedding")).alias("argmax"),
                    round4(confidence(F.col("probs"))).alias("confidence"),
                    round4(F.element_at("probs", 1)).alias("p_first"),
                    round4(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)).alias("prob_sum"))


def class_logits():
    """10 logits of an embedding by a fixed linear layer over all its values: value i adds to class i mod 10."""
    return F.expr("transform(sequence(0, 9), k -> aggregate(filter(embedding, (x, i) -> i % 10 = k), 0D, "
                  "(t, x) -> t + CAST(x AS DOUBLE)))")


@query("argmax")
def q_argmax(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return (e.select(argmax(class_logits()).alias("predicted"), "label")
            .groupBy("predicted").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                      F.sum(F.when(F.col("predicted") == F.col("label"), 1).otherwise(0))
                                      .cast("bigint").alias("n_correct")))


@query("class_counts")
def q_class_counts(spark, sf):
    return M.class_counts(read_table(spark, sf, "embeddings"), "label", 10)


@query("class_weights")
def q_class_weights(spark, sf):
    sp = split_metrics(spark, sf).where(F.col("split") == "train")
    return M.class_weights(sp, LABEL, 2).select("label", "n", round4(F.col("weight")).alias("weight"))


@query("confusion")
def q_confusion(spark, sf):
    return M.confusion(scored_metrics(spark, sf))


@query("binary_metrics")
def q_binary_metrics(spark, sf):
    return M.binary_metrics(scored_metrics(spark, sf))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return M.roc_auc(scored_metrics(spark, sf), LABEL, "defect_probability")


@query("lineitem_roc_auc")
def q_lineitem_roc_auc(spark, sf):
    li = lineitem_frame(spark, sf)
    return M.roc_auc(li, LABEL, "l_extendedprice")


@query("prediction_summary")
def q_prediction_summary(spark, sf):
    return M.prediction_summary(scored_metrics(spark, sf))


def _embedding_logits(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.select(class_logits().alias("logits"), "label")


@query("focal_loss")
def q_focal_loss(spark, sf):
    e = _embedding_logits(spark, sf)
    alpha = M.class_weight_list(e, "label", 10)
    return M.mean_loss(e, "logits", "label", "focal", alpha, 2.0)


@query("weighted_ce")
def q_weighted_ce(spark, sf):
    e = _embedding_logits(spark, sf)
    alpha = M.class_weight_list(e, "label", 10)
    return M.mean_loss(e, "logits", "label", "ce", alpha, smoothing=0.1)


@query("latency_summary")
def q_latency_summary(spark, sf):
    return M.latency_summary(read_table(spark, sf, "events"), "value")


# ------------------------------------------------------------------ training history windows
def _runs(spark, sf):
    return H.event_runs(read_table(spark, sf, "events"))


@query("best_so_far")
def q_best_so_far(spark, sf):
    return H.best_so_far(_runs(spark, sf), order_cols=H.EVENT_ORDER)


@query("early_stop")
def q_early_stop(spark, sf):
    return H.early_stop(_runs(spark, sf), patience=10, order_cols=H.EVENT_ORDER)


@query("best_epoch")
def q_best_epoch(spark, sf):
    return H.best_epoch(H.events_history(read_table(spark, sf, "events")))


@query("prune_trials")
def q_prune_trials(spark, sf):
    return H.prune_trials(_runs(spark, sf), order_cols=H.EVENT_ORDER)


# ------------------------------------------------------------------ model scoring / training


def fitted_scaler(sp):
    return fit_scaler(sp.where(F.col("split") == "train"), FEATURES)


def _scored_view(df):
    return df.select("id", "prediction", "is_defect", round4(F.col("defect_probability")).alias("defect_probability"),
                     round4(F.col("confidence")).alias("confidence"))


@query("mlp_score")
def q_mlp_score(spark, sf):
    """Fixed-weight model on raw features, scaler stage pass-through."""
    pipe = ML.PreprocessScorer(IdentityScaler(FEATURES), ML.fixed_model(FEATURES))
    return _scored_view(pipe.transform(unlabelled_metrics(spark, sf)))


@query("mlp_logits")
def q_mlp_logits(spark, sf):
    m = ML.fixed_model(FEATURES)
    out = m.transform(unlabelled_metrics(spark, sf), output="logits")
    return out.select("id", round4(F.element_at("logits", 1)).alias("logit_0"),
                      round4(F.element_at("logits", 2)).alias("logit_1"))


@query("preprocess_score")
def q_preprocess_score(spark, sf):
    sp = split_metrics(spark, sf)
    pipe = ML.PreprocessScorer(fitted_scaler(sp), ML.fixed_model(FEATURES))
    return _scored_view(pipe.transform(sp.where(F.col("split") == "test")))


@query("evaluate")
def q_evaluate(spark, sf):
    sp = split_metrics(spark, sf)
    pipe = ML.PreprocessScorer(fitted_scaler(sp), ML.fixed_model(FEATURES))
    return ML.evaluate(pipe, sp.where(F.col("split") == "test"), LABEL)


@query("score_batches")
def q_score_batches(spark, sf):
    sp = split_metrics(spark, sf)
    batches = [sp.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]
    scored = BatchPredictor(ML.fixed_model(FEATURES), fitted_scaler(sp)).predict_batch(batches)
    return scored.groupBy("batch_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                                          F.sum(F.col("prediction")).cast("bigint").alias("n_defects"))


@query("sample_head")
def q_sample_head(spark, sf):
    sp = split_metrics(spark, sf)
    pipe = ML.PreprocessScorer(fitted_scaler(sp), ML.fixed_model(FEATURES))
    first = sp.where(F.col("split") == "test").orderBy("id").limit(5)  # only these are scored
    return _scored_view(pipe.transform(first)).orderBy("id")


@query("mlp_prediction_summary")
def q_mlp_prediction_summary(spark, sf):
    sp = split_metrics(spark, sf)
    pipe = ML.PreprocessScorer(fitted_scaler(sp), ML.fixed_model(FEATURES))
    return M.prediction_summary(pipe.transform(sp.where(F.col("split") == "test")))


def _fit(spark, sf, params: MlpParams, num_partitions=None, run_id="run"):
    sp = split_metrics(spark, sf).checkpoint(eager=True)  # written once, re-read by the later passes
    scaler = fitted_scaler(sp)
    scaled = scaler.transform(sp)
    clf = ML.MlpClassifier(params, FEATURES, LABEL, num_partitions=num_partitions, run_id=run_id)
    res = clf.fit(scaled.where(F.col("split") == "train"), scaled.where(F.col("split") == "val"))
    return sp, scaler, res


@query("mlp_fit")
def q_mlp_fit(spark, sf):
    """Training history (run, epoch, metric, value) of a distributed fit with the configured schedule."""
    _, _, res = _fit(spark, sf, MlpParams())
    return res.history


@query("minibatch_plan")
def q_minibatch_plan(spark, sf):
    """Batches of 32 of the training split for three epochs, without the last partial one."""
    train = split_metrics(spark, sf).where(F.col("split") == "train").select("id")
    return minibatch_plan(train, "id", epochs=3)


@query("mlp_fit_facts")
def q_mlp_fit_facts(spark, sf):
    """What is known of a fit beforehand, of the epochs that every fit runs (patience and one more): learning rate,
    rows seen, mini-batches; and whether best and last epoch are those that the history operators find."""
    p = MlpParams()
    _, _, res = _fit(spark, sf, p)
    f1 = res.history.where("metric = 'val_f1'").select("run_id", "epoch", "value")
    ends = H.best_epoch(f1).join(H.early_stop(f1, p.patience), "run_id").first()  # one run
    last = res.stopped_epoch if res.stopped_epoch is not None else p.max_epochs - 1
    replayed = (ends.best_epoch, ends.stop_epoch, ends.early_stopped) == (res.best_epoch, last, res.stopped_epoch is not None)
    steps = spark.createDataFrame(res.steps, "epoch int, rows_seen bigint, batches bigint")
    lr = res.history.where("metric = 'lr'").select("epoch", round4(F.col("value") * 1000).alias("lr_1000"))
    return steps.where(F.col("epoch") <= p.patience).join(lr, "epoch").withColumn("replayed", F.lit(replayed))


# ------------------------------------------------------------------ requests, sinks, streaming, report


REQUEST_ROWS = 4  # samples per request payload


def _request_key():
    return F.floor(F.col("id") / REQUEST_ROWS)


def _round_features(df, extra=()):
    """``extra`` as SQL select items, then the 21 features display-rounded."""
    return df.selectExpr(*extra, *[f"{Q.round4(Q.ident(c))} AS {Q.ident(c)}" for c in FEATURES])


@query("request_explode")
def q_request_explode(spark, sf):
    """Named-sample JSON payloads (aliases v_g/ev_g/iv_g) → one feature row per sample."""
    payloads = RQ.features_to_samples(unlabelled_metrics(spark, sf), _request_key())
    rows = RQ.samples_to_features(payloads, "payload", ["request_id"])
    return _round_features(rows, ["request_id", "sample_id AS id"])


@query("request_inputs")
def q_request_inputs(spark, sf):
    """Positional JSON payloads → feature rows with a width check."""
    payloads = RQ.features_to_inputs(unlabelled_metrics(spark, sf), _request_key())
    rows = RQ.inputs_to_features(payloads, "payload", ["request_id"])
    return _round_features(rows, ["request_id", "CAST(pos AS INT) AS pos", "width_ok"])


@query("rejected_targets")
def q_rejected_targets(spark, sf):
    """Rows whose target has no accepted spelling, by target: two of three return flags are mapped."""
    flag = F.col("l_returnflag")
    li = read_table(spark, sf, "lineitem").select(F.when(flag == "R", "TRUE").when(flag == "A", "False").otherwise(flag).alias(TARGET))
    return rejected_targets(li).groupBy(TARGET).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@query("rejected_requests")
def q_rejected_requests(spark, sf):
    """One positional payload per document: whole, a value short, without inputs, or broken."""
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    vec = "array_repeat(CAST(n_chars AS DOUBLE), {})"
    inputs = f"to_json(named_struct('inputs', array({vec.format(len(FEATURES))}, {vec.format('CASE n_chars % 3 WHEN 0 THEN 20 ELSE 21 END')})))"
    d = d.withColumn("payload", F.expr(f"""CASE n_chars % 5 WHEN 1 THEN '{{"inputs": []}}' WHEN 2 THEN substring({inputs}, 1, 40)
        ELSE {inputs} END"""))
    return RQ.rejected_requests(d, "payload", "inputs").select("doc_id", "reason")


def _mixed_payloads(spark, sf):
    """Requests of the metric table, named and positional ones in turn, some with numbers as text, some broken."""
    f = unlabelled_metrics(spark, sf)
    named = RQ.features_to_samples(f, _request_key()).withColumnRenamed("payload", "named")
    listed = RQ.features_to_inputs(f, _request_key()).withColumnRenamed("payload", "listed")
    loc = "regexp_replace({}, '\"loc\":([0-9.]+)', '\"loc\":{}')"
    return named.join(listed, "request_id").withColumn("payload", F.expr(f"""CASE WHEN request_id % 7 = 3 THEN left(named, 50)
      WHEN request_id % 11 = 5 THEN {loc.format('named', '"many"')} WHEN request_id % 13 = 6 THEN replace(listed, ']]', ',1.0]]')
      WHEN request_id % 17 = 8 THEN '{{"samples":[]}}' WHEN request_id % 3 = 0 THEN named WHEN request_id % 3 = 1 THEN listed
      ELSE {loc.format('named', '"$1"')} END""")).select("request_id", "payload")


@query("mixed_requests")
def q_mixed_requests(spark, sf):
    """Every request of a mixed stream: a row per sample of those that are scored, a row with the reason of each other."""
    payloads = _mixed_payloads(spark, sf)
    rows = _round_features(RQ.request_rows(payloads, "payload", ["request_id"]), ["request_id", "CAST(NULL AS STRING) AS reason"])
    return rows.unionByName(RQ.refused_requests(payloads, "payload").select("request_id", "reason"), allowMissingColumns=True)


@query("align_features")
def q_align_features(spark, sf):
    """Alias names and two absent features (e, t) aligned to the model order."""
    f = all_metrics(spark, sf).withColumnsRenamed({"v(g)": "v_g", "iv(g)": "iv_g"}).drop("e", "t")
    return _round_features(align_features(f), ["id"])


@query("width_check")
def q_width_check(spark, sf):
    good = metrics_frame(spark, sf).select(F.lit("metrics").alias("source"), features_array().alias("x"))
    emb = read_table(spark, sf, "embeddings").select(F.lit("embeddings").alias("source"), F.col("embedding").alias("x"))
    chk = width_check(good.unionByName(emb), "x")
    return chk.groupBy("source", "width_ok").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("eda_report")
def q_eda_report(spark, sf):
    return P.eda_report(labelled_metrics(spark, sf), FEATURES, LABEL)


@query("counted_write")
def q_counted_write(spark, sf):
    """Rows by what the raw copy makes of them, counted while it is written, and as they are in the copy: lineitem as CSV
    text with cells that are no numbers and flags that do not map."""
    li = read_table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS id", "CASE WHEN l_linenumber = 7 THEN 'seven' ELSE CAST(l_quantity AS STRING) END AS loc",
        "CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN 'False' ELSE l_returnflag END AS defects")
    src, out = scratch_path(spark, "counted-csv"), scratch_path(spark, "counted")
    IO.write_metrics_csv(li, src)
    n = IO.write_counted(IO.read_metrics(spark, src, keep_corrupt=True), out)
    counted = spark.createDataFrame(sorted(n.items()), "status string, counted bigint").where("status != 'read'")
    there = spark.read.parquet(out).groupBy(IO.STATUS).agg(F.count(F.lit(1)).cast("bigint").alias("written"), F.sum("id").cast("bigint").alias("id_sum"))
    return counted.join(there, IO.STATUS)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """Metric table written as CSV and read back with the explicit schema."""
    path = scratch_path(spark, "metrics-csv")
    IO.write_metrics_csv(all_metrics(spark, sf), path)
    back = IO.read_metrics(spark, path, DEFECT_SCHEMA)
    return _round_features(back, ["id", Q.ident(TARGET)])


@query("split_sink")
def q_split_sink(spark, sf):
    """Splits written partitioned by split; reading 'test' prunes the other folders (S3)."""
    path = scratch_path(spark, "splits")
    IO.write_splits(split_metrics(spark, sf), path)
    test = IO.read_split(spark, path, "test")
    return test.groupBy(LABEL).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                   F.sum("id").cast("bigint").alias("id_sum"))


def _shards(spark, df, name, n_files=4):
    path = scratch_path(spark, name)
    df.repartition(n_files).write.mode("overwrite").parquet(path)
    return path


@query("stream_score")
def q_stream_score(spark, sf):
    """Feature files scored by a streaming query (availableNow); equals mlp_score."""
    src = unlabelled_metrics(spark, sf)
    path = _shards(spark, src, "stream-src")
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    pipe = ML.PreprocessScorer(IdentityScaler(FEATURES), ML.fixed_model(FEATURES))
    qy = STR.stream_score(spark, path, src.schema, pipe, sink, ckpt, max_files_per_trigger=2)
    qy.awaitTermination()
    return _scored_view(spark.read.parquet(sink))


@query("stream_requests")
def q_stream_requests(spark, sf):
    """JSON request files scored by a streaming query; equals mlp_score."""
    payloads = RQ.features_to_samples(unlabelled_metrics(spark, sf), _request_key())
    path = scratch_path(spark, "stream-req")
    payloads.repartition(4).write.mode("overwrite").json(path)
    sink, ckpt = scratch_path(spark, "stream-req-sink"), scratch_path(spark, "stream-req-ckpt")
    pipe = ML.PreprocessScorer(IdentityScaler(FEATURES), ML.fixed_model(FEATURES))
    qy = STR.stream_requests(spark, path, pipe, sink, ckpt, max_files_per_trigger=2)
    qy.awaitTermination()
    out = spark.read.parquet(sink).withColumn("id", F.col("sample_id"))
    return _scored_view(out)


@query("mlp_tune")
def q_mlp_tune(spark, sf):
    """Three trials of the configured schedule with median pruning; one row per trial."""
    sp = split_metrics(spark, sf).checkpoint(eager=True)  # written once, re-read by the later passes
    scaled = fitted_scaler(sp).transform(sp)
    grid = [{"learning_rate": 1e-3}, {"learning_rate": 1e-2, "hidden_sizes": [32, 16]},
            {"learning_rate": 1e-4, "dropout": 0.1}]
    table, _, _ = tune(scaled.where(F.col("split") == "train"), scaled.where(F.col("split") == "val"),
                       FEATURES, LABEL, MlpParams(), grid)
    return table.select("trial", "params", "state", "epochs_run")


@query("mlp_tune_facts")
def q_mlp_tune_facts(spark, sf):
    """Per trial of a study: its parameters, the first learning rate, and whether state, length and best epoch are those that
    the one-after-another rule gives for the returned history."""
    sp = split_metrics(spark, sf).checkpoint(eager=True)
    scaled = fitted_scaler(sp).transform(sp)
    base = MlpParams(max_epochs=14, patience=4)
    grid = [{"learning_rate": 1e-3}, {"learning_rate": 1e-2, "hidden_sizes": [32, 16]}, {"learning_rate": 1e-5}, {"learning_rate": 5e-3}]
    table, history, _ = tune(scaled.where(F.col("split") == "train"), scaled.where(F.col("split") == "val"), FEATURES, LABEL, base, grid)
    f1 = history.where("metric = 'val_f1'").select("run_id", "epoch", "value")
    lr = history.where("metric = 'lr' AND epoch = 0").select("run_id", round4(F.col("value") * 1000).alias("lr_1000"))
    t = table.withColumn("run_id", F.concat(F.lit("trial-"), F.col("trial")))
    rule = H.median_rule(f1, t.where("state = 'COMPLETE'"), base.patience, base.max_epochs)
    t = t.join(lr, "run_id").join(rule, "run_id")
    return t.select("trial", "params", "lr_1000", ((F.col("state") == F.col("rule_state")) & (F.col("epochs_run") == F.col("rule_epochs"))
                                                   & (F.col("best_epoch") == F.col("rule_best"))).alias("replayed"))
