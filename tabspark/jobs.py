"""End-to-end jobs: prepare → train → predict, and explore.

The four stages of the reference workflow as Spark jobs over files:

* ``prepare_data``: CSV → raw copy + data info → target normalisation →
  exact stratified split → scaler fit on train → split tables (raw values),
  scaler parameters and metadata.
* ``train_model``: split tables → scaling → distributed MLP fit with early
  stopping → best and last model, history, test metrics of both.
* ``predict``: model + scaler + CSV/parquet → aligned features → predictions,
  prediction summary and metrics (when the target is present).
* ``explore``: CSV → EDA report rows and profiles.

Usage: ``python -m tabspark.jobs {prepare,train,predict,explore} ...``
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.operators import profiling as P
from tabspark.operators.metrics import evaluation, prediction_summary
from tabspark.operators.mlp import MlpClassifier, MlpModel, PreprocessScorer
from tabspark.operators.mlp_math import MlpParams
from tabspark.operators.prepare import align_features, normalize_target, prepare
from tabspark.operators.scale import ScalerModel, fit_scaler
from tabspark.operators.split import stratified_split
from tabspark.schema import FEATURES, ID, LABEL, TARGET, col
from tabspark.session import path_glob
from tabspark.sources import files as IO


def _read_any(spark: SparkSession, path: str, fallback_glob: str | None = None, fmt: str | None = None,
              keep_corrupt: bool = False) -> DataFrame:
    """``fmt`` is csv or parquet; unset, a path that ends in ``.parquet`` or holds such files is parquet."""
    if fmt is None:
        fmt = "parquet" if path.endswith(".parquet") or path_glob(spark, f"{path}/*.parquet") else "csv"
    if fmt == "parquet":
        return spark.read.parquet(path)
    return IO.read_metrics(spark, path, fallback_glob=fallback_glob, keep_corrupt=keep_corrupt)


def prepare_data(spark: SparkSession, raw_path: str, out_dir: str, test_size: float = 0.2,
                 val_size: float = 0.1, seed: int = 42, fallback_glob: str | None = None,
                 fmt: str | None = None) -> dict:
    """Raw copy, info, splits, scaler and metadata. Nothing is lost on the way: ``rows`` = ``kept`` + ``rejected`` (a target that
    does not map, in ``rejected_targets``) + ``corrupt`` (rows that do not parse, in ``corrupt_rows`` with their text), counted while
    the copy is written."""
    raw = _read_any(spark, raw_path, fallback_glob, fmt, keep_corrupt=True)
    if ID not in raw.columns:  # fixed by the written copy, which all later passes read
        raw = raw.withColumn(ID, F.monotonically_increasing_id())
    n = IO.write_counted(raw, f"{out_dir}/raw")
    raw = IO.read_status(spark, f"{out_dir}/raw", IO.KEPT, IO.UNMAPPED)  # later passes read the written copy
    counts = {"rows": n["read"], "kept": n[IO.KEPT], "rejected": n[IO.UNMAPPED], "corrupt": n[IO.CORRUPTED]}
    if IO.CORRUPT in raw.columns:
        IO.write_table(IO.read_status(spark, f"{out_dir}/raw", IO.CORRUPTED), f"{out_dir}/corrupt_rows")
        raw = raw.drop(IO.CORRUPT)
    info = P.table_info(raw)
    info.coalesce(1).write.mode("overwrite").json(f"{out_dir}/data_info")
    if TARGET not in raw.columns:
        IO.write_table(IO.unlabelled_features(raw), f"{out_dir}/test_features")
        return {"labelled": False, **counts}
    audit = [r.asDict() for r in P.target_distribution(raw, TARGET).collect()]
    IO.write_table(IO.read_status(spark, f"{out_dir}/raw", IO.UNMAPPED).select(raw.columns), f"{out_dir}/rejected_targets")
    prepared = prepare(IO.read_status(spark, f"{out_dir}/raw", IO.KEPT))
    split = stratified_split(prepared, LABEL, ID, test_size, val_size, seed)
    IO.write_splits(split, f"{out_dir}/splits")
    splits = spark.read.parquet(f"{out_dir}/splits")
    scaler = fit_scaler(splits.where(F.col("split") == "train"), FEATURES)
    scaler.write(spark, f"{out_dir}/scaler")
    meta = IO.write_split_metadata(splits, f"{out_dir}/metadata")
    splits_n = {r["split"]: int(r["n_samples"]) for r in meta.collect()}
    return {"labelled": True, **counts, "splits": splits_n, "target": audit, "test_size": test_size, "val_size": val_size}


def train_model(spark: SparkSession, data_dir: str, model_dir: str, params: MlpParams | None = None,
                num_partitions: int | None = None) -> dict:
    splits = spark.read.parquet(f"{data_dir}/splits")
    scaler = ScalerModel.read(spark, f"{data_dir}/scaler", FEATURES)
    scaled = scaler.transform(splits)
    clf = MlpClassifier(params or MlpParams(), FEATURES, LABEL, num_partitions=num_partitions)
    # per-epoch state in the model folder: a restarted job continues where it stopped
    res = clf.fit(scaled.where(F.col("split") == "train"), scaled.where(F.col("split") == "val"),
                  resume_dir=f"{model_dir}/_state")
    res.best.write(spark, f"{model_dir}/best")
    res.last.write(spark, f"{model_dir}/last")
    res.history.write.mode("overwrite").parquet(f"{model_dir}/history")
    test = scaled.where(F.col("split") == "test")
    out = {"best_epoch": res.best_epoch, "stopped_epoch": res.stopped_epoch, "class_weights": res.class_weights,
           "test_best": evaluation(res.best.transform(test), LABEL), "test_last": evaluation(res.last.transform(test), LABEL)}
    IO.write_metrics(spark.createDataFrame([(json.dumps(out),)], "metrics string"), f"{model_dir}/metrics")
    return out


def predict(spark: SparkSession, model_dir: str, scaler_dir: str | None, data_path: str, out_dir: str,
            which: str = "best") -> dict:
    model = MlpModel.read(spark, f"{model_dir}/{which}")
    scaler = ScalerModel.read(spark, scaler_dir, FEATURES) if scaler_dir else None
    data = _read_any(spark, data_path)
    has_target = TARGET in data.columns
    keep = [c for c in (ID, TARGET) if c in data.columns]
    features = align_features(data.select(*[col(c) for c in data.columns if c in FEATURES or c in keep]))
    scored = PreprocessScorer(scaler, model).transform(features)
    IO.write_predictions(scored, f"{out_dir}/predictions")
    scored = spark.read.parquet(f"{out_dir}/predictions")
    out = {"summary": prediction_summary(scored).first().asDict()}
    if has_target:
        labelled = scored.withColumn(LABEL, normalize_target(F.col(TARGET)))
        out["metrics"] = evaluation(labelled.where(F.col(LABEL).isNotNull()), LABEL)
    order = ID if ID in scored.columns else "prediction"
    out["head"] = [r.asDict() for r in scored.orderBy(order).limit(5)
                   .select(*[c for c in (ID, "prediction", "is_defect", "defect_probability", "confidence")
                             if c in scored.columns]).collect()]
    IO.write_metrics(spark.createDataFrame([(json.dumps(out, default=str),)], "result string"), f"{out_dir}/result")
    return out


def explore(spark: SparkSession, data_path: str, out_dir: str | None = None) -> DataFrame:
    """The EDA report; with ``out_dir`` also one JSON table for each of its parts. Data without a target
    give the parts that need none."""
    data = _read_any(spark, data_path)
    labelled = TARGET in data.columns
    if labelled:
        data = data.withColumn(LABEL, normalize_target(F.col(TARGET)))
    feats = [f for f in FEATURES if f in data.columns]
    report = P.eda_report(data, feats, LABEL if labelled else None)
    if out_dir:
        m = P.moments(data, feats)
        wide = P.top_variance_features(data, feats, 10, m)
        outliers = P.outlier_profile(data, feats)
        most = [r["feature"] for r in outliers.orderBy(F.col("outlier_pct").desc(), "feature").limit(5).collect()]
        parts = {"eda_report": report, "describe": P.describe_numeric(data, feats), "outliers": outliers,
                 "missing": P.missing_profile(data.drop(LABEL)), "histograms": P.histograms(data, wide, 30, m),
                 "kde": P.kdes(data, wide, 200, 30, m), "outlier_boxes": P.box_stats(data, most),
                 "correlations": P.correlation_matrix(data, feats + [LABEL] * labelled)}
        if labelled:
            parts |= {"target": P.target_distribution(data, TARGET), "target_boxes": P.box_stats(data, wide[:5], by=TARGET),
                      "top_correlations": P.top_correlations(data, feats, LABEL)}
        for name, part in parts.items():  # each of a size fixed by the features
            part.coalesce(1).write.mode("overwrite").json(f"{out_dir}/{name}")
    return report


def main(argv=None) -> None:
    from tabspark.session import get_session
    ap = argparse.ArgumentParser(prog="tabspark.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("prepare")
    a.add_argument("raw")
    a.add_argument("out")
    b = sub.add_parser("train")
    b.add_argument("data")
    b.add_argument("model")
    b.add_argument("--epochs", type=int, default=50)
    b.add_argument("--partitions", type=int, default=None)
    c = sub.add_parser("predict")
    c.add_argument("model")
    c.add_argument("scaler")
    c.add_argument("data")
    c.add_argument("out")
    d = sub.add_parser("explore")
    d.add_argument("data")
    d.add_argument("out")
    args = ap.parse_args(argv)
    spark = get_session()
    if args.cmd == "prepare":
        print(json.dumps(prepare_data(spark, args.raw, args.out), default=str))
    elif args.cmd == "train":
        print(json.dumps(train_model(spark, args.data, args.model, MlpParams(max_epochs=args.epochs),
                                     args.partitions), default=str))
    elif args.cmd == "predict":
        print(json.dumps(predict(spark, args.model, args.scaler, args.data, args.out), default=str))
    else:
        explore(spark, args.data, args.out).show(100, truncate=False)


if __name__ == "__main__":
    main()
