"""End-to-end jobs on a CSV written from the metric table."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF01
from tabspark import jobs
from tabspark.operators.mlp_math import MlpParams
from tabspark.sources.fixtures import read_metrics_fixture
from tabspark.sources.files import write_metrics_csv


def test_prepare_train_predict_explore(spark, tmp_out):
    raw = f"{tmp_out}/raw_csv"
    write_metrics_csv(read_metrics_fixture(spark, SF01), raw)
    info = jobs.prepare_data(spark, raw, f"{tmp_out}/processed")
    assert info["splits"] == {"train": 279, "val": 40, "test": 80}
    res = jobs.train_model(spark, f"{tmp_out}/processed", f"{tmp_out}/model", MlpParams(max_epochs=3),
                           num_partitions=2)
    assert 0.0 <= res["test_best"]["roc_auc"] <= 1.0 and res["best_epoch"] >= 0
    out = jobs.predict(spark, f"{tmp_out}/model", f"{tmp_out}/processed/scaler", raw, f"{tmp_out}/pred")
    assert out["summary"]["n_rows"] == 399 and len(out["head"]) == 5
    assert set(out["metrics"]) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert os.path.isdir(f"{tmp_out}/pred/predictions")
    rep = {(r["section"], r["key"]): r["value"] for r in jobs.explore(spark, raw, f"{tmp_out}/eda").collect()}
    assert rep[("shape", "rows")] == "399" and ("missing", "none") in rep
    assert set(os.listdir(f"{tmp_out}/eda")) == {"eda_report", "describe", "outliers", "missing", "histograms", "kde", "outlier_boxes",
                                                 "correlations", "target", "target_boxes", "top_correlations"}
    write_metrics_csv(read_metrics_fixture(spark, SF01).drop("defects"), f"{tmp_out}/bare_csv")
    bare = jobs.explore(spark, f"{tmp_out}/bare_csv", f"{tmp_out}/bare").collect()
    assert {r["section"] for r in bare} == {"shape", "missing", "outliers"} and "kde" in os.listdir(f"{tmp_out}/bare")
    files = [f for f in os.listdir(f"{tmp_out}/model/metrics") if f.endswith(".json")]
    assert "test_best" in json.loads(open(f"{tmp_out}/model/metrics/{files[0]}").readline())["metrics"]


def test_prepare_without_target(spark, tmp_out):
    raw = f"{tmp_out}/raw_csv"
    write_metrics_csv(read_metrics_fixture(spark, SF01).drop("defects"), raw)
    info = jobs.prepare_data(spark, raw, f"{tmp_out}/processed")
    assert info == {"labelled": False, "rows": 399, "kept": 399, "rejected": 0, "corrupt": 0}


def test_prepare_keeps_rejected_targets_and_needs_no_id(spark, tmp_out):
    raw = f"file:{tmp_out}/raw_csv"
    f = read_metrics_fixture(spark, SF01).drop("id")
    write_metrics_csv(f.withColumn("defects", F.expr("if(loc = 1, 'yes', defects)")), raw)
    bad = f.where("loc = 1").count()
    info = jobs.prepare_data(spark, raw, f"{tmp_out}/processed", fmt="csv")
    assert bad and (info["rows"], info["rejected"]) == (399, bad)
    assert sum(info["splits"].values()) == 399 - bad
    kept = spark.read.parquet(f"{tmp_out}/processed/rejected_targets")
    assert kept.count() == bad and [r[0] for r in kept.select("defects").distinct().collect()] == ["yes"]
    assert spark.read.parquet(f"{tmp_out}/processed/splits").select("id").distinct().count() == 399 - bad


def test_every_row_is_kept_or_set_aside(spark, tmp_out):
    """Rows read = kept + unmapped + corrupt, counted by the write; corrupt ones keep their text."""
    raw = f"{tmp_out}/raw_csv"
    f = read_metrics_fixture(spark, SF01)
    f.withColumn("defects", F.expr("if(loc = 1, 'maybe', defects)")).coalesce(1).write.option("header", True).csv(raw)
    part = next(x for x in os.listdir(raw) if x.endswith(".csv"))
    lines = open(f"{raw}/{part}").read().splitlines()
    width = len(lines[0].split(","))
    broken = [",".join(["7", "many", *["1"] * (width - 3), "TRUE"]), "1,2,3", ",".join(["9"] * (width + 2))]
    open(f"{raw}/{part}", "w").write("\n".join(lines[:5] + broken + lines[5:]) + "\n")
    crc = f"{raw}/.{part}.crc"
    if os.path.exists(crc):
        open(crc, "wb").close()
        os.unlink(crc)
    unmapped = f.where("loc = 1").count()
    info = jobs.prepare_data(spark, raw, f"{tmp_out}/processed", fmt="csv")
    assert {k: info[k] for k in ("rows", "kept", "rejected", "corrupt")} == {"rows": 402, "kept": 399 - unmapped, "rejected": unmapped, "corrupt": 3}
    assert sum(info["splits"].values()) == info["kept"]
    texts = [r[0] for r in spark.read.parquet(f"{tmp_out}/processed/corrupt_rows").select("_corrupt_record").collect()]
    assert sorted(texts) == sorted(broken)
    assert spark.read.parquet(f"{tmp_out}/processed/raw").count() == 402


def test_counts_need_no_second_scan(spark, tmp_out):
    from tabspark.sources import files as IO
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.range(5000).selectExpr("id", "CASE id % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN NULL ELSE 'FALSE' END AS defects")
    n = IO.write_counted(df.mapInPandas(count, df.schema), f"{tmp_out}/raw")
    assert n == {"read": 5000, "kept": 3000, "corrupt": 0, "unmapped": 2000} and seen.value == 5000
    assert IO.read_status(spark, f"{tmp_out}/raw", IO.UNMAPPED).count() == 2000
