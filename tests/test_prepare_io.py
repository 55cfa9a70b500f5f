"""Target normalisation, alignment, width checks, CSV source, request payloads."""

import os

import pytest
from pyspark.sql import functions as F

from tabspark.operators.prepare import align_features, normalize_target, prepare, target_audit, width_check
from tabspark.schema import DEFECT_SCHEMA, FEATURES, infer_features
from tabspark.sources import files as IO
from tabspark.sources import requests as RQ


def test_normalize_target_spellings(spark):
    vals = ["TRUE", "true", "True", "FALSE", "false", "False", "yes", " true", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(normalize_target(F.col("t"))).collect()]
    assert got == [1, 1, 1, 0, 0, 0, None, None, None]
    b = spark.createDataFrame([(True,), (False,)], "t boolean")
    assert [r[0] for r in b.select(normalize_target(F.col("t"))).collect()] == [1, 0]
    audit = {r["bad_value"]: r["n_rows"] for r in target_audit(df, "t").collect()}
    assert audit == {"yes": 1, " true": 1, "<null>": 1}


def test_infer_features_excludes_target_and_id():
    num, cat = infer_features(DEFECT_SCHEMA)
    assert num == FEATURES and cat == []


def test_align_missing_and_alias(spark):
    df = spark.createDataFrame([(1.0, 2.0, None)], "loc double, v_g double, n double")
    r = align_features(df).first()
    assert r["loc"] == 1.0 and r["v(g)"] == 2.0 and r["n"] == 0.0 and r["t"] == 0.0
    assert align_features(df).columns == FEATURES


def test_width_check(spark):
    df = spark.createDataFrame([([1.0] * 21,), ([1.0] * 20,), (None,)], "x array<double>")
    assert [r["width_ok"] for r in width_check(df, "x").collect()] == [True, False, False]


def test_csv_round_trip_with_nan_and_fallback(spark, tmp_out):
    path = os.path.join(tmp_out, "raw")
    os.makedirs(path)
    header = ",".join(["id"] + FEATURES + ["defects"])
    line1 = ",".join(["1"] + ["nan" if f == "loc" else ("3" if f == "lOCode" else "1.5") for f in FEATURES] + ["TRUE"])
    line2 = ",".join(["2"] + ["2.5" if f not in ("lOCode", "lOComment", "lOBlank", "locCodeAndComment") else "4"
                              for f in FEATURES] + ["false"])
    with open(os.path.join(path, "defects.csv"), "w") as fh:
        fh.write("\n".join([header, line1, line2]) + "\n")
    df = IO.read_metrics(spark, os.path.join(tmp_out, "train.csv"), fallback_glob=os.path.join(path, "*.csv"))
    rows = sorted(df.collect(), key=lambda r: r["id"])
    assert rows[0]["loc"] is None and rows[0]["lOCode"] == 3 and rows[1]["v(g)"] == 2.5
    p = prepare(df).orderBy("id").collect()
    assert [r["label"] for r in p] == [1, 0]
    with pytest.raises(FileNotFoundError):
        IO.read_metrics(spark, os.path.join(tmp_out, "nope.csv"), fallback_glob=os.path.join(tmp_out, "none", "*.csv"))


def test_prepare_without_target_keeps_features(spark):
    df = spark.createDataFrame([(1,) + (1.0,) * 21], ["id"] + FEATURES)
    assert prepare(df).columns == ["id"] + FEATURES


def test_request_payloads_round_trip(spark):
    df = spark.createDataFrame([(i,) + tuple(float(i + j) for j in range(21)) for i in range(5)], ["id"] + FEATURES)
    payloads = RQ.features_to_samples(df, F.floor(F.col("id") / 2))
    assert "v_g" in payloads.first()["payload"]
    back = RQ.samples_to_features(payloads, "payload", ["request_id"]).orderBy("sample_id").collect()
    assert [r["v(g)"] for r in back] == [float(i + 1) for i in range(5)]
    ins = RQ.features_to_inputs(df, F.floor(F.col("id") / 2))
    rows = RQ.inputs_to_features(ins, "payload", ["request_id"]).collect()
    assert len(rows) == 5 and all(r["width_ok"] for r in rows)
    bad = spark.createDataFrame([(1, '{"inputs": [[1.0, 2.0]]}')], "request_id long, payload string")
    r = RQ.inputs_to_features(bad, "payload", ["request_id"]).first()
    assert r["width_ok"] is False and r["loc"] == 1.0 and r["branchCount"] == 0.0


def test_csv_columns_typed_by_name(spark, tmp_out):
    path = os.path.join(tmp_out, "reordered.csv")
    with open(path, "w") as fh:
        fh.write("defects,v_g,loc,extra\nTRUE,2.5,10,x\nfalse,nan,3,y\n")
    df = IO.read_metrics(spark, path)
    assert df.columns == ["defects", "v_g", "loc", "extra"]
    rows = df.orderBy("loc").collect()
    assert rows[0]["v_g"] is None and rows[1]["v_g"] == 2.5 and rows[1]["loc"] == 10.0
    assert dict(df.dtypes)["loc"] == "double" and dict(df.dtypes)["extra"] == "string"
    assert [r["label"] for r in prepare(align_features(df)).orderBy("loc").collect()] == [0, 1]


def test_every_request_is_accepted_or_rejected(spark):
    whole = "[" + ", ".join(["1.5"] * 21) + "]"
    rows = [(1, '{"inputs": [%s, %s]}' % (whole, whole)), (2, '{"inputs": [%s, [1.0]]}' % whole), (3, "not JSON"), (4, None),
            (5, '{"inputs": []}'), (6, '{"inputs": [null]}'), (7, '{"inputs": [[%s"a"]]}' % ("1.0, " * 20))]
    df = spark.createDataFrame(rows, "request_id long, payload string")
    got = {r["request_id"]: r["reason"] for r in RQ.rejected_requests(df, "payload", "inputs").collect()}
    assert got.pop(7) in ("malformed", "width")
    assert got == {2: "width", 3: "malformed", 4: "malformed", 5: "empty", 6: "width"}
    assert [r["request_id"] for r in RQ.accepted_requests(df, "payload", "inputs").collect()] == [1]
    rows = [(1, '{"samples": [{"loc": 1.0}]}'), (2, "x"), (3, '{"samples": [{"loc": "many"}]}'), (4, '{"samples": []}')]
    df = spark.createDataFrame(rows, "request_id long, payload string")
    got = {r["request_id"]: r["reason"] for r in RQ.rejected_requests(df, "payload").collect()}
    assert got == {2: "malformed", 3: "malformed", 4: "empty"}


def test_sample_ids_are_exact(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big,) + (1.0,) * 21, (7,) + (2.0,) * 21], ["id"] + FEATURES)
    back = RQ.samples_to_features(RQ.features_to_samples(df, F.lit(1)), "payload").collect()
    assert sorted(r["sample_id"] for r in back) == [7, big]
    odd = spark.createDataFrame([('{"samples": [{"id": 3.0, "loc": 1}, {"loc": 2}]}',)], "payload string")
    assert [(r["sample_id"], r["loc"]) for r in RQ.samples_to_features(odd, "payload").collect()] == [(3, 1.0), (None, 2.0)]
