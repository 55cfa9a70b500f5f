"""One reader for requests of both shapes."""

import json

import pytest

from conftest import SF001
from tabspark.operators.mlp import PreprocessScorer, fixed_model
from tabspark.operators.prepare import prepare
from tabspark.schema import FEATURES
from tabspark.sources.fixtures import read_metrics_fixture
from tabspark.sources.requests import refused_requests, request_rows
from tabspark.streaming.scoring import stream_rejected, stream_requests

FULL = {f: float(i + 1) for i, f in enumerate(FEATURES)}
LIST = [float(i + 1) for i in range(len(FEATURES))]
CASES = [  # (payload, reason or the samples' (id, loc, v(g), t))
    (json.dumps({"samples": [{**FULL, "id": 2**53 + 1}, {"id": 3, "v_g": "7.5", "loc": None, "t": 4, "unknown": [1]}]}),
     [(2**53 + 1, 1.0, 2.0, 12.0), (3, 0.0, 7.5, 4.0)]),
    (json.dumps({"inputs": [LIST, ["22.5", *LIST[1:]]]}), [(None, 1.0, 2.0, 12.0), (None, 22.5, 2.0, 12.0)]),
    (json.dumps({"samples": [{}], "model": "x"}), [(None, 0.0, 0.0, 0.0)]),
    (None, "malformed"), ("", "malformed"), ("{", "malformed"), ("[1]", "malformed"), ("{}", "malformed"),
    (json.dumps({"samples": [FULL], "inputs": [LIST]}), "malformed"), (json.dumps({"samples": FULL}), "malformed"),
    (json.dumps({"samples": [FULL, 3]}), "malformed"), (json.dumps({"samples": [None]}), "malformed"), (json.dumps({"inputs": [LIST, {"loc": 1}]}), "malformed"),
    (json.dumps({"samples": []}), "empty"), (json.dumps({"inputs": []}), "empty"),
    (json.dumps({"inputs": [LIST, LIST[1:]]}), "width"), (json.dumps({"inputs": [[]]}), "width"),
    (json.dumps({"inputs": [[None, *LIST[1:]]]}), "type"), (json.dumps({"inputs": [["x", *LIST[1:]]]}), "type"),
    (json.dumps({"samples": [{"loc": "many"}]}), "type"), (json.dumps({"samples": [FULL, {"v(g)": [1]}]}), "type"), (json.dumps({"samples": [{"v_g": {}}]}), "type"),
]


def test_every_payload_is_scored_or_refused(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "request_id long, payload string")
    refused = {r.request_id: r.reason for r in refused_requests(df, "payload").collect()}
    rows = {}
    for r in sorted(request_rows(df, "payload", ["request_id"]).collect(), key=lambda r: r.pos):
        rows.setdefault(r.request_id, []).append((r.sample_id, r["loc"], r["v(g)"], r["t"]))
    for i, (p, want) in enumerate(CASES):
        assert (refused.get(i), rows.get(i)) == ((want, None) if isinstance(want, str) else (None, want)), p
    assert refused_requests(df, "payload").columns == ["request_id", "payload", "reason"]


@pytest.mark.parametrize("files", [1, 3])
def test_a_stream_keeps_every_request(spark, tmp_out, files):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "request_id long, payload string").where("payload IS NOT NULL")
    df.repartition(files).write.json(f"{tmp_out}/in")
    pipe = PreprocessScorer(None, fixed_model(FEATURES))
    stream_requests(spark, f"{tmp_out}/in", pipe, f"{tmp_out}/out", f"{tmp_out}/c1").awaitTermination()
    stream_rejected(spark, f"{tmp_out}/in", f"{tmp_out}/bad", f"{tmp_out}/c2").awaitTermination()
    scored = spark.read.parquet(f"{tmp_out}/out")
    good = {r[0] for r in scored.select("request_id").distinct().collect()}
    bad = {r[0] for r in spark.read.parquet(f"{tmp_out}/bad").select("request_id").collect()}
    assert good | bad == {i for i, (p, _) in enumerate(CASES) if p is not None} and not good & bad
    batch = pipe.transform(request_rows(df, "payload", ["request_id"])).select("request_id", "pos", "prediction", "defect_probability")
    assert scored.select(batch.columns).exceptAll(batch).count() == 0 and scored.count() == batch.count()


def test_scored_alike_by_name_and_by_position(spark):
    from tabspark.sources.requests import features_to_inputs, features_to_samples
    from pyspark.sql import functions as F
    rows = prepare(read_metrics_fixture(spark, SF001))
    key = F.floor(F.col("id") / 4)
    a = request_rows(features_to_samples(rows, key), "payload").select(*[F.col(f"`{f}`") for f in FEATURES])
    b = request_rows(features_to_inputs(rows, key), "payload").select(*[F.col(f"`{f}`") for f in FEATURES])
    assert a.count() == rows.count() and a.exceptAll(b).count() == 0
