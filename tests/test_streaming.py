"""Streaming scoring: equals batch scoring; a restart only processes new files."""

from pyspark.sql import functions as F

from conftest import SF001
from tabspark.operators.mlp import PreprocessScorer, fixed_model
from tabspark.operators.prepare import prepare
from tabspark.schema import FEATURES
from tabspark.sources.fixtures import read_metrics_fixture
from tabspark.streaming.scoring import stream_score


def test_stream_equals_batch_and_resumes(spark, tmp_out):
    rows = prepare(read_metrics_fixture(spark, SF001))
    src, sink, ckpt = f"{tmp_out}/src", f"{tmp_out}/sink", f"{tmp_out}/ckpt"
    first = rows.where(F.col("id") < 500)
    second = rows.where(F.col("id") >= 500)
    first.write.mode("overwrite").parquet(f"{src}/part=a")
    pipe = PreprocessScorer(None, fixed_model(FEATURES))
    schema = rows.schema
    stream_score(spark, f"{src}/part=a", schema, pipe, sink, ckpt).awaitTermination()
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    # new files arrive in the same source folder; the restarted query adds only them
    second.write.mode("append").parquet(f"{src}/part=a")
    stream_score(spark, f"{src}/part=a", schema, pipe, sink, ckpt).awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == rows.count()
    batch = pipe.transform(rows).select("id", "prediction", "defect_probability")
    diff = out.select("id", "prediction", "defect_probability").exceptAll(batch)
    assert diff.count() == 0
