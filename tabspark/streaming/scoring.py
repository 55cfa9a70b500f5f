"""Continuous scoring (ST1, ST2).

Stateless micro-batch jobs: file source with an explicit schema →
(optional JSON request explode) → scaler + model → append-only file sink with
a checkpoint, so a restarted query resumes exactly once from the last
committed batch. ``availableNow`` drains what has arrived and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabspark.sources.requests import refused_requests, request_rows

REQUEST_SCHEMA = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("payload", T.StringType())])


def _sink(df: DataFrame, sink_dir: str, checkpoint: str, available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def stream_score(spark: SparkSession, source_dir: str, schema: T.StructType, scorer, sink_dir: str,
                 checkpoint: str, max_files_per_trigger: int | None = None, **kw) -> StreamingQuery:
    """Score parquet feature files as they arrive (ST1)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = scorer.transform(r.parquet(source_dir))
    return _sink(scored, sink_dir, checkpoint, **kw)


def _requests(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(source_dir)


def stream_requests(spark: SparkSession, source_dir: str, scorer, sink_dir: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, **kw) -> StreamingQuery:
    """Score JSON request payload files as they arrive (ST2), named and positional ones in one stream; requests that
    are malformed, empty, of a wrong width or type are not scored (``stream_rejected`` keeps them)."""
    raw = _requests(spark, source_dir, max_files_per_trigger)
    return _sink(scorer.transform(request_rows(raw, "payload", ["request_id"])), sink_dir, checkpoint, **kw)


def stream_rejected(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, **kw) -> StreamingQuery:
    """The requests that ``stream_requests`` does not score, with their reason, in a sink of their own."""
    raw = _requests(spark, source_dir, max_files_per_trigger)
    return _sink(refused_requests(raw, "payload"), sink_dir, checkpoint, **kw)
