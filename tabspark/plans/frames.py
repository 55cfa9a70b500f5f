"""Input frames of the registered queries, all read from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.operators.prepare import normalize_target
from tabspark.schema import FEATURES, LABEL, TARGET
from tabspark.session import scratch_path
from tabspark.sources.fixtures import read_all_metrics
from tabspark.sources.tables import read_table

# Numeric columns of lineitem used as the large numeric frame.
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


_MATERIALIZED: dict = {}


def all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, 21 metrics and defects (string, null without a label) of every document.

    It plays the part of the reference's input CSV: it is derived from documents and
    labels once per session and written as parquet to the folder of
    ``spark.checkpoint.dir``, so multi-pass operators read only the columns they
    need of a small numeric table instead of re-parsing the documents' text.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    df = _MATERIALIZED.get(key)
    if df is None:
        path = scratch_path(spark, "metrics")
        read_all_metrics(spark, sf_dir).write.parquet(path)
        df = _MATERIALIZED[key] = spark.read.parquet(path)
    return df


def metrics_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F: the rows of ``all_metrics`` that have a label."""
    return all_metrics(spark, sf_dir).where("defects IS NOT NULL")


def labelled_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F plus the normalised 0/1 label."""
    f = metrics_frame(spark, sf_dir)
    return f.withColumn(LABEL, normalize_target(F.col(TARGET)))


def lineitem_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large numeric frame: five lineitem measures, target = returnflag 'R'."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_FEATURES,
                     F.when(F.col("l_returnflag") == "R", "TRUE").otherwise("FALSE").alias(TARGET),
                     (F.col("l_returnflag") == "R").cast("int").alias(LABEL))


__all__ = ["FEATURES", "LINEITEM_FEATURES", "all_metrics", "metrics_frame", "labelled_metrics", "lineitem_frame"]
