"""Reading the driver-provided parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.session import table_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
