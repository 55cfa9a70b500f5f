"""Attaching a row per key without gathering a key."""

import statistics

import pytest
from pyspark.sql import functions as F

from tabspark.operators import history as H
from tabspark.operators import skew


@pytest.mark.parametrize("limit", [0, 10**6])
def test_attach_equals_a_plain_join(spark, limit):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN id % 50 ELSE 7 END AS k", "id % 5 AS m", "id AS v", "'c' AS part")
    table = df.where("coalesce(k, 0) < 40").groupBy("k", "m").agg(F.sum("v").alias("s"), F.count("*").alias("n")).checkpoint()
    got = skew.attach(df, table, ["k", "m"], "n", ["v"], max_broadcast_rows=limit)
    assert got.columns == ["k", "m", "v", "part", "s"]
    t = table.select(F.col("k").alias("a"), F.col("m").alias("b"), "s")
    want = df.join(t, df.k.eqNullSafe(t.a) & (df.m == t.b)).select(got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    joins = got._jdf.queryExecution().executedPlan().toString()
    assert ("__of" in joins) == (limit == 0)  # cut into parts, or broadcast as it is


def test_no_task_of_a_hot_first_step_reads_twice_the_median(spark):
    """A third of all rows is of the first step, and the table of steps is too large to broadcast."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(300_000).selectExpr("id AS run_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE 2 + id % 9000 END AS epoch", "rand(3) AS value")
        table = df.groupBy("epoch").agg(F.avg("value").alias("mean"), F.count("*").alias("n")).checkpoint()
        got = skew.attach(df, table, ["epoch"], "n", ["run_id"], max_broadcast_rows=0)
        loads = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = df.join(table, "epoch")
        before = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(loads) == 300_000 and len(loads) == 16
    assert max(loads) <= 2 * statistics.median(loads) < max(before)


def test_pruning_is_the_same_with_and_without_broadcast(spark, monkeypatch):
    df = spark.range(4000).selectExpr("id % 40 AS run_id", "1 + id div 40 AS epoch", "rand(5) AS value")
    want = sorted(tuple(r) for r in H.prune_trials(df).collect())
    monkeypatch.setattr(skew.attach, "__defaults__", (0,))
    assert sorted(tuple(r) for r in H.prune_trials(df).collect()) == want
