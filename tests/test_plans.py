"""Physical-plan guards over every registered query (sf0.001):
no cross joins, no row-at-a-time Python UDFs, pruned scans."""

import pytest

import __spark_entry__ as E
from conftest import SF001

NAMES = sorted(E.queries())
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(spark) -> dict[int, str]:
    """The plans of all jobs that SQL has run so far (the last 1000), by number."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found, it = {}, spark._jsparkSession.sharedState().statusStore().executionsList().iterator()
    while it.hasNext():
        e = it.next()
        found[e.executionId()] = e.physicalPlanDescription()
    return found


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_or_row_udf(spark, name):
    """In the plan that a query returns, and in every job that it runs on the way there."""
    before = max(_executed(spark), default=-1)
    plans = {"result": _plan(E.queries()[name](spark, SF001))}
    plans |= {k: v for k, v in _executed(spark).items() if k > before}
    for k, plan in plans.items():
        for node in FORBIDDEN:
            assert node not in plan, f"{name}, job {k}: {node} in plan"


def test_jobs_on_the_way_are_seen(spark):
    before = max(_executed(spark), default=-1)
    spark.range(3).crossJoin(spark.range(4)).collect()
    new = [v for k, v in _executed(spark).items() if k > before]
    assert any(node in v for v in new for node in FORBIDDEN)


def test_scans_are_pruned_and_filters_pushed(spark):
    from pyspark.sql import functions as F

    from tabspark.operators import profiling as P
    from tabspark.plans.frames import lineitem_frame
    hist_plan = _plan(P.histogram(lineitem_frame(spark, SF001), "l_extendedprice"))
    assert "l_shipdate" not in hist_plan and "l_orderkey" not in hist_plan
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    q = li.where(F.col("l_returnflag") == "R").groupBy("l_linestatus").agg(F.sum("l_quantity"))
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string>" in plan


def test_scoring_is_one_arrow_udf(spark):
    plan = _plan(E.queries()["mlp_score"](spark, SF001))
    assert plan.count("ArrowEvalPython") == 1


def test_metric_table_scans_are_pruned(spark):
    from tabspark.plans.frames import metrics_frame
    plan = _plan(metrics_frame(spark, SF001).select("loc"))
    assert "FileScan parquet" in plan and "ReadSchema: struct<loc:double>" in plan
