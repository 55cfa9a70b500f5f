"""Stratified split: golden counts, disjoint/complete, bucket path = plain rank."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01, SF1
from tabspark.operators.prepare import prepare
from tabspark.operators.split import approximate_mode, split_quotas, stratified_split, order_key
from tabspark.sources.fixtures import read_metrics_fixture

# FIXTURES.md §5 (train, val, test) for FALSE(0) / TRUE(1)
GOLDEN = {
    SF001: {0: (52, 8, 16), 1: (8, 1, 2)},
    SF01: {0: (239, 34, 68), 1: (40, 6, 12)},
    SF1: {0: (2386, 341, 682), 1: (400, 57, 114)},
}


@pytest.mark.parametrize("sf", [SF001, SF01, SF1])
def test_golden_counts(spark, sf):
    sp = stratified_split(prepare(read_metrics_fixture(spark, sf)), "label", "id")
    got = {(r["label"], r["split"]): r["count"] for r in sp.groupBy("label", "split").count().collect()}
    for c, (tr, va, te) in GOLDEN[sf].items():
        assert (got.get((c, "train"), 0), got.get((c, "val"), 0), got.get((c, "test"), 0)) == (tr, va, te)


def test_reference_total_101763():
    # SURVEY §6: 71 233 training rows imply 101 763 input rows (20 353 test, 10 177 val)
    q = split_quotas({0: 78_676, 1: 23_087})
    assert sum(x.test for x in q.values()) == 20_353
    assert sum(x.val for x in q.values()) == 10_177
    assert sum(x.train for x in q.values()) == 71_233


def test_approximate_mode_ties_lower_class_first():
    assert approximate_mode({0: 1, 1: 1, 2: 1}, 2) == {0: 1, 1: 1, 2: 0}
    assert approximate_mode({"a": 5, "b": 5}, 5) == {"a": 3, "b": 2}


@pytest.mark.parametrize("prefix_hex,max_rank_rows", [(1, 1_000_000), (2, 1_000_000), (4, 1_000_000),
                                                     (1, 50), (1, 1)])
def test_bucketed_equals_plain_rank(spark, prefix_hex, max_rank_rows):
    orders = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderstatus")
    sp = stratified_split(orders, "o_orderstatus", "o_orderkey", prefix_hex=prefix_hex,
                          max_rank_rows=max_rank_rows)
    counts = {r["o_orderstatus"]: r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    q = split_quotas(counts)
    w = Window.partitionBy("o_orderstatus").orderBy(order_key("o_orderkey", 42), "o_orderkey")
    ranked = orders.withColumn("rn", F.row_number().over(w) - 1)
    cond = None
    for c, qq in q.items():
        e = (F.when(F.col("rn") < qq.test, "test").when(F.col("rn") < qq.test + qq.val, "val").otherwise("train"))
        cond = F.when(F.col("o_orderstatus") == c, e) if cond is None else cond.when(F.col("o_orderstatus") == c, e)
    plain = ranked.withColumn("split", cond).select("o_orderkey", "split")
    a = sorted((r[0], r[1]) for r in sp.select("o_orderkey", "split").collect())
    b = sorted((r[0], r[1]) for r in plain.collect())
    assert a == b
    assert len(a) == orders.count()  # complete
    assert len({k for k, _ in a}) == len(a)  # disjoint


def test_null_labels_dropped_and_tiny_classes(spark):
    rows = [(i, 0 if i < 10 else (1 if i < 11 else None)) for i in range(13)]
    df = spark.createDataFrame(rows, "id long, label int")
    sp = stratified_split(df, "label", "id").collect()
    assert len(sp) == 11
    assert sum(1 for r in sp if r["label"] == 1) == 1


def test_null_ids_keep_their_rows(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else i, i % 2) for i in range(400)], "id long, label int")
    out = stratified_split(df, "label", "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"train": 280, "val": 40, "test": 80}


def test_many_classes(spark):
    """10 000 classes of 1 to 40 rows, one class with a third of all rows: nothing per class on the driver."""
    from tabspark.operators.split import quota_table
    df = spark.range(150_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', pmod(xxhash64(id), 10000)) END AS label")
    counts = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    want = split_quotas(counts)
    quotas = quota_table(spark.createDataFrame(list(counts.items()), "c string, n bigint"))
    assert {r.c: (r.test, r.val) for r in quotas.collect()} == {c: (x.test, x.val) for c, x in want.items()}
    got = {}
    for r in stratified_split(df, "label", "id").groupBy("label", "split").count().collect():
        got.setdefault(r["label"], {})[r["split"]] = r["count"]
    assert {c: (g.get("test", 0), g.get("val", 0), g.get("train", 0)) for c, g in got.items()} == {c: (x.test, x.val, x.train) for c, x in want.items()}


def test_repeated_ids_make_no_window(spark):
    """A third of the rows with one id: exact numbers, numbered across partitions."""
    df = spark.range(9_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id", "CAST(id % 2 AS INT) AS label", "id AS row")
    out = stratified_split(df, "label", "id", max_rank_rows=100)
    plan = out._jdf.queryExecution().toString()
    assert "partitionBy" not in plan and out.count() == 9_000 and out.select("row").distinct().count() == 9_000
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for c, q in split_quotas({0: 4500, 1: 4500}).items():
        assert (got[c, "test"], got[c, "val"], got[c, "train"]) == (q.test, q.val, q.train)


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(i, i % 2, "a", "b") for i in range(50)], "id long, label int, c string, k string")
    out = stratified_split(df, "label", "id")
    assert out.columns == ["id", "label", "c", "k", "split"] and {(r.c, r.k) for r in out.collect()} == {("a", "b")}
