"""Exact stratified train/validation/test split.

Semantics: two stratified draws as in the reference (test first, then
validation out of the rest) with its size rules: held-out size
``ceil(frac * n)``, per-class quotas by largest remainder (ties → lower class
value). Row order inside a class is ``md5('<seed>:<id>')`` then ``id``; the first
``test`` rows of a class go to test, the next ``val`` rows to validation.

Plan at scale (no window over a whole class, nothing per class on the driver):
1. class counts → quotas, as windows over one row a class;
2. counts by (class, hash prefix), the prefix as long as the class is large (at
   most 4 hex digits); running counts find the (at most two) prefixes per class
   that a quota boundary runs through; one that still holds more than
   ``max_rank_rows`` rows is refined with 4 more hex digits, counting only the
   rows inside it;
3. the cut table (a row a class) is joined on class: a row outside those
   prefixes has its split by comparison (no shuffle where the table is
   broadcast); only rows inside them are ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions import sqltext as Q
from tabspark.operators.scan import Spec, ordered_scan

def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` proportional to ``counts``."""
    total = sum(counts.values())
    if total == 0:
        return {k: 0 for k in counts}
    cont = {k: c / total * n_draws for k, c in counts.items()}
    fl = {k: int(math.floor(v)) for k, v in cont.items()}
    need = int(n_draws - sum(fl.values()))
    if need > 0:
        order = sorted(counts, key=lambda k: (-(cont[k] - fl[k]), k))
        for k in order[:need]:
            fl[k] += 1
    return fl


@dataclass(frozen=True)
class Quota:
    test: int
    val: int
    train: int


def split_quotas(counts: dict, test_size: float = 0.2, val_size: float = 0.1) -> dict:
    """Per-class (test, val, train) sizes for the two-stage split."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    n_rest = n - n_test
    rest = approximate_mode(counts, n_rest)
    test = {k: counts[k] - rest[k] for k in counts}
    val_adj = val_size / (1 - test_size)
    n_val = int(math.ceil(val_adj * n_rest))
    n_train = n_rest - n_val
    train = approximate_mode(rest, n_train)
    return {k: Quota(test[k], rest[k] - train[k], train[k]) for k in counts}


def order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


#: Class tables of at most this many (counted) rows are broadcast.
MAX_BROADCAST_CLASSES = 200_000


def quota_table(counts: DataFrame, test_size: float = 0.2, val_size: float = 0.1) -> DataFrame:
    """``split_quotas`` as a DataFrame: (c, n) per class in, (c, n, test, val) out. Windows over one row a class."""
    d = counts.selectExpr("c", "n", "sum(n) OVER () AS total").selectExpr(
        "*", f"total - CAST(ceil({Q.dbl(test_size)} * total) AS BIGINT) AS n_rest")
    d = d.selectExpr("*", f"n_rest - CAST(ceil({Q.dbl(val_size / (1 - test_size))} * n_rest) AS BIGINT) AS n_train")

    def drawn(d, size, total, draws, out):
        """Largest-remainder shares of ``draws`` in proportion to ``size`` (ties: lower class)."""
        d = d.withColumn("x", F.expr(f"coalesce(CAST({size} AS DOUBLE) / nullif({total}, 0) * {draws}, 0D)"))
        d = d.withColumn("need", F.expr(f"{draws} - sum(CAST(floor(x) AS BIGINT)) OVER ()"))
        d = d.withColumn("k", F.expr("row_number() OVER (ORDER BY x - floor(x) DESC, c)"))
        return d.withColumn(out, F.expr("CAST(floor(x) AS BIGINT) + CASE WHEN k <= need THEN 1 ELSE 0 END")).drop("x", "need", "k")
    d = drawn(d, "n", "total", "n_rest", "rest")
    d = drawn(d, "rest", "n_rest", "n_train", "train")
    return d.selectExpr("c", "n", "n - rest AS test", "rest - train AS val")


def _near(d: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(d) if small else d


def _find_cuts(keyed: DataFrame, quotas: DataFrame, small: bool, bucket_rows: int, max_rank_rows: int,
               prefix_hex: int | None) -> tuple[DataFrame, int]:
    """A trie of counts, level by level: for every class and cut rank the shortest hash prefix whose rows contain
    the cut and that holds at most ``max_rank_rows`` rows (all 32 digits at most): (c, cut, p, before, inside). And the
    rows of the largest such prefix.

    A level counts rows by (class, parent prefix, prefix) inside the parents that are still too full; running counts
    over the prefixes of a parent (at most 16 ** 4) find the child that holds the cut. The first level's prefixes
    are as long as the class is large. All tables stay DataFrames; the driver sees one maximum a level."""
    digits = (f"{prefix_hex}" if prefix_hex else
              f"CAST(least(4, greatest(1, ceil(log(16D, n / {bucket_rows}D)))) AS INT)")
    open_ = quotas.selectExpr("c", "n", "inline(array(struct('t' AS cut, test AS rank), struct('v' AS cut, test + val AS rank)))")
    open_ = open_.selectExpr("c", "cut", "rank", "CASE WHEN rank < n THEN '' ELSE 'g' END AS p",  # g: after every digit
                             "CASE WHEN rank < n THEN 0L ELSE n END AS before", "CASE WHEN rank < n THEN n ELSE 0L END AS inside", f"{digits} AS len")
    done, largest = open_.where("p = 'g'"), 0
    open_ = open_.where("p = ''")
    while True:
        parents = open_.selectExpr("c AS pc", "p AS parent", "len").distinct()
        rows = keyed.join(_near(parents, small), F.expr("c = pc AND substring(k, 1, length(parent)) = parent"))
        hist = rows.groupBy("pc", "parent", F.expr("substring(k, 1, len)").alias("child")).agg(F.count(F.lit(1)).alias("m"))
        hist = hist.selectExpr("*", "coalesce(sum(m) OVER (PARTITION BY pc, parent ORDER BY child ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS acc")
        got = open_.join(hist, F.expr("c = pc AND p = parent AND before + acc <= rank AND rank < before + acc + m"))
        got = got.selectExpr("c", "cut", "rank", "child AS p", "before + acc AS before", "m AS inside", "len").checkpoint(eager=True)
        done = done.unionByName(got.where(f"inside <= {max_rank_rows} OR len >= 32"))
        full = got.agg(F.max("inside"), F.max(F.expr(f"CASE WHEN inside > {max_rank_rows} AND len < 32 THEN len END"))).first()
        if full[1] is None:
            return done.select("c", "cut", "p", "before", "inside"), max(largest, full[0] or 0)
        open_ = got.where(f"inside > {max_rank_rows} AND len < 32").withColumn("len", F.expr("least(len + 4, 32)"))


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                     val_size: float = 0.1, seed: int = 42, split_col: str = "split",
                     bucket_rows: int = 64, max_rank_rows: int = 1_000_000,
                     prefix_hex: int | None = None) -> DataFrame:
    """Adds ``split`` in {'train','val','test'}; rows with a null label are dropped
    (``prepare.rejected_targets`` holds them); a null id counts as an empty one.

    ``df`` is read three times (class counts, prefix counts, output); pass
    a persisted or written table for expensive inputs. Rows of one id in a class (it should be
    unique) fall to either side of a cut, in exact numbers. Any number of classes: the cut table has a row
    a class and is joined on it, broadcast up to ``MAX_BROADCAST_CLASSES``.
    """
    key = order_key(id_col, seed)
    data = df.where(F.col(label).isNotNull())
    counts = data.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    quotas = quota_table(counts, test_size, val_size).checkpoint(eager=True)  # a row a class
    small = quotas.count() <= MAX_BROADCAST_CLASSES
    keyed = data.select(F.col(label).alias("c"), key.alias("k"))
    cuts, largest = _find_cuts(keyed, quotas, small, bucket_rows, max_rank_rows, prefix_hex)
    table = quotas.join(cuts.groupBy("c").agg(*[F.expr(f"max({x}) FILTER (WHERE cut = '{cut}') AS {x}_{cut}") for cut in "tv" for x in ("p", "before")]), "c")
    table = table.select(F.col("c").alias("__c"), F.struct("test", "val", "p_t", "before_t", "p_v", "before_v").alias("__q"))
    table = table.checkpoint(eager=True)

    d = data.withColumn("__k", key).join(_near(table, small), F.col(label) == F.col("__c"))
    at = {cut: f"substring(__k, 1, length(__q.p_{cut}))" for cut in "tv"}
    d = d.withColumn(split_col, F.expr(
        f"CASE WHEN {at['t']} < __q.p_t THEN 'test' WHEN {at['t']} > __q.p_t AND {at['v']} < __q.p_v THEN 'val' "
        f"WHEN {at['t']} > __q.p_t AND {at['v']} > __q.p_v THEN 'train' END"))
    out = [*df.columns, split_col]
    plain = d.where(F.col(split_col).isNotNull()).select(out)

    # rows in a prefix that a cut runs through: ranked inside it
    edge = d.where(F.col(split_col).isNull()).withColumn("__e", F.expr(
        f"CASE WHEN {at['t']} = __q.p_t THEN struct(__q.p_t AS p, __q.before_t AS before) ELSE struct(__q.p_v AS p, __q.before_v AS before) END"))
    edge = edge.withColumn("__prefix", F.col("__e.p"))
    if largest <= max_rank_rows:
        w = Window.partitionBy("__c", "__prefix").orderBy("__k", F.col(id_col))
        edge = edge.withColumn("__r", F.row_number().over(w).cast("bigint"))
    else:  # equal ids beyond the longest prefix: numbered across range partitions
        edge = edge.withColumn("__u", F.monotonically_increasing_id())
        edge = ordered_scan(edge, ["__c", "__prefix"], ["__k", "__u"], [Spec("__r", "row_number")])
    place = "(__e.before + __r - 1)"
    edge = edge.withColumn(split_col, F.expr(f"CASE WHEN {place} < __q.test THEN 'test' WHEN {place} < __q.test + __q.val THEN 'val' ELSE 'train' END"))
    return plain.unionByName(edge.select(out))


def split_counts(split_df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    return (split_df.groupBy(split_col, label).agg(F.count(F.lit(1)).cast("bigint").alias("n")))
