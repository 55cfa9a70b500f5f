"""Exact quantiles without one-task groups, in at most three scans.

Spark's ``percentile`` keeps every distinct value of a group in the task that
finishes the group: a table-wide quantile of a 100 TB column would land in one
task. Here a mergeable sketch says where to look and counts say what is there:

1. one aggregate over all columns at once (groups: optional keys) gives n, min,
   max and a KLL sketch of every column, merged in two salted levels so that no
   task merges the sketches of all others. The sketch's rank error bounds an
   interval of values around each wanted rank;
2. if such an interval may hold more than ``final_rows`` rows, a second scan
   sketches the rows inside the intervals and counts those below them, which
   narrows the intervals by the same factor again;
3. the last scan counts the rows below each interval and the rows of each value
   inside it (NumPy per Arrow batch, combined before the shuffle), and running
   counts over these values find the ranks: in one window per interval where
   the bounds allow at most ``final_rows`` values, else by an ordered scan over
   range partitions, so that any number will do.

The result is exact whatever the sketches say: a rank is only taken from an
interval whose counts enclose it. One that its interval missed (the bounds
are twice the error of 99 in 100 sketches) is searched again in a wider one.

Quantiles use linear interpolation between the order statistics at
floor/ceil of p*(n-1) (pandas/NumPy "linear" = DuckDB ``quantile_cont``).
The driver holds a few numbers per (group, column, rank) and ``k + 1`` cut
points per (group, column), so groups here are classes; ``grouped_quantiles``
takes any number of groups and has no driver state.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions import sqltext as Q
from tabspark.session import local_frame

VALUE = "__v"
SKETCH_K = 1024     # size of a sketch: about 3 k values, rank error 0.0027
MAX_SALT = 1024     # tasks of the first merge


def rank_error(k: int) -> float:
    """Normalised rank error that 99 in 100 KLL sketches of size ``k`` keep to."""
    return 2.296 / k ** 0.9723  # fixed values: the published fit for this sketch


@dataclass
class _Interval:
    """Values of one column in one group that hold the wanted ``ranks``."""
    group: int
    col: int
    lo: float
    hi: float
    ranks: list
    size: float                     # rows that it may hold


class _Columns:
    """The columns x0.. of a frame (NaN as null) and their sketches, counts and values; ``g`` numbers the groups of the keys."""

    def __init__(self, df: DataFrame, features: list[str], keys: list[str]):
        self.keys, self.width, self.spark = keys, len(features), df.sparkSession
        self.ks = [f"__k{i}" for i in range(len(keys))]
        self.df = df.selectExpr(*[f"{Q.ident(c)} AS {k}" for c, k in zip(keys, self.ks)],
                                *[f"{Q.num(f)} AS x{i}" for i, f in enumerate(features)])
        self.schema = ", ".join([*(f"{k} {self.df.schema[k].dataType.simpleString()}" for k in self.ks), "g int"])

    def sketched(self, df: DataFrame, keys: list[str], values: list[str], cuts: list[float], k: int, more: list = (),
                 moments: bool = False) -> list:
        """A row per group: of value i its n{i}, lo{i}, hi{i} and q{i} (sketched values at ``cuts``), with ``moments`` its
        s{i} (n, mean, sum of squared differences); and the sums of ``more``, (name, aggregate) pairs.

        Two levels: the tasks' sketches meet in ``MAX_SALT`` groups first, then these."""
        salt = min(MAX_SALT, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        at = "array(" + ", ".join(Q.dbl(c) for c in cuts) + ")"
        one, two = [f"{e} AS {name}" for name, e in more], [f"CAST(sum({name}) AS BIGINT) AS {name}" for name, _ in more]
        for i, x in enumerate(values):
            one += [f"count({x}) AS n{i}", f"min({x}) AS lo{i}", f"max({x}) AS hi{i}",
                    f"CASE WHEN count({x}) > 0 THEN kll_sketch_agg_double({x}, {k}) END AS q{i}"]
            two += [f"CAST(sum(n{i}) AS BIGINT) AS n{i}", f"min(lo{i}) AS lo{i}", f"max(hi{i}) AS hi{i}",
                    f"CASE WHEN sum(n{i}) > 0 THEN kll_sketch_get_quantile_double(kll_merge_agg_double(q{i}), {at}) END AS q{i}"]
            if moments:
                one.append(f"struct(CAST(count({x}) AS DOUBLE) AS n, avg({x}) AS a, var_pop({x}) * count({x}) AS m) AS s{i}")
                two.append(f"aggregate(filter(collect_list(s{i}), s -> s.n > 0), struct(0D AS n, 0D AS a, 0D AS m), {MERGE}) AS s{i}")
        d = df.withColumn("__salt", F.expr(f"spark_partition_id() % {salt}"))
        d = d.groupBy(*keys, "__salt").agg(*[F.expr(e) for e in one])
        return d.groupBy(*keys).agg(*[F.expr(e) for e in two]).collect()

    def numbered(self, groups: list[tuple]) -> DataFrame:
        if not self.ks:
            return self.df.withColumn("g", F.lit(0))
        of = local_frame(self.spark, [(*g, i) for i, g in enumerate(groups)], self.schema)
        same = [self.df[k].eqNullSafe(of[k]) for k in self.ks]
        return self.df.join(F.broadcast(of), same).select("g", *[f"x{i}" for i in range(self.width)])  # a row a class

    def counted(self, groups: list[tuple], intervals: list[_Interval]) -> DataFrame:
        """(t, v, c): rows of each value inside interval t; those below it under a null value."""
        by: dict = {}
        for t, iv in enumerate(intervals):
            by.setdefault((iv.group, iv.col), []).append((t, iv.lo, iv.hi))
        cols = sorted({iv.col for iv in intervals})
        d = self.numbered(groups).selectExpr("g", *[f"coalesce(x{c}, CAST('NaN' AS DOUBLE)) AS x{c}" for c in cols])
        d = d.mapInArrow(_counter({(g, cols.index(c)): v for (g, c), v in by.items()}, len(intervals)), "t int, v double, c bigint")
        return d.groupBy("t", "v").agg(F.sum("c").alias("c"))


# (n, mean, sum of squared differences) of two sets of rows together
MERGE = ("(p, s) -> struct(p.n + s.n AS n, p.a + (s.a - p.a) * s.n / (p.n + s.n) AS a, "
         "p.m + s.m + (s.a - p.a) * (s.a - p.a) * p.n * s.n / (p.n + s.n) AS m)")


def _counter(by: dict, n: int):
    """mapInArrow function over (g, columns): ``by`` (group, column) the intervals (number, lo, hi)."""
    def run(batches):
        import pyarrow as pa
        below = np.zeros(n, dtype=np.int64)
        for b in batches:
            g = b.column(0).to_numpy(zero_copy_only=False)
            out = []
            for (group, c), ivs in by.items():
                x = b.column(c + 1).to_numpy(zero_copy_only=False)[g == group]
                for t, lo, hi in ivs:
                    below[t] += np.count_nonzero(x < lo)
                    v, count = np.unique(x[(x >= lo) & (x <= hi)], return_counts=True)
                    out.append((np.full(len(v), t, dtype=np.int32), v, count.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["t", "v", "c"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.nulls(n, pa.float64()), pa.array(below)],
                                         names=["t", "v", "c"])
    return run


def _around(rank: float, n: int, lo: float, hi: float, cuts, values, margin: float) -> tuple[float, float, float]:
    """Values around a rank of n by a sketch's ``values`` at ``cuts``, and how many rows may lie between."""
    below = [(c, v) for c, v in zip(cuts, values) if c <= rank / n - margin]
    above = [(c, v) for c, v in zip(cuts, values) if c >= (rank + 1) / n + margin]
    (a, lo), (b, hi) = max(below, default=(0.0, lo)), min(above, default=(1.0, hi))
    return lo, hi, min(n, (b - a + 2 * margin) * n)


def _merged(intervals: list[_Interval]) -> list[_Interval]:
    """Intervals of one column that overlap as one."""
    out: list[_Interval] = []
    for iv in sorted(intervals, key=lambda x: (x.group, x.col, x.lo, x.hi)):
        last = out[-1] if out else None
        if last and (last.group, last.col) == (iv.group, iv.col) and iv.lo <= last.hi:
            if (last.lo, last.hi) != (iv.lo, iv.hi):
                last.size += iv.size
            last.hi, last.ranks = max(last.hi, iv.hi), last.ranks + iv.ranks
        else:
            out.append(iv)
    return out


GRID = [j / 128 for j in range(1, 128)]


def _narrowed(cols: _Columns, groups: list[tuple], intervals: list[_Interval], k: int) -> list[_Interval]:
    """Each interval cut down by a sketch of the rows inside it and the count of those below."""
    margin = 2 * rank_error(k)
    per: dict = {}
    for iv in intervals:
        per.setdefault((iv.group, iv.col), []).append(iv)
    slots = sorted({(c, j) for (_, c), ivs in per.items() for j in range(len(ivs))})
    values, more = [], []
    for c, j in slots:  # the bounds of each group's j-th interval of column c
        iv = [per.get((g, c), [])[j: j + 1] for g in range(len(groups))]
        lo, hi = (f"element_at(array({', '.join(Q.dbl(getattr(x[0], side)) if x else 'CAST(NULL AS DOUBLE)' for x in iv)}), g + 1)" for side in ("lo", "hi"))
        values.append(f"CASE WHEN x{c} >= {lo} AND x{c} <= {hi} THEN x{c} END")
        more.append((f"b{len(more)}", f"count_if(x{c} < {lo})"))
    out = []
    for r in cols.sketched(cols.numbered(groups), ["g"], values, GRID, k, more):
        for i, (c, j) in enumerate(slots):
            for iv in per.get((r["g"], c), [])[j: j + 1]:
                n, below = r[f"n{i}"], r[f"b{i}"]
                for rank in iv.ranks:
                    if below <= rank < below + n:
                        lo, hi, size = _around(rank - below, n, r[f"lo{i}"], r[f"hi{i}"], GRID, r[f"q{i}"], margin)
                        out.append(_Interval(iv.group, iv.col, lo, hi, [rank], size))
                    else:
                        out.append(_Interval(iv.group, iv.col, iv.lo, iv.hi, [rank], iv.size))
    return _merged(out)


def _picked(cols: _Columns, groups: list[tuple], intervals: list[_Interval], final_rows: int) -> list[tuple]:
    """(interval, rank, value) of the ranks that the counts enclose."""
    counts = cols.counted(groups, intervals)
    if max(iv.size for iv in intervals) <= final_rows:
        upto = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        scanned = counts.withColumn("below", F.coalesce(F.sum("c").over(upto), F.lit(0)))
    else:
        from tabspark.operators.scan import Spec, ordered_scan
        scanned = ordered_scan(counts, ["t"], ["v"], [Spec("below", "cumsum_excl", "c")])
    want = local_frame(cols.spark, sorted({(t, r) for t, iv in enumerate(intervals) for r in iv.ranks}), "t int, r bigint")
    got = scanned.join(F.broadcast(want), "t").where("v IS NOT NULL AND below <= r AND r < below + c").select("t", "r", "v").collect()
    return [(x["t"], x["r"], x["v"]) for x in got]


def wide_order_statistics(df: DataFrame, features: list[str], ranks_of, keys: list[str] = (), cuts: list[float] = GRID, *,
                          k: int = SKETCH_K, final_rows: int = 100_000, moments: bool = False) -> dict:
    """``{(feature, *key): (n, {rank: value}, moments or None)}`` of several columns, per group of ``keys``.

    ``ranks_of(n)`` gives the 0-based ranks wanted of n values; null and NaN are no values. ``cuts`` are the
    normalised ranks at which the sketch is read. ``moments`` adds a row with fields n, a (mean), m (sum of
    squared differences) from the same scan, and ``lo`` and ``hi``."""
    cols, margin = _Columns(df, features, list(keys)), 2 * rank_error(k)
    stats = cols.sketched(cols.df, cols.ks, [f"x{i}" for i in range(len(features))], cuts, k, moments=moments)
    groups = [tuple(r[x] for x in cols.ks) for r in stats]
    result, open_ = {}, []
    for g, r in enumerate(stats):
        for i, f in enumerate(features):
            n, lo, hi = r[f"n{i}"] or 0, r[f"lo{i}"], r[f"hi{i}"]
            values = {rank: lo if rank == 0 else hi for rank in ranks_of(n) if rank in (0, n - 1)} if n else {}
            result[(f, *groups[g])] = (n, values, dict(s=r[f"s{i}"], lo=lo, hi=hi) if moments else None)
            open_ += [(g, i, rank) for rank in sorted(set(ranks_of(n)) - set(values))] if n else []
    while open_:
        intervals = []
        for g, i, rank in open_:
            r = stats[g]
            lo, hi, size = _around(rank, r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"], cuts, r[f"q{i}"], margin)
            intervals.append(_Interval(g, i, lo, hi, [rank], size))
        intervals = _merged(intervals)
        if max(iv.size for iv in intervals) > final_rows:
            intervals = _narrowed(cols, groups, intervals, k)
        for t, rank, v in _picked(cols, groups, intervals, final_rows):
            iv = intervals[t]
            result[(features[iv.col], *groups[iv.group])][1][rank] = v
        open_ = [(g, i, rank) for g, i, rank in open_ if rank not in result[(features[i], *groups[g])][1]]
        margin *= 4  # for ranks that a sketch missed by more than twice its usual error
    return result


def quantile_cuts(probs, k: int = SKETCH_K) -> list[float]:
    """Where to read a sketch for the order statistics beside these quantiles, of 2 000 rows or more."""
    margin = 2 * rank_error(k) + 0.0005
    return sorted({c for p in probs for c in (p - margin, p + margin) if 0 < c < 1})


def wide_quantiles(df: DataFrame, features: list[str], probs: list[float], keys: list[str] = (), **kw) -> dict:
    """``{(feature, *key): (n, [q(p) for p in probs], moments or None)}`` with linear interpolation."""
    k = kw.get("k", SKETCH_K)
    got = wide_order_statistics(df, features, linear_ranks(probs), keys, quantile_cuts(probs, k), **kw)
    return {key: (n, [interpolate(n, values, p) for p in probs], m) for key, (n, values, m) in got.items()}


def order_statistics(df: DataFrame, key_cols: list[str], value_col: str, ranks_of, *, buckets: int = SKETCH_K, **kw):
    """``{key_tuple: (n, {rank: value})}`` of one column per group; ``buckets`` is about how many intervals a
    sketch tells apart (its size, at least 8)."""
    got = wide_order_statistics(df, [value_col], ranks_of, key_cols, k=max(8, buckets), **kw)
    return {tuple(key): (n, values) for (_, *key), (n, values, _) in got.items()}


def linear_ranks(probs):
    def ranks(n: int) -> list[int]:
        if n <= 0:
            return []
        out = []
        for p in probs:
            pos = p * (n - 1)
            out += [int(math.floor(pos)), int(math.ceil(pos))]
        return out
    return ranks


def interpolate(n: int, values: dict[int, float], p: float) -> float | None:
    if n <= 0:
        return None
    pos = p * (n - 1)
    lo, hi = int(math.floor(pos)), int(math.ceil(pos))
    a, b = values[lo], values[hi]
    if lo == hi:
        return a
    frac = pos - lo
    return a + (b - a) * frac


def exact_quantiles(df: DataFrame, key_cols: list[str], value_col: str, probs: list[float], *, buckets: int = SKETCH_K, **kw):
    """``{key: (n, [q(p) for p in probs])}`` of one column per group, with linear interpolation."""
    got = wide_quantiles(df, [value_col], probs, key_cols, k=max(8, buckets), **kw)
    return {tuple(key): (n, q) for (_, *key), (n, q, _) in got.items()}


def unpivot(df: DataFrame, columns: list[str], id_cols: list[str] | None = None,
            name: str = "feature", value: str = "value") -> DataFrame:
    """Long (feature, value) view of numeric columns; one generate step, no shuffle."""
    from tabspark.schema import col
    ids = id_cols or []
    from tabspark.functions import sqltext as Q
    wide = df.selectExpr(*[Q.ident(c) for c in ids], *[f"{Q.as_double(c)} AS {Q.ident(c)}" for c in columns])
    return wide.unpivot([col(c) for c in ids] if ids else [], [col(c) for c in columns], name, value)


def grouped_quantiles(df: DataFrame, key_cols: list[str], value_col: str, probs: list[float]) -> DataFrame:
    """Exact linear quantiles per group for ANY number of groups of any size, as
    a DataFrame with columns key_cols + q0..q{k-1}; groups without a value are absent.

    Rows are counted per (group, value) first, so a hot value is one row; an
    ordered scan (``operators.scan``) gives the rows below each value, and one
    aggregate per group picks the values that hold the wanted ranks. A large
    group spans many tasks, and nothing comes to the driver.
    """
    from tabspark.operators.scan import Spec, ordered_scan
    from tabspark.operators.skew import attach
    clean = df.select(*key_cols, F.col(value_col).cast("double").alias(VALUE))
    clean = clean.where(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))
    counts = clean.groupBy(*key_cols, VALUE).agg(F.count(F.lit(1)).alias("__c"))
    d = ordered_scan(counts, key_cols, [VALUE], [Spec("__below", "cumsum_excl", "__c")])
    n = d.groupBy(*key_cols).agg(F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__rows")).checkpoint(eager=True)  # a row a group
    d = attach(d, n, key_cols, "__rows", [VALUE])
    picked, out = [], []
    for i, p in enumerate(probs):
        pos = f"({float(p)!r}D * (__n - 1))"
        for side in ("floor", "ceil"):
            holds = f"__below <= {side}{pos} AND {side}{pos} < __below + __c"
            picked.append(F.expr(f"max(CASE WHEN {holds} THEN {VALUE} END)").alias(f"__{side}{i}"))
        picked.append(F.expr(f"max({pos} - floor{pos})").alias(f"__part{i}"))
        out.append(F.expr(f"CASE WHEN __floor{i} = __ceil{i} THEN __floor{i} "
                          f"ELSE __floor{i} + (__ceil{i} - __floor{i}) * __part{i} END").alias(f"q{i}"))
    return d.groupBy(*key_cols).agg(*picked).select(*key_cols, *out)
