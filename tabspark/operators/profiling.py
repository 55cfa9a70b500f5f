"""Profiling operators.

Design: at most a few scans of the table per operator, each a single
aggregate whose result is bounded by the number of columns (or bins); the
per-column statistics come back to the driver as a handful of numbers and are
applied to the data as literals (no cross join, no per-feature action).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions import sqltext as Q
from tabspark.functions.numeric import nonzero, round4
from tabspark.operators.quantiles import MAX_SALT, unpivot, wide_quantiles
from tabspark.schema import col
from tabspark.session import local_frame


def _small_frame(spark, rows, schema: str) -> DataFrame:
    """Driver-side results whose size is bounded by the column count."""
    return local_frame(spark, rows, schema)


# ---------------------------------------------------------------- A1, A2, S5
def shape(df: DataFrame) -> DataFrame:
    """Row and column count (A1)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, row count."""
    spark = df.sparkSession
    n = df.count()
    rows = [(i + 1, f.name, f.dataType.simpleString(), n) for i, f in enumerate(df.schema.fields)]
    return _small_frame(spark, rows, "position int, column_name string, data_type string, n_rows bigint")


def dtype_counts(df: DataFrame) -> DataFrame:
    """Histogram of column types (A2)."""
    return table_info(df).groupBy("data_type").agg(F.count(F.lit(1)).alias("n_columns"))


# ---------------------------------------------------------------- A3, P12
def _missing(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _missing_sql(name: str, dtype: T.DataType) -> str:
    c = Q.ident(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"({c} IS NULL OR isnan({c}))"
    return f"{c} IS NULL"


def missing_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and percent per column in one aggregate pass (A3)."""
    fields = df.schema.fields
    aggs = [f"CAST(sum(CASE WHEN {_missing_sql(f.name, f.dataType)} THEN 1 ELSE 0 END) AS BIGINT) AS m{i}"
            for i, f in enumerate(fields)]
    one = df.selectExpr("count(1) AS __n", *aggs)
    stack = "explode(array(" + ", ".join(
        f"named_struct('column_name', {Q.str_lit(f.name)}, 'missing', m{i})" for i, f in enumerate(fields)) + ")) AS s"
    out = one.selectExpr("__n", stack).selectExpr(
        "s.column_name AS column_name", "s.missing AS missing",
        Q.round4("s.missing * 100.0D / nullif(__n, 0)") + " AS missing_pct")
    return out.where(F.col("missing") > 0) if only_missing else out


# ---------------------------------------------------------------- A4, A6
def moments(df: DataFrame, features: list[str]) -> dict[str, dict]:
    """count/mean/std/var/min/max per feature in one aggregate (driver gets 6 x width numbers)."""
    aggs = []
    for i, f in enumerate(features):
        c = Q.num(f)
        aggs += [f"count({c}) AS c{i}", f"avg({c}) AS a{i}", f"stddev_samp({c}) AS s{i}",
                 f"var_samp({c}) AS v{i}", f"min({c}) AS lo{i}", f"max({c}) AS hi{i}",
                 f"stddev_pop({c}) AS sp{i}"]
    r = df.selectExpr(*aggs).first()  # a global aggregate: SQL text, one parse
    return {f: dict(count=r[f"c{i}"], mean=r[f"a{i}"], std=r[f"s{i}"], var=r[f"v{i}"],
                    min=r[f"lo{i}"], max=r[f"hi{i}"], std_pop=r[f"sp{i}"])
            for i, f in enumerate(features)}


def describe_numeric(df: DataFrame, features: list[str], exact: bool = True) -> DataFrame:
    """count, mean, std (ddof=1), min, 25/50/75 %, max per feature (A4).

    Quantiles are exact (sketch, then counts; the sketch's scan gives the moments too) unless
    ``exact=False`` (``percentile_approx``).
    """
    rows = []
    if exact:
        for (f,), (n, q, m) in wide_quantiles(df, features, [0.25, 0.5, 0.75], moments=True).items():
            s = m["s"]
            std = math.sqrt(s["m"] / (n - 1)) if n > 1 else None
            rows.append((f, n, s["a"] if n else None, std, m["lo"], *q, m["hi"]))
    else:
        m, qs = moments(df, features), _quantiles(df, features, [0.25, 0.5, 0.75], exact=False)
        for f in features:
            s, q = m[f], qs.get((f,), (0, [None] * 3))[1]
            rows.append((f, int(s["count"]), s["mean"], s["std"], s["min"], *q, s["max"]))
    spark = df.sparkSession
    out = _small_frame(spark, rows, "feature string, count bigint, mean double, std double, min double, "
                                    "q25 double, q50 double, q75 double, max double")
    return Q.rounded_select(out, ["feature", "count"], ["mean", "std", "min", "q25", "q50", "q75", "max"])


def _quantiles(df: DataFrame, features: list[str], probs: list[float], by: str | None = None, exact: bool = True) -> dict:
    keys = [by] if by else []
    if exact:
        return {key: (n, q) for key, (n, q, _) in wide_quantiles(df, features, probs, keys).items()}
    long_df = unpivot(df, features, keys)
    agg = (long_df.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", *keys)
           .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", probs, 10000).alias("q")).collect())
    return {tuple(r[k] for k in ["feature", *keys]): (r["n"], list(r["q"])) for r in agg}


def quantile_table(df: DataFrame, features: list[str], probs: list[float], by: str | None = None, **kw) -> DataFrame:
    """(feature, [by,] n, p, value): exact linear quantiles of every feature, per class of ``by``; ``kw`` as
    for ``wide_quantiles``. A feature without values has no rows."""
    got = wide_quantiles(df, features, probs, [by] if by else [], **kw)
    rows = [(*key, n, float(p), v) for key, (n, values, _) in got.items() if n for p, v in zip(probs, values)]
    cls = f"{Q.ident(by)} {df.schema[by].dataType.simpleString()}, " if by else ""
    out = _small_frame(df.sparkSession, rows, f"feature string, {cls}n bigint, p double, value double")
    return Q.rounded_select(out, ["feature", *([by] if by else []), "n", "p"], ["value"])


def variance_profile(df: DataFrame, features: list[str]) -> DataFrame:
    """Sample variance per feature."""
    m = moments(df, features)
    return _small_frame(df.sparkSession, [(f, m[f]["var"]) for f in features], "feature string, variance double")


def top_variance(df: DataFrame, features: list[str], n: int = 10) -> DataFrame:
    """Top-n features by variance, ties by name (K2); all if <= n."""
    v = variance_profile(df, features)
    ranked = v.orderBy(F.col("variance").desc_nulls_last(), F.col("feature")).limit(n)
    return ranked.select("feature", round4(F.col("variance")).alias("variance"))


# ---------------------------------------------------------------- A5
def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count per target value, share of non-null rows and of all rows (A5)."""
    counts = df.groupBy(col(target).cast("string").alias(target)).agg(F.count(F.lit(1)).alias("n"))
    # the grouped table has one row per class: the window over it is bounded
    w = F.sum("n").over(_whole())
    w_nonnull = F.sum(F.when(F.col(target).isNotNull(), F.col("n")).otherwise(0)).over(_whole())
    return counts.select(
        F.col(target), F.col("n").cast("bigint").alias("n"),
        round4(F.when(F.col(target).isNotNull(), F.col("n") * 100.0 / nonzero(w_nonnull))).alias("share_pct"),
        round4(F.col("n") * 100.0 / nonzero(w)).alias("share_all_pct"))


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy()


# ---------------------------------------------------------------- A7, A8, K1
class CoMoments:
    """For each pair of k columns, over the rows that have both: n, means, sums of squared differences and of their products, and
    the bounds of either column (arrays of k x k; ``[i, j]`` is about column i among the rows with j)."""

    def __init__(self, k: int):
        self.n, self.mean, self.m2, self.c = (np.zeros((k, k)) for _ in range(4))
        self.lo, self.hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)

    @classmethod
    def of(cls, x: np.ndarray) -> "CoMoments":
        """Of the rows of ``x``; NaN is missing."""
        out, there = cls(x.shape[1]), ~np.isnan(x)
        with np.errstate(invalid="ignore", divide="ignore"):
            shift = np.where(there.any(0), np.where(there, x, 0.0).sum(0) / there.sum(0), 0.0)  # a batch's own means, against cancellation
            d, m = np.where(there, x - shift, 0.0), there.astype(np.float64)
            out.n, s = m.T @ m, d.T @ m
            out.mean = np.where(out.n > 0, s / out.n, 0.0)
            out.m2 = (d * d).T @ m - out.n * out.mean ** 2
            out.c = d.T @ d - out.n * out.mean * out.mean.T
        out.mean += shift[:, None]
        for j in range(x.shape[1]):
            if len(rows := x if there[:, j].all() else x[there[:, j]]):
                out.lo[:, j], out.hi[:, j] = np.fmin.reduce(rows, 0, initial=np.inf), np.fmax.reduce(rows, 0, initial=-np.inf)
        return out

    def merge(self, o: "CoMoments") -> None:
        """The parallel update: the state of the rows of both."""
        n = self.n + o.n
        part, d = o.n / np.maximum(n, 1), o.mean - self.mean
        self.m2 += o.m2 + d * d * self.n * part
        self.c += o.c + d * d.T * self.n * part
        self.mean += d * part
        self.n, self.lo, self.hi = n, np.minimum(self.lo, o.lo), np.maximum(self.hi, o.hi)


_PAIR = "n double, ax double, ay double, mx double, my double, c double, lox double, hix double, loy double, hiy double"


def _pair_partials(k: int):
    """mapInArrow function: the co-moments of a task's rows, a row a pair."""
    def run(batches):
        import pyarrow as pa
        t = CoMoments(k)
        for b in batches:
            if b.num_rows:
                t.merge(CoMoments.of(np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(k)])))
        ii, jj = np.meshgrid(np.arange(k, dtype=np.int32), np.arange(k, dtype=np.int32), indexing="ij")
        cols = [ii, jj, t.n, t.mean, t.mean.T, t.m2, t.m2.T, t.c, t.lo, t.hi, t.lo.T, t.hi.T]
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel()) for c in cols], names=["i", "j", *(f.split()[0] for f in _PAIR.split(", "))])
    return run


# two states (p, s) of a pair as one
_PAIR_MERGE = """(p, s) -> named_struct('n', p.n + s.n, 'ax', p.ax + (s.ax - p.ax) * s.n / (p.n + s.n), 'ay', p.ay + (s.ay - p.ay) * s.n / (p.n + s.n),
  'mx', p.mx + s.mx + (s.ax - p.ax) * (s.ax - p.ax) * p.n * s.n / (p.n + s.n), 'my', p.my + s.my + (s.ay - p.ay) * (s.ay - p.ay) * p.n * s.n / (p.n + s.n),
  'c', p.c + s.c + (s.ax - p.ax) * (s.ay - p.ay) * p.n * s.n / (p.n + s.n),
  'lox', least(p.lox, s.lox), 'hix', greatest(p.hix, s.hix), 'loy', least(p.loy, s.loy), 'hiy', greatest(p.hiy, s.hiy))"""


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair (A7), in one scan.

    Each task folds its rows into k x k co-moments (``CoMoments``, NumPy on Arrow batches); the k^2 states per task are merged
    by the parallel update rule in two salted levels. Null where either column is constant on the rows that have both,
    or has no such row.
    """
    k = len(columns)
    # missing (null or NaN) travels to the NumPy fold as NaN
    wide = df.selectExpr(*[f"coalesce({Q.num(c)}, CAST('NaN' AS DOUBLE)) AS x{i}" for i, c in enumerate(columns)])
    s = wide.mapInArrow(_pair_partials(k), f"i int, j int, {_PAIR}").where("n > 0")
    names = [f.split()[0] for f in _PAIR.split(", ")]
    salt = min(MAX_SALT, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    start = {"lox": math.inf, "loy": math.inf, "hix": -math.inf, "hiy": -math.inf}
    zero = "named_struct(" + ", ".join(f"'{x}', {Q.dbl(start.get(x, 0.0))}" for x in names) + ")"
    fold = f"aggregate(collect_list(s), {zero}, {_PAIR_MERGE})"
    s = s.selectExpr("i", "j", f"spark_partition_id() % {salt} AS salt", f"struct({', '.join(names)}) AS s")
    s = s.groupBy("i", "j", "salt").agg(F.expr(fold).alias("s")).groupBy("i", "j").agg(F.expr(fold).alias("s"))
    every = df.sparkSession.range(k * k).selectExpr(f"CAST(id div {k} AS INT) AS i", f"CAST(id % {k} AS INT) AS j")
    s = every.join(s, ["i", "j"], "left")  # pairs without a common row
    names = "array(" + ", ".join(Q.str_lit(c) for c in columns) + ")"
    corr = ("CASE WHEN s.lox < s.hix AND s.loy < s.hiy THEN least(greatest(s.c / (sqrt(s.mx) * sqrt(s.my)), -1.0D), 1.0D) END")
    return s.selectExpr(f"element_at({names}, i + 1) AS feature_a",
                        f"element_at({names}, j + 1) AS feature_b",
                        f"{Q.round4(corr)} AS corr")


def target_correlation(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Correlation of each feature with the 0/1 target (A8): one aggregate, a covariance per feature.
    Null where either side is constant on the rows that have both."""
    y = Q.num(label)
    aggs = []
    for i, f in enumerate(features):
        x = Q.num(f)
        on_x, on_y = f"CASE WHEN {x} IS NOT NULL THEN {y} END", f"CASE WHEN {y} IS NOT NULL THEN {x} END"
        aggs.append(f"CASE WHEN min({on_y}) < max({on_y}) AND min({on_x}) < max({on_x}) "
                    f"THEN least(greatest(covar_pop({x}, {y}) / nullif(stddev_pop({on_y}) * stddev_pop({on_x}), 0), -1.0D), 1.0D) END AS c{i}")
    rows = ", ".join(f"struct({Q.str_lit(f)} AS feature, {Q.round4(f'c{i}')} AS corr)" for i, f in enumerate(features))
    return df.selectExpr(*aggs).selectExpr(f"inline(array({rows}))")


def top_correlations(df: DataFrame, features: list[str], label: str, n: int = 10) -> DataFrame:
    """Top-n |corr| with the target, the target itself excluded by name (K1)."""
    tc = target_correlation(df, features, label)
    return (tc.where(F.col("corr").isNotNull())
            .orderBy(F.abs("corr").desc(), F.col("feature")).limit(n)
            .select("feature", F.abs("corr").alias("abs_corr")))


# ---------------------------------------------------------------- A9, K3, P11
def iqr_bounds(df: DataFrame, features: list[str], k: float = 1.5, exact: bool = True) -> dict:
    qs = _quantiles(df, features, [0.25, 0.75], exact=exact)
    out = {}
    for f in features:
        n, (q1, q3) = qs.get((f,), (0, [None, None]))
        if q1 is None:
            continue
        iqr = q3 - q1
        out[f] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def outlier_mask(c: Column, lower: float, upper: float) -> Column:
    """Strict outlier predicate."""
    return (c < F.lit(lower)) | (c > F.lit(upper))


def outlier_profile(df: DataFrame, features: list[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """IQR outliers per feature: count, %, min, max, bounds; only % > 0.

    Quantile passes, then ONE counting pass with the bounds as literals.
    """
    spark = df.sparkSession
    b = iqr_bounds(df, features, k, exact)
    aggs = ["count(1) AS __n"]
    for i, f in enumerate(features):
        if f not in b:
            continue
        c = Q.num(f)
        aggs += [f"sum(CASE WHEN {c} < {Q.dbl(b[f][2])} OR {c} > {Q.dbl(b[f][3])} THEN 1 ELSE 0 END) AS o{i}",
                 f"min({c}) AS mn{i}", f"max({c}) AS mx{i}"]
    r = df.selectExpr(*aggs).first()
    n = r["__n"]
    rows = []
    for i, f in enumerate(features):
        if f not in b or not n:
            continue
        cnt = int(r[f"o{i}"] or 0)
        if cnt > 0:
            rows.append((f, cnt, cnt * 100.0 / n, r[f"mn{i}"], r[f"mx{i}"], b[f][2], b[f][3]))
    out = _small_frame(spark, rows, "feature string, outlier_count bigint, outlier_pct double, min double, "
                                    "max double, lower_bound double, upper_bound double")
    return Q.rounded_select(out, ["feature", "outlier_count"],
                            ["outlier_pct", "min", "max", "lower_bound", "upper_bound"])


def top_outliers(df: DataFrame, features: list[str], n: int = 5, k: float = 1.5) -> DataFrame:
    """Top-n outlier columns by percent, ties by name (K3)."""
    return (outlier_profile(df, features, k).orderBy(F.col("outlier_pct").desc(), F.col("feature"))
            .limit(n).select("feature", "outlier_pct"))


def outlier_rows(df: DataFrame, features: list[str], id_col: str, k: float = 1.5) -> DataFrame:
    """(id, feature, value) of every outlying cell (P11); a narrow filter after a
    generate, bounds inlined as literals."""
    b = iqr_bounds(df, features, k)
    long_df = unpivot(df, [f for f in features if f in b], [id_col])
    cond = " OR ".join(f"(feature = {Q.str_lit(f)} AND NOT isnan(value) AND (value < {Q.dbl(lo)} OR value > {Q.dbl(hi)}))"
                       for f, (_, _, lo, hi) in b.items()) or "FALSE"
    return long_df.where(cond).selectExpr(Q.ident(id_col), "feature", Q.round4("value") + " AS value")


# ---------------------------------------------------------------- A10, A11
def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram of one column, last bin closed, zero-filled (A10).
    One moments pass, then one grouped count over ``bins`` keys (map-side
    combined); see ``histograms`` for several columns at once."""
    return histograms(df, [column], bins).select("bin", "bin_lo", "bin_hi", "n")


def kde(df: DataFrame, column: str, points: int = 200, bins: int = 30) -> DataFrame:
    """Gaussian KDE (Scott bandwidth sigma*n^-1/5) of one column on a min..max
    grid, scaled to histogram counts (density * n * bin width) (A11); see
    ``kdes`` for several columns in one pass."""
    return kdes(df, [column], points, bins).select("point", "x", "density_count")


def histograms(df: DataFrame, features: list[str], bins: int = 30, m: dict | None = None) -> DataFrame:
    """Equal-width histograms of several columns in one grouped count over
    (feature, bin) after one moments pass — no per-feature job (A10 for the
    top-variance features). Adds each feature's mean/std (the plot label)."""
    spark = df.sparkSession
    m = m or moments(df, features)
    long_df = unpivot(df, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    lo = {f: m[f]["min"] for f in features if m[f]["min"] is not None}
    if not lo:
        return _small_frame(spark, [], "feature string, bin int, bin_lo double, bin_hi double, n bigint, "
                                       "mean double, std double")
    span = {f: (m[f]["max"] - m[f]["min"]) for f in lo}
    mn_of = "element_at(map(" + ", ".join(f"{Q.str_lit(f)}, {Q.dbl(lo[f])}" for f in lo) + "), feature)"
    sp_of = "element_at(map(" + ", ".join(f"{Q.str_lit(f)}, {Q.dbl(span[f])}" for f in lo) + "), feature)"
    b = (f"CAST(CASE WHEN {sp_of} > 0 THEN least(floor((value - {mn_of}) / {sp_of} * {bins}), {bins - 1}) "
         f"ELSE 0 END AS INT)")
    counts = long_df.groupBy(F.col("feature"), F.expr(b).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = _small_frame(spark, [(f, i, lo[f] + i * (span[f] / bins), lo[f] + (i + 1) * (span[f] / bins),
                                 m[f]["mean"], m[f]["std"]) for f in lo for i in range(bins)],
                        "feature string, bin int, bin_lo double, bin_hi double, mean double, std double")
    # grid holds features x bins rows: bounded
    out = grid.join(counts, ["feature", "bin"], "left")
    return out.selectExpr("feature", "bin", Q.round4("bin_lo") + " AS bin_lo", Q.round4("bin_hi") + " AS bin_hi",
                          "CAST(coalesce(n, 0) AS BIGINT) AS n",
                          Q.round4("mean") + " AS mean", Q.round4("std") + " AS std")


#: Terms of the expansion around a cell's centre. A value lies at most half a bandwidth from it, so a kernel (height 1) is off
#: by less than 1.09 * sum over k >= 20 of 0.5 ** k / sqrt(k!) < 1e-15, far below the display rounding.
KDE_TERMS = 20


class GaussCells:
    """Sums of Gaussian kernels of width ``h`` at the ``grid``, for any number of values.

    Values fall into cells of one bandwidth; a cell keeps the ``KDE_TERMS`` moments of its values, and only cells meet the grid
    (a truncated Hermite expansion), so the cost of a value does not depend on the points. Equal values of a batch are taken once."""

    def __init__(self, grid: np.ndarray, h: float):
        self.grid, self.h = grid, h
        self.cells, self.moments = np.zeros(0), np.zeros((0, KDE_TERMS))

    def add(self, x: np.ndarray) -> None:
        x, count = np.unique(x, return_counts=True)
        cell = np.floor((x - self.grid[0]) / self.h)
        cells, at = np.unique(cell, return_inverse=True)
        u = (x - self.grid[0] - (cell + 0.5) * self.h) / (math.sqrt(2) * self.h)
        m = np.empty((len(cells), KDE_TERMS))
        term = count.astype(np.float64)
        for k in range(KDE_TERMS):  # u ** k / k!
            m[:, k] = np.bincount(at, weights=term, minlength=len(cells))
            term = term * u / (k + 1)
        both, at = np.unique(np.concatenate([self.cells, cells]), return_inverse=True)
        total = np.zeros((len(both), KDE_TERMS))
        n = len(self.cells)
        total[at[:n]] = self.moments  # cells are distinct on either side
        total[at[n:]] += m
        self.cells, self.moments = both, total

    def sums(self) -> np.ndarray:
        out = np.zeros(len(self.grid))
        for s in range(0, len(self.cells), 512):
            centre = self.grid[0] + (self.cells[s:s + 512, None] + 0.5) * self.h
            t = (self.grid[None, :] - centre) / (math.sqrt(2) * self.h)
            before, now = np.zeros_like(t), np.exp(-t * t)  # Hermite functions by their recurrence
            for k in range(KDE_TERMS):
                out += self.moments[s:s + 512, k] @ now
                before, now = now, 2 * t * now - 2 * k * before
        return out


def _kde_multi_partials(grids: np.ndarray, hs: np.ndarray):
    k, points = grids.shape

    def run(batches):
        import pyarrow as pa
        cells = [GaussCells(grids[j], hs[j]) for j in range(k)]
        for b in batches:
            for j in range(k):
                x = b.column(j).to_numpy(zero_copy_only=False).astype(np.float64)
                cells[j].add(x[~np.isnan(x)])
        acc = np.array([c.sums() for c in cells])
        fi, pi = np.meshgrid(np.arange(k), np.arange(points), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(fi.ravel().astype(np.int32)), pa.array(pi.ravel().astype(np.int32)),
                                          pa.array(acc.ravel())], names=["f", "point", "k"])
    return run


def kdes(df: DataFrame, features: list[str], points: int = 200, bins: int = 30, m: dict | None = None) -> DataFrame:
    """Gaussian KDE curves of several columns in ONE NumPy pass (A11 for the
    top-variance features): each task folds its rows into cells (``GaussCells``) and
    these into k x ``points`` partial sums."""
    spark = df.sparkSession
    m = m or moments(df, features)
    use = [f for f in features if m[f]["count"] and m[f]["std"]]
    if not use:
        return _small_frame(spark, [], "feature string, point int, x double, density_count double")
    grids, hs, scales = [], [], []
    for f in use:
        n, sd, mn, mx = m[f]["count"], m[f]["std"], m[f]["min"], m[f]["max"]
        h = sd * n ** (-0.2)
        grids.append([mn + (mx - mn) * i / (points - 1) for i in range(points)])
        hs.append(h)
        scales.append(1.0 / (n * h * math.sqrt(2 * math.pi)) * n * ((mx - mn) / bins))
    wide = df.selectExpr(*[f"coalesce({Q.as_double(f)}, CAST('NaN' AS DOUBLE)) AS x{j}" for j, f in enumerate(use)])
    parts = wide.mapInArrow(_kde_multi_partials(np.asarray(grids), np.asarray(hs)), "f int, point int, k double")
    sums = parts.groupBy("f", "point").agg(F.sum("k").alias("k"))
    # grid points and scales as array literals (features x points values: bounded)
    names = "array(" + ", ".join(Q.str_lit(f) for f in use) + ")"
    xs = "array(" + ", ".join(Q.dbl(g) for grid in grids for g in grid) + ")"
    sc = "array(" + ", ".join(Q.dbl(x) for x in scales) + ")"
    return sums.selectExpr(f"element_at({names}, f + 1) AS feature", "point",
                           Q.round4(f"element_at({xs}, f * {points} + point + 1)") + " AS x",
                           Q.round4(f"k * element_at({sc}, f + 1)") + " AS density_count")


def top_variance_features(df: DataFrame, features: list[str], n: int = 10, m: dict | None = None) -> list[str]:
    """Names of the top-n features by sample variance (ties by name), all if <= n."""
    m = m or moments(df, features)
    if len(features) <= n:
        return list(features)
    ranked = sorted(features, key=lambda f: (-(m[f]["var"] if m[f]["var"] is not None else -math.inf), f))
    return ranked[:n]


# ---------------------------------------------------------------- A12, A13
def box_stats(df: DataFrame, features: list[str], by: str | None = None, whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per feature (and per ``by`` value): q1, median, q3,
    whiskers at the last datum inside 1.5 IQR, flier count (A12/A13).

    Exact quantiles, then ONE conditional aggregate over the long view joined
    to the per-group bounds (a broadcast of features x classes rows).
    """
    spark = df.sparkSession
    qs = _quantiles(df, features, [0.25, 0.5, 0.75], by=by)
    keys = ["feature"] + ([by] if by else [])
    rows = []
    for key, (n, (q1, med, q3)) in qs.items():
        if q1 is None:
            continue
        iqr = q3 - q1
        rows.append((*key, q1, med, q3, q1 - whis * iqr, q3 + whis * iqr))
    schema = ("feature string" + (f", {by} {df.schema[by].dataType.simpleString()}" if by else "")
              + ", q1 double, median double, q3 double, lo double, hi double")
    bounds = _small_frame(spark, rows, schema)
    long_df = unpivot(df, features, [by] if by else None)
    v = F.col("value")
    inside = (v >= F.col("lo")) & (v <= F.col("hi"))
    joined = long_df.where(v.isNotNull() & ~F.isnan(v)).join(F.broadcast(bounds), keys)
    agg = joined.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_fliers"))
    return agg.selectExpr(*[Q.ident(c) for c in keys],
                          *[f"{Q.round4(c)} AS {c}" for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                          "n_fliers")


# ---------------------------------------------------------------- A22
def eda_report(df: DataFrame, features: list[str], label: str | None, k: float = 1.5, top: int = 5) -> DataFrame:
    """The EDA text report as ordered (line, section, key, value) rows (A22):
    shape, class counts with shares (and rows without a class, if any), columns with missing
    values, top outlier columns. Every part is one of the bounded profiles above. Without a
    label (None) there are no class lines."""
    spark = df.sparkSession
    n = df.count()
    rows = [(1, "shape", "rows", n, None), (2, "shape", "columns", len(df.columns), None)]
    if label is not None:
        y = F.col(label)
        cls = df.agg(F.count_if(y == 0).alias("class_0"), F.count_if(y == 1).alias("class_1"),
                     F.count_if(y.isNull()).alias("no_class")).first()
        for i, c in enumerate(("class_0", "class_1", "no_class")):
            if i < 2 or cls[c]:
                rows.append((3 + i, "target", c, cls[c], cls[c] * 100.0 / n if n else None))
    miss = missing_profile(df.drop(label) if label is not None else df, only_missing=True).collect()
    line = 10
    if miss:
        for r in miss:
            rows.append((line, "missing", r["column_name"], int(r["missing"]), r["missing"] * 100.0 / n))
            line += 1
    else:
        rows.append((line, "missing", "none", 0, None))
    outl = (outlier_profile(df, features, k).orderBy(F.col("outlier_pct").desc(), F.col("feature"))
            .limit(top).collect())
    line = max(100, line)
    for r in outl:
        rows.append((line, "outliers", r["feature"], int(r["outlier_count"]), r["outlier_count"] * 100.0 / n))
        line += 1
    base = local_frame(spark, rows, "line int, section string, key string, cnt bigint, pct double")
    pct_txt = F.concat(round4(F.col("pct"), 1).cast("string"), F.lit("%"))
    value = (F.when(F.col("section") == "outliers", pct_txt)
             .when(F.col("pct").isNull(), F.col("cnt").cast("string"))
             .otherwise(F.concat(F.col("cnt").cast("string"), F.lit(" ("), pct_txt, F.lit(")"))))
    return base.select("line", "section", "key", value.alias("value"))
