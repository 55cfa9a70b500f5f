"""Ordered scan and grouped quantiles against pandas/NumPy, with a hot group."""

import numpy as np
import pandas as pd
import pytest

from tabspark.operators.quantiles import grouped_quantiles
from tabspark.operators.scan import Spec, ordered_scan


def _rows(seed=0, hot=3000):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(7):
        n = hot if g == 2 else int(rng.integers(1, 40))  # group 2 holds most rows
        vals = np.round(rng.random(n), 2)  # ties in values
        rows += [(g, e * 10 + 3, float(vals[e])) for e in range(n)]
    return rows


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_scan_matches_pandas(spark, parts):
    rows = _rows()
    df = spark.createDataFrame(rows, "g long, o long, v double")
    specs = [Spec("rn", "row_number"), Spec("cs", "cumsum", "v"), Spec("cx", "cumsum_excl", "v"),
             Spec("cm", "cummax", "v"), Spec("cmx", "cummax_excl", "v"), Spec("am", "argmax_first", "v", "o")]
    out = ordered_scan(df, ["g"], ["o"], specs, num_partitions=parts).toPandas().sort_values(["g", "o"])
    out = out.reset_index(drop=True)
    by_rn = ordered_scan(df, ["g"], ["o"], [Spec("rn", "row_number"), Spec("amr", "argmax_first", "v")],
                         num_partitions=parts).toPandas().sort_values(["g", "o"]).reset_index(drop=True)
    # row number of the first maximum = (o - 3) / 10 + 1 of the reported order value
    assert list(by_rn.amr.astype(int)) == list((out.am.astype(int) - 3) // 10 + 1)
    exp = pd.DataFrame(rows, columns=["g", "o", "v"]).sort_values(["g", "o"]).reset_index(drop=True)
    grp = exp.groupby("g")
    assert (out.rn.to_numpy() == (grp.cumcount() + 1).to_numpy()).all()
    np.testing.assert_allclose(out.cs, grp.v.cumsum())
    np.testing.assert_allclose(out.cx, grp.v.cumsum() - exp.v)
    np.testing.assert_allclose(out.cm, grp.v.cummax())
    np.testing.assert_allclose(out.cmx, grp.v.transform(lambda s: s.cummax().shift(1)))
    am = []
    for _, d in exp.groupby("g"):
        best, a = -np.inf, None
        for o, v in zip(d.o, d.v):
            if v > best:
                best, a = v, o
            am.append(a)
    assert list(out.am.astype(int)) == am


def test_scan_without_groups_and_empty_partitions(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(50)], "o long, v double")
    out = ordered_scan(df, [], ["o"], [Spec("cs", "cumsum_excl", "v")], num_partitions=64).toPandas()
    out = out.sort_values("o")
    v = np.array([i % 3 for i in range(50)], dtype=float)
    np.testing.assert_allclose(out.cs, np.cumsum(v) - v)


def test_grouped_quantiles_small_and_big_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(x)) for g, n in ((0, 2000), (1, 5), (2, 1), (3, 700)) for x in rng.normal(g, 1, n)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in grouped_quantiles(df, ["g"], "v", [0.5, 0.9]).collect()}
    for g in (0, 1, 2, 3):
        x = np.array([v for gg, v in rows if gg == g])
        np.testing.assert_allclose(got[g], np.quantile(x, [0.5, 0.9]), rtol=1e-12)


def test_scan_keys_of_any_type_and_nulls(spark):
    rows = [(None if i % 3 == 0 else f"2024-01-0{i % 3}", i, [None, float("nan"), 2.0, 1.0, 3.0][i % 5]) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, o int, v double").selectExpr("cast(g as date) as g", "o", "v")
    specs = [Spec("rn", "row_number"), Spec("cs", "cumsum", "v"), Spec("cm", "cummax", "v"), Spec("am", "argmax_first", "v", "o")]
    got = {p: sorted(map(str, ordered_scan(df, ["g"], ["o"], specs, num_partitions=p).collect())) for p in (1, 4, 16)}
    assert got[1] == got[4] == got[16] and len(got[1]) == 60
    state = {}
    for r in sorted(ordered_scan(df, ["g"], ["o"], specs, num_partitions=7).collect(), key=lambda r: r.o):
        n, t, m, a = state.get(r.g, (0, 0.0, None, None))
        ok = r.v is not None and r.v == r.v
        if ok and (m is None or r.v > m):
            m, a = r.v, r.o
        state[r.g] = n, t, m, a = n + 1, t + (r.v if ok else 0.0), m, a
        assert (r.rn, r.cs, r.cm, r.am) == (n, t, m, a)
