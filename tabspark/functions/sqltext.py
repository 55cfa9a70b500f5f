"""SQL-text builders for wide projections and aggregates.

A wide operator (one aggregate per feature and statistic) written with
Column objects costs one driver-to-JVM call per ``col``/``cast``/``alias``;
the same list as SQL text is parsed by Spark in a single ``selectExpr``.
The plans are identical; only the driver's planning time differs.
"""

from __future__ import annotations

import math


def ident(name: str) -> str:
    """Back-quoted identifier (names such as ``v(g)`` or ``a.b`` stay one column)."""
    return "`" + name.replace("`", "``") + "`"


def dbl(x: float) -> str:
    """Exact DOUBLE literal (``repr`` round-trips; ``D`` keeps it a double, not a decimal)."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{x!r}D" if x >= 0 else f"({x!r}D)"


def as_double(name: str) -> str:
    return f"CAST({ident(name)} AS DOUBLE)"


def num(name: str) -> str:
    """The column as DOUBLE with NaN read as null (pandas' notion of missing)."""
    d = as_double(name)
    return f"CASE WHEN NOT isnan({d}) THEN {d} END"


def str_lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round4(expr: str, digits: int = 4) -> str:
    """SQL form of ``tabspark.functions.numeric.round4`` (snap to 10 decimals, then round)."""
    return f"round(round(CAST({expr} AS DOUBLE), 10), {digits})"


def rounded_select(df, keep: list[str], cols: list[str], digits: int = 4):
    """``df`` projected to ``keep`` as they are plus ``cols`` display-rounded, in one parse."""
    return df.selectExpr(*[ident(c) for c in keep],
                         *[f"{round4(ident(c), digits)} AS {ident(c)}" for c in cols])


def lit(v) -> str:
    """SQL literal of a Python scalar (bool, int, float, str, None)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return dbl(v)
    return str_lit(str(v))
