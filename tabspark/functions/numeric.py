"""Guarded arithmetic and display rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonzero(den: Column) -> Column:
    """``nullif(den, 0)``: a divisor that can never raise DIVIDE_BY_ZERO.

    A ``CASE WHEN den = 0`` guard is not enough under ANSI mode: common
    subexpression elimination may evaluate a repeated ``num / den`` before
    the CASE chooses a branch.
    """
    return F.when(den != 0, den)


def zero_div(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (metric convention, zero_division=0)."""
    return F.coalesce(num / nonzero(den), F.lit(0.0))


def round4(c: Column, digits: int = 4) -> Column:
    """Display rounding that two engines agree on.

    A value such as 143/160 = 0.89375 is stored as 0.8937499999999999; one
    engine rounds its decimal string half-up (0.8937), another scales by 10^4
    first (0.8938). Snapping to 10 decimals first makes both see 0.89375.
    """
    return F.round(F.round(c.cast("double"), 10), digits)
