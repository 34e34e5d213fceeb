"""Numeric scalar expressions.

All divisions go through ``try_divide`` so a zero denominator yields NULL
instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def block_start(col: str | Column, width: int = 10) -> Column:
    """Start of the ``width``-wide block of a 1-based position.

    ``int((n - 1) / width) * width``: 1..10 -> 0, 11..20 -> 10.
    """
    return ((_c(col) - 1) / width).cast("int") * width


def pct_change(value: str | Column, previous: str | Column) -> Column:
    """C14: ``(x - prev) / prev * 100``; NULL when prev is NULL or zero."""
    v, p = _c(value), _c(previous)
    return F.try_divide(v - p, p) * 100


def ratio_pct(numerator: str | Column, denominator: str | Column) -> Column:
    """C17: ``num / den * 100`` (0..100 for a flag sum over a count)."""
    return F.try_divide(_c(numerator), _c(denominator)) * 100


def equal_width_bin(value: str | Column, low: str | Column, high: str | Column,
                    bins: int = 5) -> Column:
    """Left-closed equal-width bin label 0..bins-1 over [low, high].

    The maximum belongs to the last bin. A constant column (high == low)
    is widened to both sides, so every value falls in the middle bin.
    """
    v, lo, hi = _c(value), _c(low), _c(high)
    width = (hi - lo) / bins
    raw = F.floor(F.try_divide(v - lo, width)).cast("int")
    return F.when(hi == lo, F.lit(bins // 2)).otherwise(F.least(raw, F.lit(bins - 1)))


def abs_pct_error(label: str | Column, prediction: str | Column) -> Column:
    """``|(y - p) / y|``; NULL for a zero label so ``avg`` skips it."""
    y, p = _c(label), _c(prediction)
    return F.abs(F.try_divide(y - p, y))


def fixed_point_mean(col: str | Column, decimals: int = 2) -> Column:
    """Mean of values with ``decimals`` fixed decimals (money), computed as an
    exact integer sum of scaled units divided once by the count.

    Unlike a floating ``avg`` the result does not depend on the order the
    partial sums are combined in, so reruns, retried tasks and other
    engines give the same double.
    """
    scale = 10 ** decimals
    units = F.round(_c(col) * scale).cast("long")
    return F.sum(units.cast("decimal(38,0)")).cast("double") / F.count(units) / scale
