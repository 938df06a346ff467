"""Sums and means of amounts.

``total`` and ``mean`` are Spark's own ``sum`` and ``avg``. Floating-point sums depend on
summation order in their last digits, which differs between partial aggregates and
micro-batches; where a result must not, name the decimals that the result is to show, or
the scale of the amounts, and the sum is made of exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str, decimals: int | None = None) -> Column:
    """``sum``; with ``decimals`` the finished sum is rounded to so many."""
    out = F.sum(_col(c))
    return out if decimals is None else F.round(out, decimals)


def mean(c: Column | str, decimals: int | None = None) -> Column:
    """``avg``; with ``decimals`` the finished mean is rounded to so many."""
    out = F.avg(_col(c))
    return out if decimals is None else F.round(out, decimals)


def exact_sum(c: Column | str, scale: int) -> Column:
    """Sum of amounts with at most ``scale`` decimals, exact in any order. Further decimals
    are rounded and an amount of 10^(28 - scale) or more raises, so the caller names it."""
    return F.sum(_col(c).cast(f"decimal(28,{scale})"))
