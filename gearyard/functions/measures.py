"""Rounding, averages and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double as numpy does: ties go to the even neighbour."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double as SQL ROUND does: ties go away from zero."""
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale


def mean(total: Column, count: Column) -> Column:
    """Average from an exact (decimal) total and a count; NULL without rows."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
