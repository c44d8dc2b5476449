"""Time windows relative to an explicit as-of moment.

The bounds are constant expressions, so Catalyst folds them to a literal and
pushes the comparison down to the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: datetime | str) -> Column:
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def months_before(as_of: datetime | str, months: int) -> Column:
    """``as_of`` minus whole months; a missing day is clamped to the month end."""
    return moment(as_of) - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def on_day(timestamp: Column, day: date | str) -> Column:
    """Same calendar day, written as a range so that it reaches the scan."""
    start = date.fromisoformat(day) if isinstance(day, str) else day
    end = start + timedelta(days=1)
    return (timestamp >= moment(start.isoformat())) & (timestamp < moment(end.isoformat()))


def month_of(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM")
