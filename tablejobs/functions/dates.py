"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: end of an interval that has no following purchase.
OPEN_END = dt.date(3499, 12, 31)

DateLike = Column | dt.date | str | None


def as_date(value: DateLike) -> Column:
    """A date column from a date, an ISO text, a column, or (None) the current date."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def month_boundaries(later: Column, earlier: Column) -> Column:
    """Number of month boundaries between two dates: 31 January to 1 February is 1."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def month_start(day: Column, months: int) -> Column:
    """First day of the month that lies `months` after the month of `day`."""
    return F.add_months(F.trunc(day, "MM"), months)


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; text that does not fit the pattern gives NULL, also under ANSI rules."""
    return F.try_to_date(text, pattern)


def within_lookback(df: DataFrame, column: str, run_date: DateLike, lookback_days: int) -> Column:
    """`column` on or after the first look-back day.

    The bound is cast to the column's type, not the column to a date, so that the comparison reaches
    the Parquet reader (and prunes partitions where the column is one).
    """
    bound = F.date_sub(as_date(run_date), lookback_days)
    return F.col(column) >= bound.cast(df.schema[column].dataType)


def spine_days(run_date: DateLike, lookback_days: int) -> Column:
    """Array of every day of the look-back, both ends included."""
    run = as_date(run_date)
    return F.sequence(F.date_sub(run, lookback_days), run)
