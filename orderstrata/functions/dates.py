"""Calendar arithmetic on date columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any Monday works; days counted from it give the weekday by remainder.
A_MONDAY = datetime.date(1970, 1, 5)


def _days_since_monday(day: Column) -> Column:
    return F.date_diff(day, F.lit(A_MONDAY))


def _weekdays_through(days: Column) -> Column:
    """Weekdays from ``A_MONDAY`` up to and including the given day number."""
    whole_weeks = F.floor(days / 7)
    in_this_week = F.least(F.pmod(days, F.lit(7)) + 1, F.lit(5))
    return whole_weeks * 5 + in_this_week


def business_days(start: str | Column, end: str | Column) -> Column:
    """Weekdays in the closed range between two dates, less one.

    The order of the two dates does not matter, a range without any weekday
    gives -1, and a missing date gives NULL. The cost per row is constant: the
    days in the range are counted by arithmetic and never listed.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    first = _days_since_monday(F.least(start, end))
    last = _days_since_monday(F.greatest(start, end))
    weekdays = _weekdays_through(last) - _weekdays_through(first - 1)
    # least and greatest skip NULLs, so both dates are asked for.
    return F.when(start.isNotNull() & end.isNotNull(), (weekdays - 1).cast("int"))
