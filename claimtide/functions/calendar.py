"""Report-week and calendar-period functions.

Report weeks run Sunday to Saturday; week 1 of a report year is the first
week that holds a Thursday, and the Thursday of a week decides its year.
Shifting a date by one day turns its Sunday-start week into the Monday-start
ISO week that shares the same Thursday, so report year/week are the ISO
week-year and week number of ``d + 1`` (checked over every day 1900-2100 in
``tests/test_calendar.py``).  Everything stays a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report_week_thursday(d: Column | str) -> Column:
    """The Thursday of the Sunday-start week holding ``d``."""
    d = _col(d)
    return F.date_add(d, F.lit(5) - F.dayofweek(d))


def report_year(d: Column | str) -> Column:
    """Report year of ``d`` as a long (null for null)."""
    shifted = F.date_add(_col(d), 1)
    return F.extract(F.lit("YEAROFWEEK"), shifted).cast("long")


def report_week(d: Column | str) -> Column:
    """Report week number 1-53 of ``d`` as a long (null for null)."""
    return F.weekofyear(F.date_add(_col(d), 1)).cast("long")


def week_start(d: Column | str) -> Column:
    """Sunday that starts the report week of ``d``."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(d: Column | str) -> Column:
    """Saturday that ends the report week of ``d``."""
    return F.date_add(week_start(d), 6)


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "month")


def month_end(d: Column | str) -> Column:
    return F.last_day(_col(d))


def metric_year(d: Column | str) -> Column:
    return F.year(_col(d)).cast("long")


def metric_month(d: Column | str) -> Column:
    return F.month(_col(d)).cast("long")
