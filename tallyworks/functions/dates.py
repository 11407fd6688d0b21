"""Month arithmetic. An explicit as-of date stands in for the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def month_end(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def previous_month_end(day: dt.date) -> dt.date:
    """Also right in January, where ``month - 1`` would be zero."""
    return month_start(day) - dt.timedelta(days=1)


def months_before(day: dt.date, months: int) -> dt.date:
    """End of the month ``months`` before the month of ``day``."""
    for _ in range(months):
        day = previous_month_end(day)
    return month_end(day)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month changes from ``start`` to ``end``: 28 Feb to 1 Mar is one."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def month_end_before(day: Column, months: int) -> Column:
    return F.last_day(F.add_months(day, -months))


def long_date(day: Column) -> Column:
    """``15 Aug 2001``."""
    return F.date_format(day, "dd MMM yyyy")
