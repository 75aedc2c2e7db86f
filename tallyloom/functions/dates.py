"""Date differences that count calendar boundaries, as DATEDIFF(unit, a, b) does.

Spark's own ``timestampdiff(MONTH, …)`` counts complete months (31 January to
1 February is 0); a boundary count gives 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_diff(start: Column, end: Column) -> Column:
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def year_diff(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def day_diff(start: Column, end: Column) -> Column:
    return F.date_diff(F.to_date(end), F.to_date(start))


def minute_diff(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def second_diff(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def month_of(c) -> Column:
    return F.trunc(c, "month")


def day(literal: str) -> Column:
    """A date literal; passing the report date explicitly keeps plans foldable and runs repeatable."""
    return F.lit(literal).cast("date")


def days_before(as_of: str, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def months_before(as_of: str, n: int) -> Column:
    return F.add_months(day(as_of), -n)
