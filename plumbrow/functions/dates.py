"""Date and time expressions for zone-less clock times.

A year here runs from 1 April of the year before to 31 March and is named after its end. Time
differences count clock boundaries crossed, so 23:00 to 01:00 is one day and 0.9 s to 1.1 s is one
second. Only field extraction and date arithmetic are used, so no session time zone plays a part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    # Of a zone-less time this is the number of whole seconds on the clock, in any session zone.
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def clock_text(at: Column) -> Column:
    """The time to the second, as on the clock. Formatting would go through the session's zone."""
    return F.substring(at.cast("string"), 1, 19)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def disclosure_year(at: Column) -> Column:
    return F.year(at) + F.when(F.month(at) >= 4, 1).otherwise(0)


def swapped_disclosure_year(at: Column) -> Column:
    """The year the date would fall in with day and month swapped; NULL when that is no date."""
    return F.when(
        F.dayofmonth(at) <= 12, F.year(at) + F.when(F.dayofmonth(at) >= 4, 1).otherwise(0)
    )


def days_outside_year(at: Column, year: Column) -> Column:
    """Days the date lies outside the year, 0 when inside."""
    dated = F.when(year.between(1, 9999), year)
    first_day = F.make_date(dated - 1, F.lit(4), F.lit(1))
    last_day = F.make_date(dated, F.lit(3), F.lit(31))
    return F.greatest(days_between(at, first_day), days_between(last_day, at), F.lit(0))
