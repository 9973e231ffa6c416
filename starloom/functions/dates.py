"""SAS day numbers (days since 1960-01-01) and calendar columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day 0 of SAS date numbers.
SAS_EPOCH = "1960-01-01"

# The id of the "no date" row of a date dimension. It lies before year 1, so it
# never meets a real day number (-1, for one, is 1959-12-31).
MISSING_DATE_ID = -1_000_000

# The day numbers of 0001-01-01 and 9999-12-31; others have no ISO date of four-digit year.
FIRST_DAY = date.min.toordinal() - date(1960, 1, 1).toordinal()
LAST_DAY = date.max.toordinal() - date(1960, 1, 1).toordinal()

# The columns of a date dimension.
CALENDAR = {
    "day": F.dayofmonth,
    "week": F.weekofyear,
    "month": F.month,
    "year": F.year,
    "weekday": F.dayofweek,
}


def sas_day(value: Column) -> Column:
    """A SAS date number as a whole day number.

    Fractions are floored, below zero too. Null, NaN, 0 and days outside the years
    1 to 9999 mean "no date".
    """
    number = value.cast("double")
    day = F.floor(number).try_cast("int")
    return F.when((number != 0) & ~F.isnan(number) & day.between(FIRST_DAY, LAST_DAY), day)


def date_of_day(day: Column) -> Column:
    """The date of a whole day number."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), day)


def iso_date(value: Column) -> Column:
    """A SAS date number as an ISO date string."""
    return date_of_day(sas_day(value)).cast("string")


def parse_date(text: Column, fmt: str | None = None) -> Column:
    """Text as a date; text that is no date gives null."""
    return F.try_to_date(text, fmt) if fmt else F.try_to_date(text)
