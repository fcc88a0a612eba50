"""Calendar and route expressions. Every one stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First hour of the day periods 1, 2, 3 and 4 (0 starts at midnight).
PERIOD_STARTS = (6, 12, 17, 21)

# Months of seasons 0, 1 and 2; every other month, and null, is 3.
SEASON_MONTHS = ((12, 1, 2), (3, 4, 5), (6, 7, 8))

# Saturday and Sunday when Monday is 1.
WEEKEND_DAYS = (6, 7)


def departure_hour(hhmm: Column) -> Column:
    """Hour of a clock time written as the integer hhmm; 2400 gives 24, null stays null."""
    return (hhmm / 100).cast("int")


def day_period(hour: Column) -> Column:
    """Number of the period an hour falls in; an unknown hour counts as the last one."""
    reached = [F.when(hour >= start, 1).otherwise(0) for start in PERIOD_STARTS]
    period = reached[0]
    for step in reached[1:]:
        period = period + step
    return F.when(hour.isNull(), F.lit(len(PERIOD_STARTS))).otherwise(period)


def weekend_flag(day_of_week: Column) -> Column:
    return F.coalesce(day_of_week.isin(*WEEKEND_DAYS).cast("int"), F.lit(0))


def season(month: Column) -> Column:
    number = F.lit(len(SEASON_MONTHS))
    for index, months in reversed(list(enumerate(SEASON_MONTHS))):
        number = F.when(month.isin(*months), F.lit(index)).otherwise(number)
    return number


def route_key(origin: Column, destination: Column) -> Column:
    """``origin-destination``; a missing end is left out, two missing ends give ''."""
    return F.concat_ws("-", origin.cast("string"), destination.cast("string"))
