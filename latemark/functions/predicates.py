"""Row predicates and the label."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Month = tuple[int, int]
Period = tuple[Month, Month]

# Months left out of every run, both ends included.
PANDEMIC_PERIODS: tuple[Period, ...] = (((2020, 3), (2022, 6)),)


def is_known(value: Column) -> Column:
    """Neither null nor NaN. Spark orders NaN above all numbers, so it must not pass."""
    return value.isNotNull() & ~F.isnan(value)


def in_any_period(year: Column, month: Column, periods: Sequence[Period]) -> Column:
    """True inside one of the ``((year, month), (year, month))`` ranges.

    Year and month stay separate so that a scan partitioned by year can prune.
    """
    def inside(period: Period) -> Column:
        (y0, m0), (y1, m1) = period
        from_start = (year > y0) | ((year == y0) & (month >= m0))
        to_end = (year < y1) | ((year == y1) & (month <= m1))
        return from_start & to_end

    return reduce(lambda a, b: a | b, map(inside, periods), F.lit(False))


def late_label(delay: Column, threshold: float = 15, inclusive: bool = True) -> Column:
    """1 when late, 0 when not or unknown; callers drop unknown delays first if asked to."""
    late = delay >= threshold if inclusive else delay > threshold
    return F.when(is_known(delay) & late, F.lit(1)).otherwise(F.lit(0))
