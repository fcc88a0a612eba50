"""Cleaning, labelling and row-wise features.

Only projections and filters: nothing here moves a row to another task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latemark.functions import (
    day_period, departure_hour, in_any_period, is_known, late_label, route_key, season, weekend_flag,
)
from latemark.functions.predicates import PANDEMIC_PERIODS, Period
from latemark.roles import FLIGHTS, LegRoles


def add_label(
    df: DataFrame,
    delay: str,
    threshold: float = 15,
    inclusive: bool = True,
    keep_unknown: bool = False,
    output: str = "label",
) -> DataFrame:
    """Add the 0/1 label. Rows with an unknown delay go, or stay as 0 if ``keep_unknown``."""
    value = F.col(delay).cast("double")
    kept = df if keep_unknown else df.filter(is_known(value))
    return kept.withColumn(output, late_label(value, threshold, inclusive))


def exclude_periods(
    df: DataFrame, year: str, month: str, periods: Sequence[Period] = PANDEMIC_PERIODS
) -> DataFrame:
    return df.filter(~in_any_period(F.col(year), F.col(month), periods))


def clean_legs(
    df: DataFrame,
    roles: LegRoles = FLIGHTS,
    start_year: int = 2022,
    periods: Sequence[Period] = PANDEMIC_PERIODS,
    threshold: float = 15,
    inclusive: bool = True,
    label: str = "label",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Operated legs with a known delay, from ``start_year`` on, outside ``periods``.

    Keeps the feature columns of ``roles`` (none of them null or NaN), the ``extra``
    columns as they are, and the label.
    """
    operated = df.filter((F.col(roles.cancelled) == 0) & (F.col(roles.diverted) == 0))
    recent = operated.filter(F.col(roles.year) >= start_year)
    labelled = add_label(
        exclude_periods(recent, roles.year, roles.month, periods),
        roles.delay, threshold, inclusive, output=label,
    )
    return labelled.filter(_complete(labelled, roles.features)).select(*roles.features, *extra, label)


def _complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """No null and no NaN in any column, as separate conditions that can be pushed down."""
    def present(name: str) -> Column:
        floating = df.schema[name].dataType.typeName() in ("double", "float")
        return is_known(F.col(name)) if floating else F.col(name).isNotNull()

    return reduce(lambda a, b: a & b, map(present, columns))


def cleaning_report(
    df: DataFrame,
    roles: LegRoles = FLIGHTS,
    start_year: int = 2022,
    periods: Sequence[Period] = PANDEMIC_PERIODS,
) -> DataFrame:
    """One row of counts, from one scan: rows in, rows past each rule in turn, rows kept."""
    rules = [
        ("not_cancelled", F.col(roles.cancelled) == 0),
        ("not_diverted", F.col(roles.diverted) == 0),
        ("delay_known", is_known(F.col(roles.delay).cast("double"))),
        ("from_start_year", F.col(roles.year) >= start_year),
        ("outside_periods", ~in_any_period(F.col(roles.year), F.col(roles.month), periods)),
    ]
    rules.append(("kept_rows", _complete(df, roles.features)))

    counts = [F.count(F.lit(1)).alias("total_rows")]
    passed = F.lit(True)
    for name, rule in rules:
        passed = passed & rule
        counts.append(F.count_if(passed).alias(name))
    by_year = F.count_if(~F.coalesce(F.col(roles.year) >= start_year, F.lit(False)))
    return df.agg(*counts, by_year.alias("dropped_by_year"))


def add_class_weight(
    df: DataFrame, positive_weight: float | None, label: str = "label", output: str = "weight"
) -> DataFrame:
    """Weight of a row in training: ``positive_weight`` for label 1, else 1; None is unweighted."""
    weight = F.lit(1.0) if positive_weight is None else (
        F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    )
    return df.withColumn(output, weight)


def add_calendar_features(df: DataFrame, roles: LegRoles = FLIGHTS) -> DataFrame:
    hour = departure_hour(F.col(roles.scheduled_hhmm))
    return df.withColumns({
        "dep_hour": hour,
        "dep_period": day_period(hour),
        "is_weekend": weekend_flag(F.col(roles.day_of_week)),
        "season": season(F.col(roles.month)),
        "route": route_key(F.col(roles.origin), F.col(roles.destination)),
    })


def select_features(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """The final training columns, in the given order, label last."""
    absent = [n for n in (*names, label) if n not in df.columns]
    if absent:
        raise ValueError(f"features not present: {', '.join(absent)}")
    return df.select(*names, label)
