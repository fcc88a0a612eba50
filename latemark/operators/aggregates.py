"""Counts, rates, medians and column statistics.

All of them aggregate before they shuffle, so one key holding a third of the rows sends
no more than one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.operators.medians import exact_medians

_SET_ID = "_grouping"


class KeyedTables:
    """Aggregates over several single-column keys, computed from one scan.

    ``combined`` has one row per key value of every key; ``table(key)`` cuts out the
    rows of one key with the key in its own type.
    """

    def __init__(self, combined: DataFrame, keys: Sequence[str], values: Sequence[str]):
        self.combined = combined
        self.keys = list(keys)
        self.values = list(values)

    def _set_id(self, key: str) -> int:
        place = len(self.keys) - 1 - self.keys.index(key)
        return ((1 << len(self.keys)) - 1) ^ (1 << place)

    def table(self, key: str) -> DataFrame:
        return self.combined.filter(F.col(_SET_ID) == self._set_id(key)).select(key, *self.values)

    def long(self, key_name: str, value_name: str) -> DataFrame:
        """All tables under each other; key values as strings."""
        name = F.lit(None).cast("string")
        value = F.lit(None).cast("string")
        for key in self.keys:
            here = F.col(_SET_ID) == self._set_id(key)
            name = F.when(here, F.lit(key)).otherwise(name)
            value = F.when(here, F.col(key).cast("string")).otherwise(value)
        return self.combined.select(name.alias(key_name), value.alias(value_name), *self.values)


def keyed_aggregates(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> KeyedTables:
    """Aggregate by each key on its own, reading ``df`` once (grouping sets)."""
    if len(set(keys)) != len(keys):
        raise ValueError(f"repeated keys: {list(keys)}")
    sets = [[F.col(k)] for k in keys]
    combined = df.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias(_SET_ID),
        *[expression.alias(name) for name, expression in aggregates.items()],
    )
    return KeyedTables(combined, keys, list(aggregates))


def category_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(feature, category, rows) for every value of every key."""
    return keyed_aggregates(df, keys, rows=F.count(F.lit(1))).long("feature", "category")


def delay_rates(df: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, category, rate, rows): mean label for every value of every key."""
    tables = keyed_aggregates(df, keys, rate=F.avg(label), rows=F.count(F.lit(1)))
    return tables.long("feature", "category")


def group_medians(
    df: DataFrame, key: str, columns: Sequence[str], accuracy: int | None = None
) -> DataFrame:
    """Lower median of each column per key: the smallest value with half the rows at or below.

    Exact by default, see :func:`latemark.operators.medians.exact_medians`. An ``accuracy`` asks
    for sketches with rank error 1/accuracy instead, in one pass.
    """
    if accuracy is None:
        medians = exact_medians(df, key, columns).filter(F.col("_overall") == 0)
        return medians.select(key, *[f"{c}_median" for c in columns])
    return df.groupBy(key).agg(*[
        F.percentile_approx(c, 0.5, accuracy).alias(f"{c}_median") for c in columns
    ])


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, std) from one pass; std is the sample deviation, null for one row."""
    wide = df.agg(*[
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c)
        for c in columns
    ])
    return wide.select(F.inline(F.array(*[F.col(c) for c in columns])))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percent of every label, ordered. The total comes from the counts, not a new scan."""
    counts = label_counts(df, label)
    total = F.sum("count").over(Window.partitionBy())  # over one row per label value
    return counts.select(
        label, "count", (F.lit(100.0) * F.col("count") / total).alias("percent")
    ).orderBy(label)


def split_summary(parts: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """Rows and late rows of every part of a split, in one job."""
    tagged = [
        part.select(F.lit(name).alias("part"), F.col(label).alias("_label"))
        for name, part in parts.items()
    ]
    return reduce(DataFrame.unionAll, tagged).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_label") == 1).alias("late_rows"),
    )


def distinct_years(df: DataFrame, year: str = "year") -> DataFrame:
    return df.select(year).distinct().orderBy(year)
