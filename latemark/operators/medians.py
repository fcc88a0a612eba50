"""Exact medians of groups and of all rows, by counts and ranks instead of sketches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latemark.operators.buckets import ordered_buckets
from latemark.session import checkpointed

#: Groups of up to this many distinct values are ranked whole, each in one task.
WHOLE_GROUP = 100_000


def exact_medians(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, _overall, rows, <column>_median…): one row per key and one for all rows.

    The median is the lower one: the smallest value with half the values at or below. Nulls
    and NaN have no part in it; a group with nothing else has a null. Numbers are compared as
    doubles and returned in the type of their column.

    1. Rows are counted per key, column and value, which adds up before it shuffles; the
       counts are written once, and those of all rows come from them.
    2. If no group has many distinct values, the values of each are ranked, in one shuffle.
    3. Else values fall into ordered buckets. The counts of the buckets of a group, at most a
       million short rows, tell which bucket holds its median, and only that bucket's values
       are ranked. So a group with a third of the rows has a small part of them in a task.
    """
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("place"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
        for i, c in enumerate(columns)
    ]))
    counts = checkpointed(
        df.select(F.col(key).alias("_key"), entries.alias("e"))
        # -0.0 and 0.0 are one value
        .groupBy("_key", F.col("e.place").alias("_place"), (F.col("e.value") + F.lit(0.0)).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    no_key = F.lit(None).cast(df.schema[key].dataType).alias("_key")
    present = counts.filter(F.col("_value").isNotNull())
    together = present.groupBy("_place", "_value").agg(F.sum("_n").alias("_n"))
    every = present.select(F.lit(0).alias("_overall"), *counts.columns).unionByName(
        together.select(F.lit(1).alias("_overall"), no_key, "_place", "_value", "_n")
    )
    group = ["_overall", "_key", "_place"]
    widest = every.groupBy(*group).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if widest <= WHOLE_GROUP:
        found = _crossing(every.withColumns({"_before": F.lit(0), "_all": F.sum("_n").over(Window.partitionBy(*group))}), group, group)
    else:
        placed = ordered_buckets(every, "_value")
        found = _holding_the_middle(placed, group, _middle_buckets(placed, group))

    in_all = counts.filter(F.col("_place") == 0)
    sizes = in_all.groupBy("_key").agg(F.sum("_n").alias("rows")).select(F.lit(0).alias("_overall"), "_key", "rows")
    size = in_all.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).select(F.lit(1).alias("_overall"), no_key, "rows")
    nothing = [F.lit(None).cast("int").alias("_place"), F.lit(None).cast("double").alias("_value")]
    lines = sizes.unionByName(size).select("_overall", "_key", "rows", *nothing).unionByName(
        found.select("_overall", "_key", F.lit(0).cast("bigint").alias("rows"), "_place", "_value")
    )
    return lines.groupBy("_overall", "_key").agg(
        F.sum("rows").alias("rows"),
        *[
            F.max(F.when(F.col("_place") == i, F.col("_value"))).cast(df.schema[c].dataType).alias(f"{c}_median")
            for i, c in enumerate(columns)
        ],
    ).withColumnRenamed("_key", key)


def _middle_buckets(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """The bucket of each group that holds its median, with the rows before it and in all."""
    totals = placed.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_in"))
    each = Window.partitionBy(*group)
    upto = each.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    running = totals.withColumns({"_upto": F.sum("_in").over(upto), "_all": F.sum("_in").over(each)})
    middle = (F.col("_upto") * 2 >= F.col("_all")) & ((F.col("_upto") - F.col("_in")) * 2 < F.col("_all"))
    return running.filter(middle).select(
        *[F.col(c).alias(f"{c}_of") for c in (*group, "_bucket")],
        (F.col("_upto") - F.col("_in")).alias("_before"), "_all",
    )


def _holding_the_middle(placed: DataFrame, group: Sequence[str], middle: DataFrame) -> DataFrame:
    """The median value of each group, from the values of its middle bucket."""
    keys = [*group, "_bucket"]
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"{c}_of")), keys[1:], F.col(keys[0]) == F.col(f"{keys[0]}_of"))
    return _crossing(placed.join(middle, same), group, keys)


def _crossing(values: DataFrame, group: Sequence[str], ranked_in: Sequence[str]) -> DataFrame:
    """The value at which the running count, from ``_before`` on, reaches half of ``_all``."""
    within = Window.partitionBy(*ranked_in).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
    crosses = (F.col("_upto") * 2 >= F.col("_all")) & ((F.col("_upto") - F.col("_n")) * 2 < F.col("_all"))
    return ranked.filter(crosses).select(*group, "_value")
