"""Buckets in the order of a number, about equally full, cut from a hash sample."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: quantile intervals taken from the sample, and the distinct scores that it has, about
INTERVALS = 1024
SAMPLE = 1 << 16

#: each interval is cut further into equal widths once it would hold more scores than this
ROWS_PER_BUCKET = 1_000_000

#: upper bound of those further cuts; with INTERVALS it bounds the table of bucket totals
MAX_CUTS = 1024


def ordered_buckets(rows: DataFrame, score: str) -> DataFrame:
    """Add ``_bucket``, non-decreasing in the score.

    Rows of one score are counted together before buckets are summed, so even buckets are
    those of equally many distinct scores. What tasks send for the cuts is a fixed-size
    counter and their part of the sample.
    """
    distinct = rows.agg(F.approx_count_distinct(score)).first()[0]
    if not distinct:
        return rows.withColumn("_bucket", F.lit(0).cast("bigint"))
    every = max(1, distinct // SAMPLE)
    drawn = rows.filter(F.pmod(F.xxhash64(score), F.lit(every)) == 0).select(score).distinct()
    drawn = sorted(r[0] for r in drawn.collect())
    edges = sorted({drawn[(len(drawn) - 1) * i // INTERVALS] for i in range(INTERVALS + 1)}) if drawn else [0.0]
    # few scores need few buckets, yet enough to keep all cores busy
    wanted = min(INTERVALS, max(16, math.ceil(distinct / ROWS_PER_BUCKET)))
    inner = edges[1:-1][:: max(1, len(edges) // wanted)] or edges[:1]
    splits = [-math.inf, *inner, math.inf]
    placed = Bucketizer(splits=splits, inputCol=score, outputCol="_interval").transform(rows)
    interval = F.col("_interval").cast("int")

    cuts = min(MAX_CUTS, math.ceil(distinct / (len(splits) - 1) / ROWS_PER_BUCKET))
    if cuts == 1:
        return placed.withColumn("_bucket", interval.cast("bigint")).drop("_interval")
    bounds = F.array(*[F.lit(e) for e in [edges[0], *inner, edges[-1]]])
    low, high = F.get(bounds, interval), F.get(bounds, interval + 1)
    inside = F.try_divide(F.col(score) - low, high - low) * cuts
    step = F.least(F.greatest(F.floor(F.coalesce(inside, F.lit(0.0))), F.lit(0)), F.lit(cuts - 1))
    return placed.withColumn("_bucket", interval.cast("bigint") * cuts + step).drop("_interval")
