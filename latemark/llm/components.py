"""Connected components of an edge table by alternating stars, in joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import forget, kept, split_join


def _to_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """Neighbours ``b`` of each ``a`` beside the least ``m``; hubs, told by their ``n``, by broadcast."""
    return split_join(rows, least, "a", "n").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _round(edges: DataFrame) -> DataFrame:
    """A large star and a small star of kept ``edges`` with a > b; leaves nothing but its result."""
    # large: every node hands its greater neighbours to the least of all its neighbours
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = kept(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count_if(F.expr("b > a")).alias("n")), "least"
    )
    large = kept(_to_least(both.filter("b > a"), nearest).filter("a > b").distinct(), "large")
    # small: every node hands its smaller neighbours to the least of them
    least = kept(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    handed = _to_least(large, least).union(least.select("a", F.col("m").alias("b")))
    stars = kept(handed.filter("a > b").distinct(), "stars")
    forget(nearest, large, least)
    return stars


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that has an edge and is not the least of its component, and that least.

    ``edges`` are pairs (a, b) of longs in any direction, repeats and loops allowed. The
    number of rounds grows with the logarithm of the longest path.
    """
    seen = None
    now = kept(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return now
        seen, before = state, now
        now = _round(before)
        forget(before)
