"""Entries of feature vectors without writing out their zeros.

``vector_to_array`` makes an array as long as a vector is wide, so a row costs as much as there
are categories. What is taken here comes from the stored entries alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_width(vector: str) -> Column:
    """Number of slots."""
    inner = F.unwrap_udt(F.col(vector))
    return F.coalesce(inner["size"], F.size(inner["values"]))


def vector_slot(vector: str, place: Column) -> Column:
    """The entry at a place, from 0; null beyond the last."""
    inner = F.unwrap_udt(F.col(vector))
    at = F.array_position(inner["indices"], place.cast("int")).cast("int")
    stored = F.coalesce(F.when(at > 0, F.get(inner["values"], at - 1)), F.lit(0.0))
    inside = (place >= 0) & (place < vector_width(vector))
    return F.when(inside, F.when(inner["indices"].isNull(), F.get(inner["values"], place)).otherwise(stored))


def vector_sum(vector: str, slots: Column) -> Column:
    """Sum of the first ``slots`` entries."""
    inner = F.unwrap_udt(F.col(vector))
    own = F.zip_with(inner["indices"], inner["values"], lambda i, x: F.when(i < slots, x).otherwise(F.lit(0.0)))
    entries = F.when(inner["indices"].isNull(), F.slice(inner["values"], 1, slots)).otherwise(own)
    return F.aggregate(entries, F.lit(0.0), lambda a, b: a + b)


def hot_slot(vector: str) -> Column:
    """Place of the first 1, from 0; -1 where there is none."""
    inner = F.unwrap_udt(F.col(vector))
    at = F.array_position(inner["values"], 1.0)
    stored = F.get(inner["indices"], (at - 1).cast("int")).cast("bigint")
    return F.when(at > 0, F.when(inner["indices"].isNull(), at - 1).otherwise(stored)).otherwise(F.lit(-1).cast("bigint"))
