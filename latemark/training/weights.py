"""Weight of the rare class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.operators.aggregates import label_counts


def positive_weight(negatives: int, positives: int) -> float:
    if not negatives or not positives:
        raise ValueError(f"both classes are needed, got {negatives} negative and {positives} positive rows")
    return negatives / positives


def class_weight(df: DataFrame, label: str = "label") -> float:
    """Negatives per positive in ``df``: pass training rows, or all rows for the wider scope."""
    found = {row[label]: row["count"] for row in label_counts(df, label).filter(F.col(label).isin(0, 1)).collect()}
    return positive_weight(found.get(0, 0), found.get(1, 0))
