"""Metrics of 0/1 predictions. Each function is one aggregation to a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count), ordered; pairs that never occur are absent."""
    return (
        scored.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("label", "prediction")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _of_class(hits: str, false_hits: str, misses: str) -> tuple[Column, Column, Column]:
    precision = _ratio(F.col(hits), F.col(hits) + F.col(false_hits))
    recall = _ratio(F.col(hits), F.col(hits) + F.col(misses))
    return precision, recall, _ratio(2 * precision * recall, precision + recall)


def binary_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the four counts, accuracy, and per-class and support-weighted scores."""
    actual, said = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = scored.agg(
        F.count_if((actual == 1) & (said == 1)).alias("tp"),
        F.count_if((actual == 0) & (said == 1)).alias("fp"),
        F.count_if((actual == 0) & (said == 0)).alias("tn"),
        F.count_if((actual == 1) & (said == 0)).alias("fn"),
    )
    pieces = {
        "1": _of_class("tp", "fp", "fn"),
        "0": _of_class("tn", "fn", "fp"),
    }
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    total = positives + negatives
    names = ("precision", "recall", "f1")
    per_class = [
        value.alias(f"{name}_{cls}") for cls, values in pieces.items() for name, value in zip(names, values)
    ]
    weighted = [
        _ratio(of_1 * positives + of_0 * negatives, total).alias(name)
        for name, of_1, of_0 in zip(
            ("weighted_precision", "weighted_recall", "f1"), pieces["1"], pieces["0"]
        )
    ]
    accuracy = _ratio(F.col("tp") + F.col("tn"), total).alias("accuracy")
    return counts.select("tp", "fp", "tn", "fn", accuracy, *per_class, *weighted)


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long table: a row per class, accuracy, and macro and weighted averages.

    Columns ``name, precision, recall, f1, support``; the accuracy row carries its value
    in all three score columns.
    """
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.alias("support"),
        )

    def of(cls: str) -> list[Column]:
        return [F.col(f"{n}_{cls}") for n in ("precision", "recall", "f1")]

    macro = [(a + b) / 2 for a, b in zip(of("0"), of("1"))]
    lines = F.array(
        line("0", *of("0"), F.col("tn") + F.col("fp")),
        line("1", *of("1"), F.col("tp") + F.col("fn")),
        line("accuracy", *[F.col("accuracy")] * 3, total),
        line("macro avg", *macro, total),
        line("weighted avg", *[F.col(c) for c in ("weighted_precision", "weighted_recall", "f1")], total),
    )
    return binary_metrics(scored, label, prediction).select(F.inline(lines))
