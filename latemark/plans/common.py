"""Steps the jobs share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from latemark.evaluation import METRIC_NAMES, binary_metrics, confusion_matrix, ranking_metrics
from latemark.operators import clean_legs, cleaning_report
from latemark.plans.config import _Config
from latemark.sources import malformed_entries, read_legs, write_confusion, write_metrics, write_predictions


def load(spark: SparkSession, config: _Config, columns: tuple[str, ...]) -> DataFrame:
    if not config.input:
        raise ValueError("either an input path or a frame of legs is needed")
    return read_legs(spark, config.input, columns=columns)


def cleaned_legs(spark: SparkSession, config, legs: DataFrame | None) -> DataFrame:
    """Cleaned rows of the input; lazy, callers stage them before passing over them again."""
    roles = config.roles
    raw = load(spark, config, roles.required) if legs is None else legs
    return clean_legs(raw, roles, config.start_year, config.periods, config.threshold)


def accounting(spark: SparkSession, config, legs: DataFrame | None) -> DataFrame:
    """Where the rows of the input went, as one lazy row."""
    roles = config.roles
    raw = load(spark, config, roles.required) if legs is None else legs
    return cleaning_report(raw, roles, config.start_year, config.periods)


def malformed(spark: SparkSession, config: _Config) -> DataFrame | None:
    return malformed_entries(spark, config.input, config.roles.required) if config.input else None


def scores_only(scored: DataFrame, label: str = "label") -> DataFrame:
    """The three columns metrics need, so that only they are kept."""
    return scored.select(
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
        F.col("probability").cast("double").alias("probability"),
    )


def measured(scores: DataFrame) -> tuple[dict, list[tuple[int, int, int]]]:
    """All metrics of the document and the confusion rows, from two aggregations."""
    counts: Row = binary_metrics(scores).first()
    ranks: Row = ranking_metrics(scores).first()
    found = {**counts.asDict(), **ranks.asDict()}
    confusion = [
        (actual, said, found[name])
        for actual, said, name in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        if found[name]
    ]
    if not confusion:
        raise ValueError("no test rows to measure")
    return {name: found[name] for name in METRIC_NAMES}, confusion


def publish(config: _Config, mode: str, document: DataFrame, scores: DataFrame) -> dict[str, str]:
    if not config.output:
        return {}
    written = {
        "metrics": write_metrics(document, config.output, mode),
        "confusion": write_confusion(confusion_matrix(scores), config.output, mode),
    }
    if config.save_predictions:
        written["predictions"] = write_predictions(scores, config.output, mode)
    return written
