"""The metrics document of a run, and tables comparing runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a metrics document, in the order they are written.
DOCUMENT_FIELDS: dict[str, str] = {
    "model": "string",
    "optimizer": "string",
    "encoding": "string",
    "split": "string",
    "mode": "string",
    "input": "string",
    "start_year": "int",
    "max_iter": "int",
    "learning_rate": "double",
    "train_ratio": "double",
    "seed": "bigint",
    "test_year_start": "int",
    "train_rows": "bigint",
    "validation_rows": "bigint",
    "test_rows": "bigint",
    "exclude_covid": "boolean",
    "positive_weight": "double",
    "weights": "map<string,double>",
    "categorical_cols": "array<string>",
    "numerical_cols": "array<string>",
    "feature_cols": "array<string>",
    "auc": "double",
    "auc_desc_rank": "double",
    "average_precision": "double",
    "accuracy": "double",
    "f1": "double",
    "weighted_precision": "double",
    "weighted_recall": "double",
    "confusion": "array<struct<label:int,prediction:int,count:bigint>>",
}

METRIC_NAMES = (
    "auc", "auc_desc_rank", "average_precision", "accuracy", "f1", "weighted_precision",
    "weighted_recall",
)

DOCUMENT_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in DOCUMENT_FIELDS.items())


def _plain(value: object, kind: str) -> object:
    """A field as ``createDataFrame`` takes it for its declared type."""
    if isinstance(value, dict):
        return [(name, float(number)) for name, number in value.items()]
    if isinstance(value, (list, tuple)):
        return list(value)
    if value is not None and kind == "double":
        return float(value)
    return value


def metrics_document(spark: SparkSession, **fields: object) -> DataFrame:
    """One row with every field of :data:`DOCUMENT_FIELDS`; those not given are null.

    ``weights`` is a dict in the order to write, bias first; ``confusion`` a list of
    (label, prediction, count).
    """
    unknown = set(fields) - set(DOCUMENT_FIELDS)
    if unknown:
        raise ValueError(f"not part of a metrics document: {', '.join(sorted(unknown))}")
    row = tuple(_plain(fields.get(name), kind) for name, kind in DOCUMENT_FIELDS.items())
    # a map handed over as one would lose its order
    listed = DOCUMENT_SCHEMA.replace("map<string,double>", "array<struct<key:string,value:double>>")
    return spark.createDataFrame([row], listed).withColumn("weights", F.map_from_entries("weights"))


def compare_models(documents: DataFrame | Sequence[DataFrame], baseline_auc: float | None = None) -> DataFrame:
    """One row per run: how it was made, its auc, and the gain over ``baseline_auc``."""
    if not isinstance(documents, DataFrame):
        first, *others = documents
        documents = first
        for other in others:
            documents = documents.unionByName(other)
    base = F.lit(baseline_auc).cast("double")
    return documents.select(
        "model", "mode", "optimizer", "encoding", "split", F.col("max_iter").alias("iterations"),
        "auc", (F.col("auc") - base).alias("auc_gain"),
    )
