"""Published results. Paths may be any URI Spark can write to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The names of what a run leaves below its output folder.
def _under(base: str, mode: str, name: str) -> str:
    return f"{base.rstrip('/')}/{mode}_{name}"


def write_metrics(document: DataFrame, base: str, mode: str) -> str:
    """One-row metrics document as a single text file. Returns the folder written."""
    target = _under(base, mode, "metrics_json")
    text = document.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(target)  # one row
    return target


def read_metrics(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """Documents of one or more runs, read with a schema instead of guessed."""
    return spark.read.schema(schema).json([paths] if isinstance(paths, str) else list(paths))


def write_confusion(confusion: DataFrame, base: str, mode: str) -> str:
    target = _under(base, mode, "confusion_csv")
    ordered = confusion.select("label", "prediction", "count").orderBy("label", "prediction")
    # at most four rows
    ordered.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
    return target


def write_table(table: DataFrame, base: str, mode: str, name: str) -> str:
    """A small result table (report, importances, curve) as one CSV file with a header."""
    target = _under(base, mode, f"{name}_csv")
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
    return target


def write_predictions(scored: DataFrame, base: str, mode: str) -> str:
    target = _under(base, mode, "test_predictions_parquet")
    (
        scored.select(
            F.col("label").cast("int").alias("label"),
            F.col("prediction").cast("int").alias("prediction"),
            F.col("probability").cast("double").alias("probability"),
        ).write.mode("overwrite").parquet(target)
    )
    return target


def write_sample(sample: DataFrame, path: str, label: str, fmt: str = "parquet") -> None:
    """Feature sample for later training: Parquet by label, or CSV with a header."""
    if fmt == "csv":
        sample.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "parquet":
        sample.write.mode("overwrite").partitionBy(label).parquet(path)
    else:
        raise ValueError(f"unknown sample format {fmt!r}")


def read_sample(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Read a sample back with the types and column order it was written with."""
    if fmt == "csv":
        return spark.read.option("header", True).schema(like.schema).csv(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def save_model(model: PipelineModel, base: str, mode: str) -> str:
    target = _under(base, mode, "pipeline_model")
    model.write().overwrite().save(target)
    return target


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
