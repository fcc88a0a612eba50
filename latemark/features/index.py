"""Category → its place among the categories of the training rows, commonest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latemark.features.tables import ROWS, LookupTable, TableModel
from latemark.operators.aggregates import category_counts
from latemark.operators.lookup import row_bytes
from latemark.session import checkpointed

#: ``monotonically_increasing_id`` has the task above these bits and the row in the task below
_ROW_BITS = 33


def ranked_labels(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(feature, category, rows, place): places from 0 per feature, by falling count, then category.

    All features are counted in one scan. Places come from a sort by ranges: a task knows the
    place of a category among its own, and the counts of tasks before, one row per task and
    feature, give the rest. No table of categories passes through one task or the driver.
    """
    counts = category_counts(df, keys).filter(F.col("category").isNotNull())
    order = [F.col("feature"), F.col("rows").desc(), F.col("category")]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that places read again are those of the sort
    sorted_once = checkpointed(
        counts.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    task = F.shiftright("_at", _ROW_BITS)
    parts = sorted_once.groupBy("feature", task.alias("_task")).agg(
        F.count(F.lit(1)).alias("_in"), F.min("_at").alias("_first")
    )
    before = Window.partitionBy("feature").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("feature").alias("_feature"), "_task", "_first", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
    )
    # at most keys x tasks rows
    placed = sorted_once.withColumn("_in_task", task).join(
        F.broadcast(starts), (F.col("feature") == F.col("_feature")) & (F.col("_in_task") == F.col("_task"))
    )
    return placed.select("feature", "category", "rows", (F.col("_before") + F.col("_at") - F.col("_first")).alias("place"))


class RankedIndexerModel(TableModel, HasInputCols, HasOutputCols):
    """Adds the place of each category as a double; categories never seen and nulls come after the last.

    The output column says how many places there are, so one-hot encoding needs no pass to find out.
    """

    def _transform(self, dataset: DataFrame) -> DataFrame:
        named = dict(zip(self.getInputCols(), self.getOutputCols()))
        joined = self._joined(dataset)
        for key, output in named.items():
            known = self.lookups[key].table_rows
            place = F.coalesce(F.col(output), F.lit(float(known)))
            nominal = {"ml_attr": {"name": output, "type": "nominal", "num_vals": known + 1}}
            joined = joined.withColumn(output, place).withMetadata(output, nominal)
        return joined.select(*dataset.columns, *named.values())


class RankedIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Places of the categories of all columns, as lookup tables that never reach the driver."""

    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        if inputCols:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}_index" for c in inputCols])

    def _fit(self, dataset: DataFrame) -> RankedIndexerModel:
        named = dict(zip(self.getInputCols(), self.getOutputCols()))
        ranked = checkpointed(ranked_labels(dataset, list(named)))
        sizes = {
            r["feature"]: r for r in ranked.groupBy("feature")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(ROWS).alias(ROWS), F.sum(row_bytes(ranked, ranked.columns)).alias("bytes"))
            .collect()  # one row per key
        }
        lookups = {}
        for key, output in named.items():
            frame = ranked.filter(F.col("feature") == key).select(
                F.col("category").cast(dataset.schema[key].dataType).alias(key), ROWS,
                F.col("place").cast("double").alias(output),
            )
            size = sizes.get(key)
            lookups[key] = LookupTable(
                frame, key, [output], *((size["n"], size[ROWS], size["bytes"]) if size else (0, 0, 0))
            )
        return self._copyValues(RankedIndexerModel()._fitted(lookups, {}))
