"""Category → number of training rows it occurs in."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.features.tables import ROWS, TableModel, materialise
from latemark.operators.aggregates import keyed_aggregates


class FrequencyEncoderModel(TableModel, HasInputCols, HasOutputCols):
    """Replaces each category column by its training count; categories never seen get 0."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        outputs = self.getOutputCols()
        counted = self._joined(dataset).withColumns({
            c: F.coalesce(F.col(c), F.lit(0)) for c in outputs
        })
        return counted.drop(*self.getInputCols())


class FrequencyEncoder(
    Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable
):
    """Counts all columns in one scan of the training rows.

    Output columns are named ``<column>_freq`` unless given.
    """

    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        if inputCols:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}_freq" for c in inputCols])

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        keys, outputs = self.getInputCols(), self.getOutputCols()
        count = F.count(F.lit(1))
        tables = keyed_aggregates(dataset, keys, **{ROWS: count, "_count": count})
        lookups = materialise(tables, {k: {"_count": o} for k, o in zip(keys, outputs)})
        model = FrequencyEncoderModel()._fitted(lookups, {})
        return self._copyValues(model)
