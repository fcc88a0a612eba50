"""Centre and scale by training mean and sample deviation."""

from __future__ import annotations

import math

from pyspark.ml import Estimator
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.features.tables import TableModel
from latemark.operators.aggregates import feature_stats


def _usable(value: float | None) -> bool:
    return value is not None and not math.isnan(value)


class ZScoreModel(TableModel, HasInputCols):
    """Replaces each column by (value - mean) / deviation; one projection, no join."""

    @property
    def parameters(self) -> dict[str, tuple[float, float]]:
        return {c: tuple(self.scalars[c]) for c in self.getInputCols()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            c: (F.col(c) - F.lit(mean)) / F.lit(scale)
            for c, (mean, scale) in self.parameters.items()
        })


class ZScore(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A column without a mean is centred at 0; one without spread is divided by 1."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols:
            self._set(inputCols=inputCols)

    def _fit(self, dataset: DataFrame) -> ZScoreModel:
        scalars = {}
        for row in feature_stats(dataset, self.getInputCols()).collect():  # one row per column
            mean = row["mean"] if _usable(row["mean"]) else 0.0
            scale = row["std"] if _usable(row["std"]) and row["std"] != 0.0 else 1.0
            scalars[row["feature"]] = [mean, scale]
        return self._copyValues(ZScoreModel()._fitted({}, scalars))
