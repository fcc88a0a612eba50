"""Missing value → median of its group in the training rows."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.features.tables import ROWS, LookupTable, TableModel
from latemark.operators.lookup import row_bytes
from latemark.operators.medians import exact_medians
from latemark.session import checkpointed


class _HasKeyCol(Params):
    keyCol = Param(Params._dummy(), "keyCol", "grouping column", TypeConverters.toString)

    def getKeyCol(self) -> str:
        return self.getOrDefault(self.keyCol)


class GroupMedianImputerModel(TableModel, HasInputCols, HasOutputCols, _HasKeyCol):
    """Own value, else the group median, else the overall median."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs, outputs = self.getInputCols(), self.getOutputCols()
        filled = {
            out: F.coalesce(F.col(col), F.col(f"{col}_median"), F.lit(self.scalars[col]))
            for col, out in zip(inputs, outputs)
        }
        return self._joined(dataset).withColumns(filled).drop(*[f"{c}_median" for c in inputs])


def _sketched(df: DataFrame, key: str, columns: list[str], accuracy: int) -> DataFrame:
    """The shape of ``exact_medians`` from mergeable sketches, grouping sets in one pass."""
    return df.groupingSets([[F.col(key)], []], F.col(key)).agg(
        F.grouping_id().alias("_overall"),
        F.count(F.lit(1)).alias(ROWS),
        *[F.percentile_approx(c, 0.5, accuracy).alias(f"{c}_median") for c in columns],
    )


class GroupMedianImputer(
    Estimator, HasInputCols, HasOutputCols, _HasKeyCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Group and overall medians from one scan of the rows, exact unless ``accuracy`` is above 0."""

    accuracy = Param(
        Params._dummy(), "accuracy", "0: exact medians, else sketches with rank error 1 / accuracy", TypeConverters.toInt
    )

    def __init__(
        self,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        keyCol: str = "route",
        accuracy: int = 0,
    ):
        super().__init__()
        self._set(keyCol=keyCol, accuracy=accuracy)
        if inputCols:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}_clean" for c in inputCols])

    def _fit(self, dataset: DataFrame) -> GroupMedianImputerModel:
        key, inputs = self.getKeyCol(), self.getInputCols()
        medians = [f"{c}_median" for c in inputs]
        accuracy = self.getOrDefault(self.accuracy)
        combined = checkpointed(
            _sketched(dataset, key, inputs, accuracy) if accuracy else exact_medians(dataset, key, inputs)
        )
        size = combined.filter(F.col("_overall") == 0).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(combined, combined.columns)), F.lit(0)).alias("bytes")
        ).first()
        overall = combined.filter(F.col("_overall") == 1).first()
        frame = combined.filter((F.col("_overall") == 0) & F.col(key).isNotNull()).select(key, ROWS, *medians)
        lookup = LookupTable(frame, key, medians, size["n"], overall[ROWS], size["bytes"])
        scalars = {c: overall[m] for c, m in zip(inputs, medians)}
        model = GroupMedianImputerModel()._fitted({key: lookup}, scalars)
        return self._copyValues(model)
