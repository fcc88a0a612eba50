"""Category → mean training label."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.features.tables import ROWS, TableModel, materialise
from latemark.functions.hashing import content_digest, digest_position
from latemark.operators.aggregates import keyed_aggregates


class TargetMeanEncoderModel(TableModel, HasInputCols, HasOutputCols, HasLabelCol):
    """Adds one rate column per key; unknown and null keys get the overall training mean."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        overall = self.scalars["mean"]
        return self._joined(dataset).withColumns({
            c: F.coalesce(F.col(c), F.lit(overall)) for c in self.getOutputCols()
        })


class TargetMeanEncoder(
    Estimator, HasInputCols, HasOutputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Rates of all keys from one scan. Fit it on training rows only, or labels leak."""

    def __init__(
        self,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        labelCol: str = "label",
    ):
        super().__init__()
        self._set(labelCol=labelCol)
        if inputCols:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}_delay_rate" for c in inputCols])

    def _fit(self, dataset: DataFrame) -> TargetMeanEncoderModel:
        keys, outputs, label = self.getInputCols(), self.getOutputCols(), self.getLabelCol()
        tables = keyed_aggregates(dataset, keys, **{ROWS: F.count(F.lit(1)), "_rate": F.avg(label)})
        lookups = materialise(tables, {k: {"_rate": o} for k, o in zip(keys, outputs)})
        # every key table, its null row included, covers all training rows
        first = tables.table(keys[0]).agg(
            (F.sum(F.col("_rate") * F.col(ROWS)) / F.sum(ROWS)).alias("mean")
        ).first()
        model = TargetMeanEncoderModel()._fitted(lookups, {"mean": first["mean"]})
        return self._copyValues(model)


class _HasFolds(Params):
    foldCols = Param(Params._dummy(), "foldCols", "columns whose digest gives a row its fold", TypeConverters.toListString)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)
    smoothing = Param(Params._dummy(), "smoothing", "rows that the overall mean counts for", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the folds", TypeConverters.toInt)

    def _fold(self):
        digest = content_digest(self.getOrDefault(self.foldCols), self.getOrDefault(self.seed))
        return F.pmod(digest_position(digest), F.lit(self.getOrDefault(self.folds))).cast("int")


class OutOfFoldTargetMeanModel(TableModel, HasInputCols, HasOutputCols, HasLabelCol, _HasFolds):
    """``transform`` gives new rows the smoothed rate of their key over all training rows.

    ``transform_training`` gives a training row the rate without the rows of its own fold, the
    overall mean without them included, so that no rate has seen the row's label. Unknown and
    null keys get the overall mean.
    """

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._rated(dataset, None)

    def transform_training(self, dataset: DataFrame) -> DataFrame:
        return self._rated(dataset.withColumn("_fold", self._fold()), F.col("_fold")).drop("_fold")

    def _rated(self, dataset: DataFrame, fold) -> DataFrame:
        smoothing = self.getOrDefault(self.smoothing)
        rows = F.array(*[F.lit(float(n)) for n in self.scalars["rows"]])
        late = F.array(*[F.lit(float(n)) for n in self.scalars["late"]])

        def others(per_fold):
            """Sum over the folds without the row's own."""
            total = F.aggregate(per_fold, F.lit(0.0), lambda a, b: a + b)
            return total if fold is None else total - F.get(per_fold, fold)

        prior = F.try_divide(others(late), others(rows))
        rates = {}
        for out in self.getOutputCols():
            n = F.coalesce(others(F.col(f"{out}.rows")), F.lit(0.0))
            s = F.coalesce(others(F.col(f"{out}.late")), F.lit(0.0))
            rates[out] = F.when(n + smoothing == 0, prior).otherwise(
                F.try_divide(s + prior * smoothing, n + smoothing)
            )
        return self._joined(dataset).withColumns(rates)


class OutOfFoldTargetMeanEncoder(
    Estimator, HasInputCols, HasOutputCols, HasLabelCol, _HasFolds, DefaultParamsReadable, DefaultParamsWritable
):
    """Label sums per key and fold, all keys from one scan; a fold is drawn by row content.

    A rate is (late rows + smoothing * overall mean) / (rows + smoothing). Rows without a label
    do not count. Copies of a row by ``foldCols`` share a fold, whatever the layout.
    """

    def __init__(
        self,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        labelCol: str = "label",
        foldCols: list[str] | None = None,
        folds: int = 5,
        smoothing: float = 20.0,
        seed: int = 42,
    ):
        super().__init__()
        self._set(labelCol=labelCol, folds=folds, smoothing=smoothing, seed=seed)
        if inputCols:
            self._set(inputCols=inputCols, outputCols=outputCols or [f"{c}_delay_rate" for c in inputCols])
        if foldCols:
            self._set(foldCols=foldCols)

    def _fit(self, dataset: DataFrame) -> OutOfFoldTargetMeanModel:
        keys, outputs, folds = self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.folds)
        if folds < 2:
            raise ValueError("at least two folds are needed")
        label = F.col(self.getLabelCol()).cast("double")
        marked = dataset.select(*keys, label.alias("_label"), self._fold().alias("_fold"))

        def here(i: int):
            return (F.col("_fold") == i) & F.col("_label").isNotNull()

        sums = F.struct(
            F.array(*[F.count_if(here(i)).cast("double") for i in range(folds)]).alias("rows"),
            F.array(*[
                F.coalesce(F.sum(F.when(here(i), F.col("_label"))), F.lit(0.0)) for i in range(folds)
            ]).alias("late"),
        )
        tables = keyed_aggregates(marked, keys, **{ROWS: F.count(F.lit(1)), "_sums": sums})
        lookups = materialise(tables, {k: {"_sums": o} for k, o in zip(keys, outputs)})
        # every key table, its null row included, covers all training rows
        overall = tables.table(keys[0]).agg(*[
            F.coalesce(F.sum(F.get(f"_sums.{part}", F.lit(i))), F.lit(0.0)).alias(f"{part}{i}")
            for part in ("rows", "late") for i in range(folds)
        ]).first()
        scalars = {part: [overall[f"{part}{i}"] for i in range(folds)] for part in ("rows", "late")}
        return self._copyValues(OutOfFoldTargetMeanModel()._fitted(lookups, scalars))
