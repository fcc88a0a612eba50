"""Logistic regression by full-batch gradient descent.

Training rows are packed once into column-major blocks of doubles and kept. An iteration
is then one narrow pass over the blocks that yields one partial gradient per task, a
plain sum of those, and an update of a handful of numbers on the driver. It depends only
on the kept blocks, so lineage does not grow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasStepSize, HasTol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.features.tables import TableModel
from latemark.session import checkpointed


def score_linear(
    df: DataFrame, features: Sequence[str], weights: Sequence[float], bias: float, threshold: float = 0.5
) -> DataFrame:
    """Add ``probability`` and the 0/1 ``prediction`` of a linear model."""
    margin = F.lit(float(bias))
    for name, weight in zip(features, weights, strict=True):
        margin = margin + F.col(name) * F.lit(float(weight))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return df.withColumn("probability", probability).withColumn(
        "prediction", (F.col("probability") >= threshold).cast("int")
    )


def _packer() -> Callable[[Iterator], Iterator]:
    """Arrow batches of (label, weight, features...) → one block of bytes per batch."""

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                # null and NaN both arrive as NaN; such rows have no gradient
                block = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                block = block[:, ~np.isnan(block).any(axis=0)]
                kept = block.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.tobytes()], pa.binary()), pa.array([kept], pa.int64()),
                        pa.array([batch.num_rows - kept], pa.int64()),
                    ],
                    names=["block", "rows", "skipped"],
                )

    return pack


def _gradient(weights: Sequence[float], bias: float) -> Callable[[Iterator], Iterator]:
    """Blocks of one task → one array: sum of err * feature for each feature, then sum of err."""
    width = len(weights)
    start = list(weights)

    def gradient(blocks):
        import numpy as np

        w = np.asarray(start)
        total = np.zeros(width + 1)
        for buffer in blocks:
            block = np.frombuffer(buffer, dtype=np.float64).reshape(width + 2, -1)
            label, row_weight, x = block[0], block[1], block[2:]
            with np.errstate(over="ignore"):
                err = (1.0 / (1.0 + np.exp(-(w @ x + bias))) - label) * row_weight
            total[:width] += x @ err
            total[width] += err.sum()
        yield total

    return gradient


class RowBlocks:
    """Packed training rows, kept for the length of a ``with`` block.

    Rows with a null or NaN label, weight or feature are left out and counted in ``skipped``.

    Packing is a DataFrame pass. The passes over the blocks are RDD jobs: an iteration
    is the same imperative step on every partition, and going without a new query plan
    makes it several times cheaper when iterations are short.
    """

    def __init__(
        self, df: DataFrame, features: Sequence[str], label: str, weight: str | None = None,
        reliable: bool = False,
    ):
        row_weight = F.col(weight) if weight else F.lit(1.0)
        columns = [F.col(label), row_weight, *[F.col(c) for c in features]]
        doubles = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        self.width = len(features)
        packed = doubles.mapInArrow(_packer(), "block binary, rows bigint, skipped bigint")
        if reliable:
            packed = checkpointed(packed)
        self._packed = packed.rdd.map(lambda row: ((row[1], row[2]), bytes(row[0])))

    def __enter__(self) -> RowBlocks:
        self._packed.persist(StorageLevel.MEMORY_AND_DISK)
        self.rows, self.skipped = self._packed.keys().fold((0, 0), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        self._blocks = self._packed.values()
        return self

    def __exit__(self, *exc) -> None:
        self._packed.unpersist()

    def gradient_sums(self, weights: Sequence[float], bias: float) -> list[float]:
        """Gradient sum of every weight, then of the bias, added up in a tree."""
        return self.summed(_gradient(weights, bias)).tolist()

    def summed(self, per_task: Callable[[Iterator], Iterator]):
        """One array a task from its blocks, added up in a tree."""
        return self._blocks.mapPartitions(per_task).treeReduce(lambda a, b: a + b)


class GradientDescentLogitModel(TableModel, HasInputCols):
    """``scalars``: weights in the order of the input columns, bias, rows and iterations."""

    @property
    def weights(self) -> list[float]:
        return list(self.scalars["weights"])

    @property
    def bias(self) -> float:
        return self.scalars["bias"]

    @property
    def coefficients(self) -> dict[str, float]:
        """Bias first, then every feature by name."""
        return {"bias": self.bias, **dict(zip(self.getInputCols(), self.weights))}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return score_linear(dataset, self.getInputCols(), self.weights, self.bias, self.scalars["threshold"])


class GradientDescentLogit(
    Estimator, HasInputCols, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize, HasTol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Weights start at 0; every iteration subtracts stepSize * gradient sum / row count.

    The divisor is the number of rows, also when rows carry weights. ``tol`` > 0 stops
    early once no coefficient moves by more than it; by default all iterations run.
    ``reliable`` writes the blocks to the checkpoint folder, for long runs in which
    recomputing lost blocks would cost more than writing all of them once.
    """

    threshold = Param(Params._dummy(), "threshold", "lowest probability predicted as 1", TypeConverters.toFloat)
    reliable = Param(Params._dummy(), "reliable", "checkpoint the packed rows", TypeConverters.toBoolean)

    def __init__(
        self,
        inputCols: list[str] | None = None,
        labelCol: str = "label",
        weightCol: str | None = None,
        maxIter: int = 100,
        stepSize: float = 0.1,
        tol: float = 0.0,
        threshold: float = 0.5,
        reliable: bool = False,
    ):
        super().__init__()
        self._set(
            labelCol=labelCol, maxIter=maxIter, stepSize=stepSize, tol=tol, threshold=threshold,
            reliable=reliable,
        )
        if inputCols:
            self._set(inputCols=inputCols)
        if weightCol:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> GradientDescentLogitModel:
        features = self.getInputCols()
        weight = self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None
        packed = RowBlocks(
            dataset, features, self.getLabelCol(), weight, self.getOrDefault(self.reliable)
        )
        with packed as blocks:
            if not blocks.rows:
                raise ValueError("no training rows")
            scalars = self._descend(blocks)
        model = GradientDescentLogitModel()._fitted({}, scalars)
        return self._copyValues(model)

    def _descend(self, blocks: RowBlocks) -> dict:
        step, tol = self.getStepSize() / blocks.rows, self.getTol()
        weights, bias, done = [0.0] * blocks.width, 0.0, 0
        for done in range(1, self.getMaxIter() + 1):
            *slopes, bias_slope = blocks.gradient_sums(weights, bias)
            moves = [step * s for s in slopes]
            weights = [w - m for w, m in zip(weights, moves)]
            bias -= step * bias_slope
            if tol and max(map(abs, [*moves, step * bias_slope])) <= tol:
                break
        return {
            "weights": weights, "bias": bias, "rows": blocks.rows, "skipped": blocks.skipped, "iterations": done,
            "threshold": self.getOrDefault(self.threshold),
        }
