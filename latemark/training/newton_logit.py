"""Logistic regression by Newton's method: the optimum in a few passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasRegParam, HasTol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from latemark.training.descent import GradientDescentLogitModel, RowBlocks

#: A step that raises the loss is halved at most this often.
HALVINGS = 30

#: Columns of a block that are worked on together, so that their square stays in the cache.
STRIDE = 4096


def _curvature(coefficients: Sequence[float]) -> Callable[[Iterator], Iterator]:
    """Blocks of one task → one array: loss, gradient, then the matrix of second derivatives.

    Coefficients and derivatives have the bias last.
    """
    at = list(coefficients)

    def curvature(blocks):
        import numpy as np

        b = np.asarray(at)
        n = len(b)
        loss, slope, second = 0.0, np.zeros(n), np.zeros((n, n))
        for buffer in blocks:
            block = np.frombuffer(buffer, dtype=np.float64).reshape(n + 1, -1)
            for start in range(0, block.shape[1], STRIDE):
                part = block[:, start:start + STRIDE]
                label, row_weight = part[0], part[1]
                x = np.vstack([part[2:], np.ones(part.shape[1])])
                margin = b @ x
                with np.errstate(over="ignore"):
                    p = 1.0 / (1.0 + np.exp(-margin))
                loss += float((row_weight * (np.logaddexp(0.0, margin) - label * margin)).sum())
                slope += x @ (row_weight * (p - label))
                second += (x * (row_weight * p * (1.0 - p))) @ x.T
        yield np.concatenate([[loss], slope, second.ravel()])

    return curvature


class NewtonLogit(
    Estimator, HasInputCols, HasLabelCol, HasWeightCol, HasMaxIter, HasTol, HasRegParam,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Sums of first and second derivatives over the packed rows, one pass an iteration.

    The loss is the weighted sum over rows plus ``regParam`` / 2 times rows times the squared
    weights, the bias left out. A step that would raise the loss is halved. Ends when no
    coefficient moves by more than ``tol`` of its size, or after ``maxIter`` passes. Linearly
    dependent features share their weight. A task sends the square of the number of features,
    so this is for up to some thousand dense features; for one-hot features use L-BFGS.
    """

    threshold = Param(Params._dummy(), "threshold", "lowest probability predicted as 1", TypeConverters.toFloat)

    def __init__(
        self,
        inputCols: list[str] | None = None,
        labelCol: str = "label",
        weightCol: str | None = None,
        maxIter: int = 25,
        tol: float = 1e-9,
        regParam: float = 0.0,
        threshold: float = 0.5,
    ):
        super().__init__()
        self._set(labelCol=labelCol, maxIter=maxIter, tol=tol, regParam=regParam, threshold=threshold)
        if inputCols:
            self._set(inputCols=inputCols)
        if weightCol:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> GradientDescentLogitModel:
        weight = self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None
        with RowBlocks(dataset, self.getInputCols(), self.getLabelCol(), weight) as blocks:
            if not blocks.rows:
                raise ValueError("no training rows")
            scalars = self._solve(blocks)
        return self._copyValues(GradientDescentLogitModel()._fitted({}, scalars))

    def _solve(self, blocks: RowBlocks) -> dict:
        import numpy as np

        n = blocks.width + 1
        penalty = np.append(np.full(blocks.width, self.getRegParam() * blocks.rows), 0.0)

        def sums(at):
            told = blocks.summed(_curvature(at.tolist()))
            loss = told[0] + 0.5 * float(penalty @ (at * at))
            return loss, told[1:n + 1] + penalty * at, told[n + 1:].reshape(n, n) + np.diag(penalty)

        at, done, halved = np.zeros(n), 0, 0
        loss, slope, second = sums(at)
        move = _newton_move(slope, second)
        for done in range(1, self.getMaxIter() + 1):
            tried = at - move
            new = sums(tried)
            # at the optimum the loss only wavers in its last digits
            if not new[0] <= loss + 1e-12 * abs(loss) and halved < HALVINGS:
                move, halved = move / 2, halved + 1
                continue
            still = np.all(np.abs(move) <= self.getTol() * np.maximum(np.abs(tried), 1e-6))
            at, halved = tried, 0
            loss, slope, second = new
            if still:
                break
            move = _newton_move(slope, second)
        return {
            "weights": at[:-1].tolist(), "bias": float(at[-1]), "rows": blocks.rows, "skipped": blocks.skipped,
            "iterations": done, "threshold": self.getOrDefault(self.threshold),
        }


def _newton_move(slope, second):
    """Solve for the step; features of very different size are brought to one scale first."""
    import numpy as np

    scale = 1.0 / np.sqrt(np.maximum(np.diag(second), 1e-300))
    return scale * np.linalg.lstsq(second * np.outer(scale, scale), slope * scale, rcond=None)[0]
