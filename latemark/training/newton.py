"""Boosted trees of second order: gradient and hessian histograms over packed blocks.

Features are cut into bins once and packed with label, weight and a content hash into blocks
of bytes, one for each Arrow batch. Blocks are elements of an RDD, so a task holds one at a time
however many its partition has, and rows held back have their own. A level of a tree is one
narrow pass that adds up gradient and hessian by node, feature and bin, one array a task, summed
in a tree; the driver sees nodes * features * bins numbers and picks the splits. The score of
every row so far, its margin, is kept beside the block and grows by one tree a round, so no row
is scored twice.

Leaves are shrunk by an L2 penalty, features are drawn per tree and rows by their content,
and boosting ends where the ROC AUC of the validation rows has not risen for some rounds.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasSeed, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from latemark.evaluation.ranking import roc_auc
from latemark.features.tables import TableModel
from latemark.session import held, shared_dir

#: Rounds after which the margins are written and their lineage is cut.
CUT_AFTER = 10
#: Gains are told apart by so many digits, so that the order of sums decides nothing.
DIGITS = 6


@dataclass
class Tree:
    """Arrays by node, the children of i at 2 i + 1 and 2 i + 2; ``feature`` is -1 at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = (2 << depth) - 1
        return cls(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size), np.zeros(size))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node of each row of ``bins`` (a row for each feature; 0 is missing)."""
        rows = bins.shape[1]
        at, order, flat = np.zeros(rows, np.int64), np.arange(rows), np.ascontiguousarray(bins).ravel()
        steps = self._levels()
        if steps:
            first = np.maximum(self.feature, 0) * rows
            following = self._following()
        for _ in range(steps):
            at = following.take(at * 256 + flat.take(first.take(at) + order))
        return at

    def _levels(self) -> int:
        """Splits on the longest way down."""
        inner = np.flatnonzero(self.feature >= 0)
        return int(inner[-1] + 1).bit_length() if len(inner) else 0

    def _following(self) -> np.ndarray:
        """Next node by node and bin, 256 bins a node; leaves stay."""
        node, own = np.arange(len(self.feature))[:, None], np.arange(256)[None, :]
        left = np.where(own == 0, self.missing_left[:, None], own <= self.cut[:, None])
        return np.where(self.feature[:, None] >= 0, 2 * node + 2 - left, node).ravel()

    def as_lists(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("feature", "cut", "missing_left", "gain", "value")}

    @classmethod
    def of(cls, lists: dict) -> Tree:
        kinds = (np.int64, np.int64, bool, np.float64, np.float64)
        return cls(*(np.array(v, k) for v, k in zip(lists.values(), kinds)))


def binned(values: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
    """Bin 0 for missing values, else 1 + the number of cuts below the value."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(np.asarray(cuts), values, side="left")).astype(np.uint8)


def cut_points(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Up to ``bins`` - 1 cuts a feature: all its values but the greatest if they are few, else quantiles.

    A sketch of fixed size or a set of few values a feature is all that tasks send.
    """
    doubles = df.select(*(F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f"f{i}") for i, f in enumerate(features)))
    names = doubles.columns
    distinct = doubles.agg(*(F.approx_count_distinct(n).alias(n) for n in names)).first()
    shares = [i / bins for i in range(1, bins + 1)]
    found = doubles.agg(*(
        (F.collect_set(n) if distinct[n] <= bins else F.percentile_approx(n, shares)).alias(n) for n in names
    )).first()
    cuts = []
    for n in names:
        values = sorted(set(found[n] or []))[:-1]
        step = -(-len(values) // (bins - 1)) or 1
        cuts.append(values[::step])
    return cuts


def _coded(values: np.ndarray) -> tuple:
    """(distinct values, a byte a row), or (None, values) where there are more than 256."""
    few, code = np.unique(values, return_inverse=True)
    return (few, code.astype(np.uint8)) if len(few) <= 256 else (None, values)


def _decoded(coded: tuple) -> np.ndarray:
    few, code = coded
    return code if few is None else few[code]


def _packer(cuts: list[list[float]], drawn: bool) -> Callable[[Iterator], Iterator]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, weight, draw, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            known = ~(np.isnan(label) | np.isnan(weight))
            bins = np.stack([binned(v[known], c) for v, c in zip(values, cuts)])
            hashes = draw[known].view(np.uint64) if drawn else None
            block = pickle.dumps((bins, _coded(label[known]), _coded(weight[known]), hashes), 5)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary()), pa.array([int(known.sum())], pa.int64())], names=["block", "rows"])

    return pack


def _opened(state: Iterator[tuple]) -> Iterator[tuple]:
    for block, margin in state:
        bins, label, weight, draw = pickle.loads(block)
        yield block, (bins, _decoded(label), _decoded(weight), draw), np.frombuffer(margin)


def _drawn(draw: np.ndarray, round_: int, share: float, seed: int) -> np.ndarray:
    """Whether each row, known by its content hash, takes part in a round."""
    with np.errstate(over="ignore"):
        mixed = (draw ^ np.uint64(seed * 1_000_003 + round_ + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(11)).astype(np.float64) < share * (1 << 53)


def _histograms(tree: Tree, level: int, features: np.ndarray, width: int, round_: int, share: float, seed: int):
    """Blocks of one task → one array (node, feature, bin, gradient and hessian) for a level."""
    first, count = (1 << level) - 1, 1 << level

    def summed(state: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((2, len(features), count * width))
        for _, (bins, label, weight, draw), margin in _opened(state):
            node = tree.nodes(bins) - first
            own = node >= 0
            if share < 1.0:
                own &= _drawn(draw, round_, share, seed)
            taken = slice(None) if own.all() else np.flatnonzero(own)
            p = 1.0 / (1.0 + np.exp(-margin[taken]))
            sums = ((p - label[taken]) * weight[taken], p * (1.0 - p) * weight[taken])
            start = node[taken] * width
            for k, f in enumerate(features):
                cell = start + bins[f][taken]
                for side in (0, 1):
                    total[side, k] += np.bincount(cell, sums[side], count * width)
        yield total.reshape(2, len(features), count, width).transpose(0, 2, 1, 3).copy()

    return summed


def best_splits(sums: np.ndarray, features: np.ndarray, cuts: list[list[float]], penalty: float, least: float):
    """For each node (feature, cut, missing left, gain, left and right leaf value), None where none gains.

    Of equal gains the first feature, then the lowest cut, then missing values to the right.
    """
    chosen = []
    limits = np.array([len(cuts[f]) for f in features])
    for g, h in zip(sums[0], sums[1]):
        whole_g, whole_h = g[0].sum(), h[0].sum()
        left_g, left_h = np.cumsum(g[:, 1:], 1)[..., None], np.cumsum(h[:, 1:], 1)[..., None]
        missing = np.array([0.0, 1.0])
        left_g, left_h = left_g + missing * g[:, :1, None], left_h + missing * h[:, :1, None]
        right_g, right_h = whole_g - left_g, whole_h - left_h
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - whole_g**2 / (whole_h + penalty)
        able = (left_h >= least) & (right_h >= least) & (np.arange(gain.shape[1])[None, :, None] < limits[:, None, None])
        gain = np.round(np.where(able, gain, 0.0), DIGITS)
        at = np.unravel_index(int(np.argmax(gain)), gain.shape)  # the first of the greatest
        if gain[at] <= 0:
            chosen.append(None)
            continue
        values = [float(-a[at] / (b[at] + penalty)) for a, b in ((left_g, left_h), (right_g, right_h))]
        chosen.append((int(features[at[0]]), int(at[1]) + 1, bool(at[2]), float(gain[at]), *values))
    return chosen


class NewtonTreesModel(TableModel, HasInputCols):
    """``scalars``: cuts by feature, trees, auc by round, rounds in use, threshold."""

    @property
    def trees(self) -> list[Tree]:
        return [Tree.of(t) for t in self.scalars["trees"]][:self.scalars["rounds"]]

    def gains(self, spark: SparkSession) -> DataFrame:
        """(feature, splits, gain, importance): number and gain of all splits, and the share of the gain."""
        names, rows = self.getInputCols(), []
        every = [(int(f), float(g)) for t in self.trees for f, g in zip(t.feature, t.gain) if f >= 0]
        whole = sum(g for _, g in every) or 1.0
        for k, name in enumerate(names):
            own = [g for f, g in every if f == k]
            rows.append((name, len(own), float(sum(own)), float(sum(own)) / whole))
        return spark.createDataFrame(rows, "feature string, splits int, gain double, importance double")

    def splits(self, spark: SparkSession) -> DataFrame:
        """(round, node, feature, cut, gain) of all splits: values up to ``cut`` go to 2 node + 1."""
        names, cuts = self.getInputCols(), self.scalars["cuts"]
        rows = [
            (r + 1, node, names[f], float(cuts[f][int(t.cut[node]) - 1]), float(t.gain[node]))
            for r, t in enumerate(self.trees) for node, f in enumerate(t.feature) if f >= 0
        ]
        return spark.createDataFrame(rows, "round int, node int, feature string, cut double, gain double")

    def curve(self, spark: SparkSession) -> DataFrame:
        """(round, auc) of the validation rows after every round that was grown."""
        rows = [(i + 1, a) for i, a in enumerate(self.scalars["auc"])]
        return spark.createDataFrame(rows, "round int, auc double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, features = dataset.columns, self.getInputCols()
        cuts, trees, threshold = self.scalars["cuts"], self.trees, self.scalars["threshold"]
        width = len(columns)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = np.stack([binned(c.to_numpy(zero_copy_only=False), k) for c, k in zip(batch.columns[width:], cuts)])
                margin = np.zeros(batch.num_rows)
                for tree in trees:
                    margin += tree.value[tree.nodes(bins)]
                p = 1.0 / (1.0 + np.exp(-margin))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=[*columns, "probability", "prediction"],
                )

        schema = StructType([
            *dataset.schema.fields, StructField("probability", DoubleType()), StructField("prediction", IntegerType()),
        ])
        doubles = [F.col(f).cast("double").alias(f"__{i}") for i, f in enumerate(features)]
        return dataset.select("*", *doubles).mapInArrow(work, schema)


class NewtonTrees(
    Estimator, HasInputCols, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize, HasSeed,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Second-order boosted trees for labels 0 and 1.

    ``validationCol`` names a boolean column whose rows are not learnt from; with it boosting
    ends ``patience`` rounds after the best AUC and the model keeps the best round. Null and
    NaN features are missing and go to the side that gains more; rows with a null label or
    weight are left out.
    """

    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    penalty = Param(Params._dummy(), "penalty", "L2 penalty of leaves", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least sum of hessians of a child", TypeConverters.toFloat)
    rowShare = Param(Params._dummy(), "rowShare", "share of rows drawn for a tree", TypeConverters.toFloat)
    featureShare = Param(Params._dummy(), "featureShare", "share of features drawn for a tree", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "bins of a feature, 255 at most", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "rounds without a better AUC", TypeConverters.toInt)
    validationCol = Param(Params._dummy(), "validationCol", "boolean column of rows held back", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "lowest probability predicted as 1", TypeConverters.toFloat)

    def __init__(
        self, inputCols: list[str] | None = None, labelCol: str = "label", weightCol: str | None = None,
        validationCol: str | None = None, maxIter: int = 50, stepSize: float = 0.05, depth: int = 6,
        penalty: float = 1.0, leastWeight: float = 1.0, rowShare: float = 0.8, featureShare: float = 0.8,
        bins: int = 64, patience: int = 30, seed: int = 42, threshold: float = 0.5,
    ):
        super().__init__()
        self._set(
            labelCol=labelCol, maxIter=maxIter, stepSize=stepSize, depth=depth, penalty=penalty, leastWeight=leastWeight,
            rowShare=rowShare, featureShare=featureShare, bins=bins, patience=patience, seed=seed, threshold=threshold,
        )
        for param, value in ((self.inputCols, inputCols), (self.weightCol, weightCol), (self.validationCol, validationCol)):
            if value is not None:
                self._set(**{param.name: value})

    def _fit(self, dataset: DataFrame) -> NewtonTreesModel:
        get = self.getOrDefault
        features = self.getInputCols()
        if not 2 <= get(self.bins) <= 255:
            raise ValueError("bins must lie between 2 and 255")
        valid = F.coalesce(F.col(get(self.validationCol)).cast("boolean"), F.lit(False)) if self.isSet(self.validationCol) else F.lit(False)
        weight = F.col(get(self.weightCol)) if self.isSet(self.weightCol) else F.lit(1.0)
        learnt = dataset.filter(~valid)
        cuts = cut_points(learnt, features, get(self.bins))
        doubles = [F.col(f).cast("double") for f in features]
        draw = F.xxhash64(F.lit(get(self.seed)), F.col(get(self.labelCol)), *doubles)
        shared_dir(dataset.sparkSession)  # where margins are checkpointed

        def packed(rows: DataFrame) -> RDD:
            """(block, margins of 0) of the rows."""
            columns = rows.select(
                F.col(get(self.labelCol)).cast("double").alias("label"), weight.cast("double").alias("weight"),
                draw.alias("draw"), *(c.alias(f"f{i}") for i, c in enumerate(doubles)),
            )
            blocks = columns.mapInArrow(_packer(cuts, get(self.rowShare) < 1.0), "block binary, rows bigint").rdd
            return blocks.map(lambda r: (bytes(r[0]), bytes(8 * r[1]))).persist(StorageLevel.MEMORY_AND_DISK)

        state = packed(learnt)
        judged = packed(dataset.filter(valid)) if self.isSet(self.validationCol) else None
        draws = np.random.default_rng(get(self.seed))
        trees, aucs, best = [], [], 0
        try:
            for round_ in range(self.getMaxIter()):
                wanted = max(1, int(np.ceil(len(features) * get(self.featureShare))))
                own = np.sort(draws.permutation(len(features))[:wanted])
                tree = self._grown(state, round_, own, cuts)
                trees.append(tree)
                state = self._advanced(state, tree, round_)
                if judged is not None:
                    judged = self._advanced(judged, tree, round_)
                    with held(_scores(dataset.sparkSession, judged)) as scores:
                        auc = roc_auc(scores, "label", "margin").first()["auc"]
                    aucs.append(auc)
                    if auc is not None and (not best or auc > aucs[best - 1]):
                        best = round_ + 1
                    if round_ + 1 - best >= get(self.patience):
                        break
                if tree.feature[0] < 0 and get(self.rowShare) >= 1.0 and get(self.featureShare) >= 1.0:
                    break  # no later tree would split either
        finally:
            state.unpersist()
            if judged is not None:
                judged.unpersist()
        scalars = {
            "cuts": cuts, "trees": [t.as_lists() for t in trees], "auc": aucs, "rounds": best or len(trees),
            "threshold": get(self.threshold),
        }
        return self._copyValues(NewtonTreesModel()._fitted({}, scalars))

    def _grown(self, state: RDD, round_: int, features: np.ndarray, cuts: list[list[float]]) -> Tree:
        get = self.getOrDefault
        depth, step = get(self.depth), self.getStepSize()
        tree, width = Tree.empty(depth), max(map(len, cuts)) + 2
        for level in range(depth):
            work = _histograms(tree, level, features, width, round_, get(self.rowShare), get(self.seed))
            sums = state.mapPartitions(work).treeReduce(lambda a, b: a + b)
            split = False
            for k, found in enumerate(best_splits(sums, features, cuts, get(self.penalty), get(self.leastWeight))):
                node = (1 << level) - 1 + k
                if found is None:
                    if not node:
                        g, h = sums[0, 0, 0].sum(), sums[1, 0, 0].sum()
                        tree.value[0] = -g / (h + get(self.penalty)) * step if h else 0.0
                    continue
                split = True
                tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = found[:4]
                tree.value[2 * node + 1], tree.value[2 * node + 2] = (v * step for v in found[4:])
            if not split:
                break
        return tree

    def _advanced(self, state: RDD, tree: Tree, round_: int) -> RDD:
        """The state with one tree more; computed before the old one is let go."""

        def work(blocks: Iterator[tuple]) -> Iterator[tuple]:
            for block, (bins, *_), margin in _opened(blocks):
                yield block, (margin + tree.value[tree.nodes(bins)]).tobytes()

        after = state.mapPartitions(work).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CUT_AFTER == 0:
            after.checkpoint()
        after.foreachPartition(_drained)
        state.unpersist()
        return after


def _drained(state: Iterator[tuple]) -> None:
    for _ in state:
        pass


def _scores(spark: SparkSession, state: RDD) -> DataFrame:
    """(label, margin) of the rows."""

    def pairs(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for _, (_, label, _, _), margin in _opened(blocks):
            yield label.astype(np.int32).tobytes(), margin.tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, margin in zip(*batch.columns):
                columns = [pa.array(np.frombuffer(label.as_py(), np.int32)), pa.array(np.frombuffer(margin.as_py()))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "margin"])

    packed = spark.createDataFrame(state.mapPartitions(pairs), "label binary, margin binary", verifySchema=False)
    return packed.mapInArrow(work, "label int, margin double")
