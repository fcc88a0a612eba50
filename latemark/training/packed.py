"""Spark's gradient boosting for classification over packed blocks of bins.

Spark keeps an object a row, about 180 bytes, and writes and reads those objects again in every
pass once they no longer fit in memory. Here rows are cut into bins once and packed into blocks of
bytes, some 30 bytes a row; scores of rows are kept in blocks of their own beside them. A level of
a tree is one narrow pass; of two sister nodes the lighter one is summed and the other is what is
left of their parent, so that a row is looked at in less than half of the levels.

The trees are those of ``GBTClassifier``: log loss, a first tree of weight one fitted to labels
-1 and 1, later ones to its negative gradient, splits by weighted variance, thresholds half-way
between values, equal leaves merged, features drawn for every node. Rows are drawn by their content,
which does not depend on partitions. The result is Spark's own model.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.functions.hashing import POSITIONS
from latemark.session import shared_dir
from latemark.training.newton import CUT_AFTER, Tree, _coded, _decoded, _drawn

#: Rows that thresholds are taken from, all rows if there are fewer; Spark's own rule takes 10,000.
SPLIT_ROWS = 100_000
#: Rows of a block.
BLOCK_ROWS = 32_768
#: Partitions a core, so that tasks are few and none is long.
TASKS_A_CORE = 3
#: Shares of a node's variance are told apart by so many digits, so that the order of sums decides nothing.
DIGITS = 10
#: An impurity below is none, as in Spark.
EPSILON = 2.0 ** -52

_ONE_BY_ONE = BatchedSerializer(CPickleSerializer(), 1)


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 thresholds half-way between values, at even steps of weight, by Spark's rule."""
    distinct, place = np.unique(values + 0.0, return_inverse=True)
    if len(distinct) < 2:
        return np.zeros(0)
    halves = (distinct[:-1] + distinct[1:]) / 2
    if len(halves) <= bins - 1:
        return halves
    sums = np.cumsum(np.bincount(place, weights))
    step = sums[-1] / bins
    found, target = [], step
    for index in range(1, len(distinct)):
        if abs(sums[index - 1] - target) < abs(sums[index] - target):
            found.append(halves[index - 1])
            target += step
    return np.array(found)


def _checked(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
    """Refuses what Spark's own boosting refuses."""
    if not np.isfinite(x).all():
        raise ValueError("Vector values MUST NOT be NaN or Infinity")
    if not np.isin(label, (0.0, 1.0)).all():
        raise ValueError("Labels MUST be in {0, 1}")
    if not (np.isfinite(weight) & (weight >= 0)).all():
        raise ValueError("Weights MUST NOT be negative, null, NaN or Infinity")


def _packer(cuts: list[np.ndarray], drawn: bool):
    def block(parts: list[tuple]) -> bytes:
        x, label, weight, draw = (np.concatenate(column) for column in zip(*parts))
        _checked(x, label, weight)
        bins = np.stack([np.searchsorted(c, x[:, k], side="left").astype(np.uint8) for k, c in enumerate(cuts)])
        hashes = (draw.view(np.uint64) >> np.uint64(32)).astype(np.uint32) if drawn else None
        return pickle.dumps((bins, _coded(label), _coded(weight), hashes), 5)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block(parts)], pa.binary())], names=["block"])

        parts, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
                parts.append((x, *(c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])))
                rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield packed(parts)
                parts, rows = [], 0
        if rows:
            yield packed(parts)

    return pack


def _no_scores(block: bytes) -> tuple:
    return bytes(8 * pickle.loads(block)[0].shape[1]), None


def _opened(pairs: Iterator[tuple]) -> Iterator[tuple]:
    """(bins, labels -1 and 1, weights, draws, scores) of each block."""
    for block, (score, _) in pairs:
        bins, label, weight, draw = pickle.loads(block)
        yield bins, 2.0 * _decoded(label) - 1.0, _decoded(weight), draw, np.frombuffer(score)


def _targets(label: np.ndarray, score: np.ndarray, first: bool) -> np.ndarray:
    """What a tree is fitted to: labels at first, then the negative gradient of 2 log(1 + exp(-2 y f))."""
    return label if first else 4.0 * label / (1.0 + np.exp(2.0 * label * score))


def _histograms(tree: Tree, level: int, summed_nodes: np.ndarray, width: int, round_: int, share: float, seed: int):
    """Blocks of one task → rows, weight and weighted target by (node, feature, bin), and squares by node."""
    first = (1 << level) - 1
    slots = np.full(len(tree.feature), -1)
    slots[summed_nodes] = np.arange(len(summed_nodes))
    count = len(summed_nodes)

    def summed(pairs: Iterator[tuple]) -> Iterator[tuple]:
        total, squares = None, np.zeros(count)
        for bins, label, weight, draw, score in _opened(pairs):
            if total is None:
                total = np.zeros((3, len(bins), count * width))
            if share < 1.0:
                rows = np.flatnonzero(_drawn(draw.astype(np.uint64), round_, share, seed))
            else:
                rows = np.arange(len(label))
            if first:
                slot = slots.take(tree.nodes(bins)).take(rows)
                own = np.flatnonzero(slot >= 0)
                rows, slot = rows.take(own), slot.take(own)
            else:
                slot = np.zeros(len(rows), np.int64)
            target, weight = _targets(label.take(rows), score.take(rows), round_ == 0), weight.take(rows)
            product = target * weight
            squares += np.bincount(slot, product * target, count)
            start = slot * width
            for k in range(len(bins)):
                cell = start + bins[k].take(rows)
                total[0, k] += np.bincount(cell, minlength=count * width)
                total[1, k] += np.bincount(cell, weight, count * width)
                total[2, k] += np.bincount(cell, product, count * width)
        if total is not None:
            yield total.reshape(3, -1, count, width).transpose(2, 0, 1, 3).copy(), squares

    return summed


def _variance(weight: float, whole: float, squares: float) -> float:
    return max(0.0, (squares - whole * whole / weight) / weight) if weight > 0 else 0.0


def best_split(sums: np.ndarray, squares: float, cuts: list[np.ndarray], features: np.ndarray):
    """(feature, cut, gain) of a node among ``features``, None where none lowers the variance.

    Of equal gains the first feature, then the lowest cut.
    """
    rows, weight, whole = sums[:, features, :]
    impurity = _variance(weight[0].sum(), whole[0].sum(), squares)
    if impurity < EPSILON:
        return None
    left_n, left_w, left_s = (np.cumsum(a, 1) for a in (rows, weight, whole))
    all_n, all_w, all_s = (a[:, -1:] for a in (left_n, left_w, left_s))
    right_w, right_s = all_w - left_w, all_s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        sides = [np.where(w > 0, s**2 / w, 0.0) for s, w in ((left_s, left_w), (right_s, right_w), (all_s, all_w))]
        gain = (sides[0] + sides[1] - sides[2]) / all_w / impurity
    limits = np.array([len(cuts[f]) for f in features])[:, None]
    able = (left_n >= 0.5) & (all_n - left_n >= 0.5) & (np.arange(gain.shape[1])[None, :] < limits)
    gain = np.round(np.where(able, gain, 0.0), DIGITS)
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)  # the first of the greatest
    if gain[at] <= 0:
        return None
    return int(features[at[0]]), int(at[1]), float(gain[at] * impurity)


class _Grown:
    """A tree with (rows, weight, sum, squares) of each node it has."""

    def __init__(self, depth: int):
        self.tree, self.stats = Tree.empty(depth), {}
        # bin 0 is the lowest here, no value is missing
        self.tree.missing_left[:] = True

    def prediction(self, node: int) -> float:
        _, weight, whole, _ = self.stats[node]
        return float(whole / weight) if weight > 0 else 0.0

    def finished(self) -> Tree:
        """The tree with its predictions; two leaves that say the same are one."""
        for node in reversed(range(len(self.tree.feature))):
            if node not in self.stats:
                continue
            self.tree.value[node] = self.prediction(node)
            if self.tree.feature[node] >= 0:
                a, b = 2 * node + 1, 2 * node + 2
                if self.tree.feature[a] < 0 and self.tree.feature[b] < 0 and self.tree.value[a] == self.tree.value[b]:
                    self.tree.feature[node] = -1
        return self.tree

    def in_spark(self, makes: _SparkNodes, cuts: list[np.ndarray], node: int = 0):
        rows, weight, whole, squares = (float(x) for x in self.stats[node])
        calculator = makes.variance(makes.doubles([weight, whole, squares]), int(round(rows)))
        said, impurity = float(self.tree.value[node]), _variance(weight, whole, squares)
        if (feature := int(self.tree.feature[node])) < 0:
            return makes.leaf(said, impurity, calculator)
        split = makes.split(feature, float(cuts[feature][self.tree.cut[node]]))
        left, right = (self.in_spark(makes, cuts, 2 * node + side) for side in (1, 2))
        return makes.inner(said, impurity, float(self.tree.gain[node]), left, right, split, calculator)


class _SparkNodes:
    """Spark's own classes of a tree, each looked up once."""

    def __init__(self, gateway):
        jvm = gateway.jvm
        self.gateway, self.double = gateway, jvm.double
        self.variance = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        self.leaf, self.inner = jvm.org.apache.spark.ml.tree.LeafNode, jvm.org.apache.spark.ml.tree.InternalNode
        self.split = jvm.org.apache.spark.ml.tree.ContinuousSplit
        self.tree = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        self.model = jvm.org.apache.spark.ml.classification.GBTClassificationModel

    def doubles(self, values: list[float]):
        array = self.gateway.new_array(self.double, len(values))
        for index, value in enumerate(values):
            array[index] = value
        return array


class PackedBoosting(Estimator):
    """Fits what a ``GBTClassifier`` describes, to rows of features without categories, by packed blocks."""

    def __init__(self, described: GBTClassifier):
        super().__init__()
        self.described = described

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        told = self.described
        spark, share, seed = dataset.sparkSession, told.getSubsamplingRate(), told.getSeed()
        weight = F.col(told.getWeightCol()).cast("double") if told.isSet(told.weightCol) else F.lit(1.0)
        x, label = vector_to_array(told.getFeaturesCol()), F.col(told.getLabelCol()).cast("double")
        rows = dataset.select(x.alias("x"), label.alias("label"), weight.alias("weight"))
        rows = rows.withColumn("draw", F.xxhash64("x", "label"))
        total = rows.count()
        if not total:
            raise ValueError("no rows to learn from")
        cuts = self._cuts(rows, total, min(told.getMaxBins(), total))
        cores = spark.sparkContext.defaultParallelism
        columns = rows.coalesce(TASKS_A_CORE * cores).mapInArrow(_packer(cuts, share < 1.0), "block binary")
        # blocks never change, and only scores are written again
        blocks = columns.rdd.map(lambda r: bytes(r[0]))._reserialize(_ONE_BY_ONE).persist(StorageLevel.MEMORY_AND_DISK)
        scores = blocks.map(_no_scores)._reserialize(_ONE_BY_ONE).persist(StorageLevel.MEMORY_AND_DISK)
        grown = []
        try:
            for round_ in range(told.getMaxIter()):
                pairs = blocks.zip(scores)
                grown.append(self._grown(pairs, round_, cuts))
                scores = self._advanced(pairs, scores, grown[-1], round_)
        finally:
            for state in (blocks, scores):
                state.unpersist()
        return self._model(spark, grown, cuts)

    def _cuts(self, rows: DataFrame, total: int, bins: int) -> list[np.ndarray]:
        if total > SPLIT_ROWS:
            place = F.pmod(F.xxhash64("draw"), F.lit(POSITIONS))
            rows = rows.filter(place < int(SPLIT_ROWS / total * POSITIONS))
        taken = rows.select("x", "weight", "label").toArrow()  # about SPLIT_ROWS rows
        weights, labels = (taken.column(c).to_numpy() for c in ("weight", "label"))
        values = taken.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(weights), -1)
        _checked(values, labels, weights)
        return [thresholds(values[:, k], weights, bins) for k in range(values.shape[1])]

    def _grown(self, pairs: RDD, round_: int, cuts: list[np.ndarray]) -> _Grown:
        told = self.described
        depth, share, seed = told.getMaxDepth(), told.getSubsamplingRate(), told.getSeed()
        grown, width = _Grown(depth), max(map(len, cuts)) + 1
        splittable = np.array([f for f, c in enumerate(cuts) if len(c)])
        wanted = max(1, int(np.ceil(len(cuts) * float(told.getFeatureSubsetStrategy()))))
        known, open_nodes = {}, [0]
        for level in range(max(depth, 1)):
            # the lighter of two sisters is summed; what their parent has left is the other
            summed = [self._lighter(grown, known, node) for node in open_nodes] if level else [0]
            work = _histograms(grown.tree, level, np.array(summed), width, round_, share, seed)
            sums, squares = pairs.mapPartitions(work).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
            here = {node: (sums[k], squares[k]) for k, node in enumerate(summed)}
            for parent, node in zip(open_nodes, summed) if level else ():
                whole, part = known[parent], here[node]
                here[4 * parent + 3 - node] = (whole[0] - part[0], whole[1] - part[1])
            open_nodes = []
            for node in sorted(here):
                found, square = here[node]
                grown.stats[node] = (*found[:, 0, :].sum(1), square)
                draws = np.random.default_rng([seed & 0xFFFFFFFF, round_, node])
                own = np.sort(draws.permutation(len(cuts))[:wanted])
                own = own[np.isin(own, splittable)]
                best = best_split(found, square, cuts, own) if depth and len(own) else None
                if best:
                    grown.tree.feature[node], grown.tree.cut[node], grown.tree.gain[node] = best
                    open_nodes.append(node)
            known = here
            if not open_nodes:
                break
        else:
            for node in open_nodes:
                sums, feature, cut = known[node][0], grown.tree.feature[node], grown.tree.cut[node]
                left = sums[:, feature, :cut + 1].sum(1)
                right = sums[:, feature, :].sum(1) - left
                # the squares of leaves follow with the scores
                grown.stats[2 * node + 1], grown.stats[2 * node + 2] = (*left, 0.0), (*right, 0.0)
        grown.finished()
        return grown

    @staticmethod
    def _lighter(grown: _Grown, known: dict, node: int) -> int:
        feature, cut = grown.tree.feature[node], grown.tree.cut[node]
        rows = known[node][0][0, feature]
        return 2 * node + 1 if 2 * rows[:cut + 1].sum() <= rows.sum() else 2 * node + 2

    def _advanced(self, pairs: RDD, scores: RDD, grown: _Grown, round_: int) -> RDD:
        """Scores with one tree more; computed, with the squares of leaves, before the old ones are let go."""
        told, tree, size = self.described, grown.tree, len(grown.tree.feature)
        scale, share, seed = told.getStepSize() if round_ else 1.0, told.getSubsamplingRate(), told.getSeed()

        def work(blocks: Iterator[tuple]) -> Iterator[tuple]:
            for bins, label, weight, draw, score in _opened(blocks):
                node, target = tree.nodes(bins), _targets(label, score, round_ == 0)
                taken = weight if share >= 1.0 else weight * _drawn(draw.astype(np.uint64), round_, share, seed)
                yield (score + scale * tree.value[node]).tobytes(), np.bincount(node, taken * target * target, size)

        after = pairs.mapPartitions(work)._reserialize(_ONE_BY_ONE).persist(StorageLevel.MEMORY_AND_DISK)
        if (round_ + 1) % CUT_AFTER == 0:
            shared_dir(SparkSession.active())
            after.checkpoint()
        squares = after.map(lambda state: state[1]).treeReduce(lambda a, b: a + b)
        for node in grown.stats:
            if tree.feature[node] < 0:
                grown.stats[node] = (*grown.stats[node][:3], squares[node])
        scores.unpersist()
        return after

    def _model(self, spark: SparkSession, grown: list[_Grown], cuts: list[np.ndarray]) -> GBTClassificationModel:
        told, makes = self.described, _SparkNodes(spark.sparkContext._gateway)
        trees = makes.gateway.new_array(makes.tree, len(grown))
        for index, one in enumerate(grown):
            trees[index] = makes.tree(f"dtr_{told.uid}_{index}", one.in_spark(makes, cuts), len(cuts))
        weights = makes.doubles([1.0, *[told.getStepSize()] * (len(grown) - 1)])
        model = GBTClassificationModel(makes.model(told.uid, trees, weights, len(cuts), 2))
        for param, value in told.extractParamMap().items():
            if told.isSet(param) and model.hasParam(param.name):
                model.set(model.getParam(param.name), value)
        model._transfer_params_to_java()
        return model
