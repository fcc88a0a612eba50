"""Importance of features and progress over boosting rounds."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.sources import restaged


#: Rows of a round that meet in one range of scores, about.
RANGE_ROWS = 500_000
MAX_RANGES = 2_000
#: Rows whose scores tell where ranges end.
SAMPLE_ROWS = 20_000


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector slots, from the metadata the assembler left."""
    attributes = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in slots]


def feature_importances(spark: SparkSession, importances: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(feature, importance), least important first; one row per feature."""
    rows = [(n, float(v)) for n, v in zip(names, importances, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")


def leaf_values(tree: DecisionTreeRegressionModel) -> list[float]:
    """Predictions of the leaves from left to right, the order of their indices."""
    return [float(value) for value in re.findall(r"Predict: (\S+)", tree.toDebugString)]


def training_curve(model: GBTClassificationModel, rows: DataFrame, label: str) -> DataFrame:
    """(round, auc): ROC AUC on ``rows`` after each boosting round.

    Every tree scores a row once, and its votes are staged; one running sum over them is
    the row's score after each round. Scores are not rows of a table, of which there would be one a
    row and round, but sorted arrays, and equal ones collapse before they are shuffled.
    """
    trees = list(zip(model.trees, model.treeWeights))
    values = [F.lit([value * weight for value in leaf_values(tree)]) for tree, weight in trees]
    # one column holds the leaves of all trees
    scored = model.copy({model.leafCol: "_leaves"}).transform(rows)
    leaves = scored.select(F.col(label), vector_to_array("_leaves").alias("_leaves"))
    votes = F.array(*[F.get(v, F.get("_leaves", F.lit(k)).cast("int")) for k, v in enumerate(values)])
    kept = restaged(leaves.select(label, votes.alias("_votes")), "votes")
    return _auc_by_round(kept, label, len(trees))


def _auc_by_round(kept: DataFrame, label: str, rounds: int) -> DataFrame:
    """The curve from (label, ``_votes``): scores meet in ranges of one round, sorted as arrays."""
    rows = kept.select(F.col(label).cast("int").alias("label"), "_votes").filter(F.col("label").isin(0, 1))
    total = rows.count()
    ranges = max(1, min(-(-total // RANGE_ROWS), MAX_RANGES))
    cuts = [np.zeros(0)] * rounds
    if ranges > 1:
        # some rows tell where ranges end, that is how even they are; the numbers do not depend on it
        place = F.pmod(F.xxhash64("_votes"), F.lit(1 << 32))
        taken = rows.filter(place < int(min(1.0, SAMPLE_ROWS / total) * (1 << 32))).select("_votes").toArrow()
        if taken.num_rows:
            scores = np.cumsum(_matrix(taken.column(0).combine_chunks(), rounds), axis=1)
            shares = np.arange(1, ranges) / ranges
            cuts = [np.unique(np.quantile(column, shares)) for column in scores.T]
    spread = rows.mapInArrow(_by_range(cuts, rounds), "round int, part int, pos binary, pos_rows binary, neg binary, neg_rows binary")
    parts = spread.groupBy("round", "part").applyInArrow(
        _pairs, "round int, part int, positives bigint, negatives bigint, above double"
    ).orderBy("round", F.desc("part")).collect()  # rounds * ranges rows at most
    found: dict[int, list[float]] = {}
    for part in parts:
        sums = found.setdefault(part["round"], [0.0, 0.0, 0.0])
        sums[2] += part["above"] + sums[0] * part["negatives"]
        sums[0] += part["positives"]
        sums[1] += part["negatives"]
    curve = [(k, above / (pos * neg) if pos and neg else None) for k, (pos, neg, above) in sorted(found.items())]
    return kept.sparkSession.createDataFrame(curve, "round int, auc double").orderBy("round")


def _matrix(votes: pa.ListArray, rounds: int) -> np.ndarray:
    return votes.flatten().to_numpy(zero_copy_only=False).reshape(len(votes), rounds)


def _counted(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct scores in order, rows of each)."""
    return np.unique(scores + 0.0, return_counts=True)  # -0.0 and 0.0 are one score


def _by_range(cuts: list[np.ndarray], rounds: int):
    """Batches of (label, votes) → a row a round and range: distinct scores and their rows, by label."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late = batch.column(0).to_numpy() == 1
            scores = np.cumsum(_matrix(batch.column(1), rounds), axis=1).T
            columns = [[] for _ in range(6)]
            for round_, (own, limits) in enumerate(zip(scores, cuts)):
                known = ~np.isnan(own)
                sides = [_counted(own[known & side]) for side in (late, ~late)]
                ends = [np.searchsorted(distinct, limits, side="left") for distinct, _ in sides]
                for part, bounds in enumerate(zip(*(zip([0, *e], [*e, len(d)]) for e, (d, _) in zip(ends, sides)))):
                    if any(low < high for low, high in bounds):
                        cells = [a[low:high].tobytes() for (low, high), side in zip(bounds, sides) for a in side]
                        for column, cell in zip(columns, (round_ + 1, part, *cells)):
                            column.append(cell)
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["round", "part", "pos", "pos_rows", "neg", "neg_rows"],
            )

    return spread


def _pairs(table: pa.Table) -> pa.Table:
    """One round and range → its rows by label, and the pairs in which the late row scores higher, ties half."""

    def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
        scores, rows = (
            np.concatenate([np.frombuffer(cell.as_buffer(), kind) for cell in table.column(column)])
            for column, kind in ((name, np.float64), (f"{name}_rows", np.int64))
        )
        order = np.argsort(scores, kind="stable")
        return scores[order], rows[order]

    (pos, pos_rows), (neg, neg_rows) = merged("pos"), merged("neg")
    upto = np.concatenate([[0], np.cumsum(pos_rows)])
    below, not_above = (upto[np.searchsorted(pos, neg, side=side)] for side in ("left", "right"))
    above = float(np.sum(neg_rows * (upto[-1] - (below + not_above) / 2.0)))
    columns = [table.column("round")[:1], table.column("part")[:1], [int(upto[-1])], [int(neg_rows.sum())], [above]]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
    return pa.table({
        n: c if isinstance(c, pa.ChunkedArray) else pa.array(c, k)
        for n, c, k in zip(("round", "part", "positives", "negatives", "above"), columns, kinds)
    })


def loss_curve(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """(round, loss): mean training loss function on ``rows`` after each round."""
    losses = model.evaluateEachIteration(rows)
    return rows.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(losses)], "round int, loss double"
    )


def best_round(curve: DataFrame, patience: int | None = None) -> int:
    """Round with the best auc, looking no further than ``patience`` rounds without a gain."""
    best, best_auc = 0, float("-inf")
    for row in curve.orderBy("round").collect():  # one row per round
        if patience is not None and best and row["round"] - best > patience:
            break
        if row["auc"] is not None and row["auc"] > best_auc:
            best, best_auc = row["round"], row["auc"]
    if not best:
        raise ValueError("no round has a defined auc")
    return best
