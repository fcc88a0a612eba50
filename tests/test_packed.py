import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.legs import PERIODS, ROLES, legs
from latemark.evaluation import curves, ranking_metrics, training_curve
from latemark.plans import TreeConfig, trees
from latemark.plans.onehot import positive_probability
from latemark.training import gbt_stages, truncated
from latemark.training.packed import thresholds

FEATURES = ["a", "b", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    """Many values in a, few in b, one in the third; late rows weigh more."""
    frame = spark.range(3000).select(
        (F.xxhash64("id") % 1000 / 10.0).alias("a"), (F.xxhash64("id", "id") % 7).cast("double").alias("b"), F.lit(3.0).alias("same"), "id"
    )
    frame = frame.withColumn("late", (F.col("a") + 10 * F.col("b") + F.xxhash64(F.lit(5), "id") % 40 > 30).cast("int"))
    return frame.withColumn("weight", F.when(F.col("late") == 1, 2.5).otherwise(1.0)).persist()


def grown(rows, packed, rounds=5, share=1.0, feature_share=1.0):
    stages = gbt_stages(
        FEATURES, "late", "weight", rounds=rounds, learning_rate=0.3, depth=4, row_share=share, feature_share=feature_share, packed=packed
    )
    return stages.fit(rows)


def lines(tree):
    """The tree as text, numbers to eight digits."""
    text = re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m.group()):.8g}", tree.toDebugString)
    return text.split("\n")[1:]


def test_packed_trees_are_those_of_spark(rows, tmp_path):
    own, packed = (grown(rows, p).stages[1] for p in (False, True))
    assert [lines(t) for t in own.trees] == [lines(t) for t in packed.trees] and own.treeWeights == packed.treeWeights
    assert np.allclose(own.featureImportances.toArray(), packed.featureImportances.toArray(), atol=1e-6)
    for a, b in zip(own.trees, packed.trees):
        nodes, others = a._call_java("rootNode"), b._call_java("rootNode")
        for side in ("leftChild", "rightChild"):
            assert getattr(nodes, side)().impurity() == pytest.approx(getattr(others, side)().impurity(), abs=1e-6)
    packed.save(str(tmp_path / "model"))
    again = type(packed).load(str(tmp_path / "model"))
    assert [t.toDebugString.split("\n")[1:] for t in again.trees] == [t.toDebugString.split("\n")[1:] for t in packed.trees]


def test_packed_trees_do_not_depend_on_partitions(rows):
    one, many = (grown(rows.repartition(n), True, 3, 0.6, 0.5).stages[1] for n in (1, 7))
    assert [lines(t) for t in one.trees] == [lines(t) for t in many.trees]
    assert lines(one.trees[0]) != lines(grown(rows, True, 1).stages[1].trees[0])  # rows and features are drawn


@pytest.mark.parametrize("column, wrong", [("a", float("nan")), ("a", float("inf")), ("late", 2), ("weight", -1.0), ("weight", None)])
def test_packed_boosting_refuses_what_spark_refuses(rows, column, wrong):
    bad = rows.withColumn(column, F.when(F.col("id") == 7, F.lit(wrong)).otherwise(F.col(column)))
    for packed in (False, True):
        with pytest.raises(Exception):
            grown(bad, packed, 1)


def test_thresholds_lie_between_values_at_even_steps_of_weight():
    assert thresholds(np.array([3.0, 1.0, 3.0, 2.0]), np.ones(4), 32).tolist() == [1.5, 2.5]
    assert thresholds(np.full(4, 2.0), np.ones(4), 32).tolist() == []
    assert thresholds(np.arange(8.0), np.ones(8), 4).tolist() == [1.5, 3.5, 5.5]


def test_curve_is_the_auc_of_every_round_however_scores_are_cut(rows, monkeypatch):
    fitted = grown(rows, False, 4)
    assembler, booster = fitted.stages
    assembled = assembler.transform(rows)
    whole = [r["auc"] for r in training_curve(booster, assembled, "late").collect()]
    for round_, auc in enumerate(whole, 1):
        scored = positive_probability(truncated(booster, round_).transform(assembled))
        assert ranking_metrics(scored, "late").first()["auc"] == pytest.approx(auc, abs=1e-12)
    monkeypatch.setattr(curves, "RANGE_ROWS", 400)
    monkeypatch.setattr(curves, "SAMPLE_ROWS", 300)
    assert [r["auc"] for r in training_curve(booster, assembled, "late").collect()] == pytest.approx(whole, abs=1e-12)
    one_class = training_curve(booster, assembled.filter("late = 0"), "late").collect()
    assert [r["auc"] for r in one_class] == [None] * 4


def test_curve_makes_no_row_of_a_row_and_round(spark, rows, monkeypatch):
    fitted = grown(rows, False, 2)
    seen = []
    frame = type(rows)
    monkeypatch.setattr(frame, "groupBy", lambda df, *by, plain=frame.groupBy: (seen.append(df), plain(df, *by))[1])
    training_curve(fitted.stages[1], fitted.stages[0].transform(rows), "late")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    assert plans and not any("posexplode" in p for p in plans)


def test_tree_job_grows_its_trees_over_blocks(spark, small, monkeypatch):
    class Seen(Exception):
        pass

    def fitted(self, dataset):
        raise Seen(dataset._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr("latemark.training.packed.PackedBoosting._fit", fitted)
    with pytest.raises(Seen) as told:
        trees.run_trees(spark, TreeConfig(roles=ROLES, periods=PERIODS), legs(spark, small))
    assert "Join" not in str(told.value) and "InMemoryRelation" not in str(told.value)
