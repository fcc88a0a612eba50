import random

import pytest
from pyspark.sql import functions as F

from latemark.evaluation import (
    best_round, binary_metrics, classification_report, confusion_matrix, pr_curve, ranking_metrics,
)
from latemark.operators import buckets

SCORED = "label int, probability double"


def metrics(spark, rows):
    return ranking_metrics(spark.createDataFrame(rows, SCORED)).first()


@pytest.mark.parametrize("rows, auc, desc", [
    ([(1, .9), (1, .8), (0, .2), (0, .1)], 1.0, 0.0),
    ([(1, .9), (0, .8), (1, .7), (0, .1)], 0.75, 0.25),
    ([(1, .5), (1, .5), (0, .5), (0, .5)], 0.5, -0.25),
])
def test_hand_cases(spark, rows, auc, desc):
    found = metrics(spark, rows)
    assert found["auc"] == pytest.approx(auc) and found["auc_desc_rank"] == pytest.approx(desc)


def brute_force(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, before = 0.0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        hits = sum(p >= s for p in pos)
        ap += (hits - before) / len(pos) * hits / (hits + sum(n >= s for n in neg))
        before = hits
    return auc, ap


@pytest.mark.parametrize("rows_per_bucket, intervals", [(1_000_000, 1024), (5, 8), (1, 1024)])
@pytest.mark.parametrize("kind", ["ties", "fine", "narrow", "signed"])
def test_any_bucketing_is_exact(spark, monkeypatch, rows_per_bucket, intervals, kind):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", rows_per_bucket)
    monkeypatch.setattr(buckets, "INTERVALS", intervals)
    rng = random.Random(5)
    draw = {
        "ties": lambda: rng.randrange(4) / 4, "fine": rng.random,
        "narrow": lambda: 0.5 + rng.random() * 1e-9, "signed": lambda: rng.choice([-1e300, -0.0, 0.0, 3.0, 1e300]),
    }[kind]
    rows = [(int(rng.random() < 0.3), draw()) for _ in range(300)]
    found = metrics(spark, rows)
    auc, ap = brute_force(rows)
    assert found["auc"] == pytest.approx(auc) and found["average_precision"] == pytest.approx(ap)


def test_one_score_holding_most_rows(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 10)
    rows = [(i % 3 == 0, 0.25) for i in range(400)] + [(i % 2 == 0, i / 100) for i in range(100)]
    rows = [(int(y), s) for y, s in rows]
    assert metrics(spark, rows)["auc"] == pytest.approx(brute_force(rows)[0])


def test_missing_class_and_no_rows_give_null(spark):
    found = metrics(spark, [(1, 0.5), (1, 0.7)])
    assert found["auc"] is None and found["positives"] == 2 and found["negatives"] == 0
    empty = metrics(spark, [])
    assert empty["auc"] is None and empty["positives"] == 0


def test_groups_are_ranked_apart(spark):
    rows = [("a", 1, .9), ("a", 0, .1), ("b", 0, .9), ("b", 1, .1)]
    df = spark.createDataFrame(rows, "g string, label int, probability double")
    assert dict(ranking_metrics(df, by=["g"]).select("g", "auc").collect()) == {"a": 1.0, "b": 0.0}


def test_threshold_metrics_of_an_empty_frame_are_zero(spark):
    row = binary_metrics(spark.createDataFrame([], "label int, prediction int")).first()
    assert row["tp"] == 0 and row["accuracy"] == 0.0 and row["f1"] == 0.0
    assert confusion_matrix(spark.createDataFrame([], "label int, prediction double")).count() == 0


def test_report_support(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "label int, prediction int")
    report = {r["name"]: r for r in classification_report(df).collect()}
    assert report["1"]["support"] == 2 and report["0"]["precision"] == 0.5 and report["1"]["recall"] == 0.5
    assert report["macro avg"]["support"] == 3


def test_curve_ends_at_full_recall(spark):
    rows = [(i % 4 == 0, i / 1000) for i in range(1000)]
    df = spark.createDataFrame([(int(y), s) for y, s in rows], SCORED)
    thin = pr_curve(df, points=20)
    # one more for the scores above the first positive row
    assert thin.count() == 21 and thin.agg(F.max("recall")).first()[0] == 1.0
    assert thin.exceptAll(pr_curve(df)).isEmpty()


def test_steps_of_the_thinned_curve_are_exact(spark):
    df = spark.createDataFrame([(1, i / 100) for i in range(100)], SCORED)
    thin = pr_curve(df, points=100)
    assert thin.count() == 100 and thin.exceptAll(pr_curve(df)).isEmpty()


def test_best_round_looks_no_further_than_patience(spark):
    curve = spark.createDataFrame([(1, .5), (2, .6), (3, .55), (4, .5), (5, .9)], "round int, auc double")
    assert best_round(curve) == 5 and best_round(curve, patience=2) == 2 and best_round(curve, patience=3) == 5


def test_rows_are_read_and_shuffled_once(spark, kept_clean):
    """Bucket totals and running sums share one shuffle of the counts, after one scan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ranking_metrics(kept_clean, score="distance")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    plan = plan.split("InMemoryRelation")[0] if plan.count("InMemoryTableScan") == 1 else plan
    assert "ReusedExchange" in plan or plan.count("InMemoryTableScan") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_null_group_is_ranked_too(spark):
    rows = [(None, 1, .9), (None, 0, .1), ("b", 0, .9), ("b", 1, .1)]
    df = spark.createDataFrame(rows, "g string, label int, probability double")
    assert dict(ranking_metrics(df, by=["g"]).select("g", "auc").collect()) == {None: 1.0, "b": 0.0}
