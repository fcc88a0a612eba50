import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from checks.legs import PERIODS, ROLES, START_YEAR, legs
from latemark.operators import add_class_weight, clean_legs, mark_parts
from latemark.plans import DescentConfig, OneHotConfig, TreeConfig, run_descent, run_onehot, run_trees
from latemark.plans.onehot import positive_probability
from latemark.plans.trees import TREE_FEATURES, labelled_legs
from latemark.training import GradientDescentLogit, class_weight, fit_onehot_logit, onehot_logit_stages, score_linear, truncated
from latemark.training.builtin import encoding_stages


def brute_force(x, y, w, steps, rate):
    weights, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        err = (1 / (1 + np.exp(-(x @ weights + bias))) - y) * w
        weights, bias = weights - rate * x.T @ err / len(y), bias - rate * err.sum() / len(y)
    return weights, bias


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=500) > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t), 3.0 if t else 1.0) for r, t in zip(x, y)],
                               "a double, b double, c double, label int, weight double")
    return df.repartition(5), x, y


@pytest.mark.parametrize("weighted", [False, True])
def test_descent_matches_brute_force(noisy, weighted):
    df, x, y = noisy
    model = GradientDescentLogit(["a", "b", "c"], weightCol="weight" if weighted else None, maxIter=30, stepSize=0.5).fit(df)
    weights, bias = brute_force(x, y, np.where(y == 1, 3.0, 1.0) if weighted else np.ones(500), 30, 0.5)
    assert np.allclose(model.weights, weights) and math.isclose(model.bias, bias)
    assert list(model.coefficients) == ["bias", "a", "b", "c"]


def test_descent_on_checkpointed_blocks_and_tolerance(noisy):
    df, _, _ = noisy
    plain = GradientDescentLogit(["a", "b", "c"], maxIter=10).fit(df)
    safe = GradientDescentLogit(["a", "b", "c"], maxIter=10, reliable=True).fit(df)
    assert np.allclose(plain.weights, safe.weights)
    early = GradientDescentLogit(["a", "b", "c"], maxIter=500, stepSize=1.0, tol=0.01).fit(df)
    assert early.scalars["iterations"] < 500


def test_descent_needs_rows(noisy):
    with pytest.raises(ValueError, match="no training rows"):
        GradientDescentLogit(["a"]).fit(noisy[0].filter("a is null"))


def test_scores_of_extreme_margins(spark):
    df = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "x double")
    rows = score_linear(df, ["x"], [1.0], 0.0).collect()
    assert [(r["probability"], r["prediction"]) for r in rows] == [(0.0, 0), (0.5, 1), (1.0, 1)]


def test_missing_class_is_refused(spark):
    with pytest.raises(ValueError, match="both classes"):
        class_weight(spark.createDataFrame([(0,), (0,)], "label int"))


def test_unseen_category_is_all_zero(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    test = spark.createDataFrame([("z", 4.0), (None, 5.0), ("b", 6.0)], "c string, x double")
    found = Pipeline(stages=encoding_stages(["c"], ["x"])).fit(train).transform(test)
    assert [list(r["features"].toArray()) for r in found.collect()] == [[0, 0, 4], [0, 0, 5], [0, 1, 6]]


def test_descent_run_publishes_everything(spark, small, tmp_path):
    config = DescentConfig(roles=ROLES, periods=PERIODS, start_year=START_YEAR, max_iter=5,
                           output=str(tmp_path), save_predictions=True, mode="baseline")
    run = run_descent(spark, config, legs(spark, small))
    row = run.document.first()
    assert row["train_rows"] == 2529 and row["test_rows"] == 1072 and row["test_year_start"] == 2000
    assert set(row["weights"]) == {"bias", *row["feature_cols"]} and row["positive_weight"] == 1.0
    assert spark.read.parquet(run.written["predictions"]).count() == 1072
    assert sum(c["count"] for c in row["confusion"]) == 1072
    path = str(tmp_path / "model")
    run.model.write().save(path)
    again = PipelineModel.load(path).transform(legs(spark, small).filter("cancelled = 0 and carrier is not null"))
    assert again.filter(F.col("probability").isNull()).isEmpty()


def test_onehot_run_reads_csv(spark, small, tmp_path):
    from checks.legs import as_flights

    path = str(tmp_path / "csv")
    as_flights(legs(spark, small)).write.option("header", True).option("nullValue", "NA").csv(path)
    config = OneHotConfig(input=path, start_year=1995, periods=PERIODS, output=str(tmp_path / "out"), weight_scope="all")
    run = run_onehot(spark, config)
    row = run.document.first()
    assert row["train_rows"] + row["test_rows"] == 2529 + 1072 and row["auc"] > 0.5
    assert set(run.written) == {"metrics", "confusion", "model"}
    assert row["weights"]["bias"] is not None and len(row["weights"]) > 40


@pytest.mark.parametrize("mode", ["baseline", "weighted"])
def test_onehot_training_rows_are_staged_nameless(spark, small, monkeypatch, mode):
    seen = []

    def fit(self, dataset):
        seen.append(dataset)
        return whole(self, dataset)

    whole = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", fit)
    config = OneHotConfig(roles=ROLES, periods=PERIODS, start_year=START_YEAR, mode=mode, max_iter=3)
    run = run_onehot(spark, config, legs(spark, small))
    (rows,) = seen
    assert rows.schema["features"].metadata == {} and all("/encoded-" in name for name in rows.inputFiles())
    # the same model as from the stages as they are
    cleaned = mark_parts(clean_legs(legs(spark, small), ROLES, START_YEAR, PERIODS), {"train": 0.8, "test": 1 - 0.8}, 42)
    train = add_class_weight(cleaned.filter("part = 'train'"), run.document.first()["positive_weight"])
    weight = "weight" if mode == "weighted" else None
    plain = onehot_logit_stages(ROLES.categorical, ROLES.numeric, weight, 3).fit(train).stages[-1]
    learnt = run.model.stages[-1]
    assert learnt.intercept == pytest.approx(plain.intercept)
    assert learnt.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), rel=1e-6, abs=1e-9)


def test_tasks_of_onehot_training_do_not_grow_with_labels(spark, monkeypatch):
    seen = []

    def fit(self, dataset):
        seen.append(dataset)
        return whole(self, dataset)

    whole = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", fit)
    stages = onehot_logit_stages(["word"], ["size"], max_iter=1)
    for labels in (20, 4000):
        rows = spark.range(8000).selectExpr(f"concat('w', id % {labels}) as word", "id % 7 as size", "cast(id % 2 as int) as label")
        fit_onehot_logit(stages, rows)
    serializer = spark._jvm.org.apache.spark.SparkEnv.get().closureSerializer().newInstance()
    tag = spark._jvm.scala.reflect.ClassTag.Any()
    few, many = (serializer.serialize(rows._jdf.rdd(), tag).limit() for rows in seen)
    assert abs(many - few) < 5000


def test_legs_shuffle_lines_once_and_take_dates_once(spark, small):
    lines = legs(spark, small)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum(line.count("as date)") for line in lines) == 1
    # orders meet customers before they meet lines
    depth = {name: next(line for line in lines if name in line and "Relation" in line).index("Relation") for name in ("l_orderkey", "o_orderkey", "c_custkey")}
    assert depth["l_orderkey"] < depth["o_orderkey"] == depth["c_custkey"]


def test_discard_leaves_no_staged_rows(spark, small):
    from pathlib import Path

    run = run_onehot(spark, OneHotConfig(roles=ROLES, periods=PERIODS, start_year=START_YEAR, max_iter=2), legs(spark, small))
    assert run.scratch and all(Path(p).exists() for p in run.scratch)
    paths = list(run.scratch)
    run.discard(spark)
    assert not any(Path(p).exists() for p in paths) and run.document.first()["model"] == "logistic_regression"


def test_bad_mode_and_missing_input(spark):
    with pytest.raises(ValueError, match="mode"):
        run_descent(spark, DescentConfig(mode="other"))
    with pytest.raises(ValueError, match="input"):
        run_onehot(spark, OneHotConfig())


@pytest.mark.parametrize("stop_on", ["auc", "loss"])
def test_tree_run(spark, small, stop_on):
    config = TreeConfig(roles=ROLES, periods=PERIODS, sample_fraction=0.9, rounds=4, depth=3, after_departure=True,
                        stop_on=stop_on, baseline_auc=0.5)
    run = run_trees(spark, config, legs(spark, small))
    assert 1 <= run.rounds_used <= 4
    assert run.importances.count() == 20
    assert {r["name"] for r in run.report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert run.comparison.first()["auc_gain"] == pytest.approx(run.document.first()["auc"] - 0.5)
    assert run.curve.count() > 2 and run.auc_by_round.count() == run.loss_by_round.count()
    row = run.document.first()
    # the share bounds what trees are grown on, not what is counted and measured
    assert row["train_rows"] + row["validation_rows"] + row["test_rows"] == labelled_legs(legs(spark, small), config).count()
    assert run.model.stages[-1].getNumTrees == run.rounds_used
    assert run.accounting.first()["total_rows"] == legs(spark, small).count()


def test_tree_model_is_the_measured_one(spark, small, tmp_path):
    config = TreeConfig(roles=ROLES, periods=PERIODS, rounds=6, depth=3, positive_weight=None, patience=1, output=str(tmp_path))
    raw = legs(spark, small)
    run = run_trees(spark, config, raw)
    assert {"report", "importances", "pr_curve", "auc_by_round", "loss_by_round", "model"} <= set(run.written)
    again = PipelineModel.load(run.written["model"])
    assert again.stages[-1].getNumTrees == run.rounds_used
    scored = run.scored.drop("features").persist()
    features = [c for c in scored.columns if c not in ("probability", "prediction")]
    rows = labelled_legs(raw, config)
    one, other = (positive_probability(m.transform(rows)).select("probability").agg(F.sum("probability")).first()[0] for m in (run.model, again))
    assert one == pytest.approx(other, abs=1e-9)
    assert scored.filter(F.col("probability").isNull()).isEmpty() and features
    whole = run.model.stages[-1]
    with pytest.raises(ValueError, match="rounds"):
        truncated(whole, whole.getNumTrees + 1)


def test_incomplete_rows_are_left_out_of_descent(spark):
    rows = [(1, 1.0), (0, -1.0), (1, None), (None, 2.0), (1, float("nan")), (1, 0.5), (0, -0.5)]
    df = spark.createDataFrame(rows, "label int, x double")
    model = GradientDescentLogit(["x"], maxIter=3).fit(df)
    clean = GradientDescentLogit(["x"], maxIter=3).fit(df.dropna().filter("not isnan(x)"))
    assert model.weights == pytest.approx(clean.weights) and model.scalars["skipped"] == 3 and model.scalars["rows"] == 4


def test_tree_feature_list():
    assert len(TREE_FEATURES) == 20 and TREE_FEATURES[0] == "year" and TREE_FEATURES[-1] == "month_delay_rate"


def test_boosted_rows_are_not_kept_in_memory(spark, small):
    from checks.queries import _boosted

    kept = spark.sparkContext._jsc.getPersistentRDDs
    before = len(kept())
    with _boosted(spark, small, rounds=1) as (_, test, _):
        assert len(kept()) == before
        assert "route" not in test.columns
