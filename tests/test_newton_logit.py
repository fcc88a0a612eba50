import numpy as np
import pytest

from latemark.training import NewtonLogit


def drawn(spark, scale=1.0):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 3)) * [1.0, 1000.0 * scale, 0.001]
    p = 1 / (1 + np.exp(-(0.4 + x @ [1.0, 0.002 / scale, -700.0])))
    y = (rng.random(2000) < p).astype(float)
    w = rng.uniform(0.5, 3.0, 2000)
    rows = [(*map(float, a), float(b), float(c)) for a, b, c in zip(x, y, w)]
    return x, y, w, spark.createDataFrame(rows, "a double, b double, c double, label double, w double").repartition(5)


def test_gradient_is_zero_at_the_optimum(spark):
    x, y, w, rows = drawn(spark)
    model = NewtonLogit(["a", "b", "c"], weightCol="w").fit(rows)
    err = w * (1 / (1 + np.exp(-(x @ model.weights + model.bias))) - y)
    assert abs(err.sum()) < 1e-6 and np.abs(x.T @ err / [1, 1000, 0.001]).max() < 1e-6
    assert model.scalars["iterations"] < 15


def test_penalty_leaves_the_bias_alone(spark):
    x, y, _, rows = drawn(spark)
    model = NewtonLogit(["a"], regParam=0.3).fit(rows)
    err = 1 / (1 + np.exp(-(x[:, 0] * model.weights[0] + model.bias))) - y
    assert abs(err.sum()) < 1e-6
    assert abs(x[:, 0] @ err + 0.3 * len(y) * model.weights[0]) < 1e-6


def test_equal_and_constant_features(spark):
    """Features that repeat each other share the weight; the prediction is that of one."""
    _, _, _, rows = drawn(spark)
    one = NewtonLogit(["a"]).fit(rows)
    two = NewtonLogit(["a", "again"]).fit(rows.withColumn("again", rows["a"]))
    assert two.weights == pytest.approx([one.weights[0] / 2] * 2)
    constant = NewtonLogit(["a", "k"]).fit(rows.selectExpr("*", "1.0D AS k"))
    assert constant.weights[0] == pytest.approx(one.weights[0])
    assert constant.weights[1] + constant.bias == pytest.approx(one.bias)


def test_incomplete_rows_are_left_out_and_counted(spark):
    rows = spark.createDataFrame(
        [(1.0, 1), (2.0, 0), (0.5, 0), (3.0, 1), (None, 1), (float("nan"), 0), (1.0, None)], "a double, label int"
    )
    model = NewtonLogit(["a"]).fit(rows)
    assert (model.scalars["rows"], model.scalars["skipped"]) == (4, 3)
    with pytest.raises(ValueError, match="no training rows"):
        NewtonLogit(["a"]).fit(rows.limit(0))


def test_separable_rows_end(spark):
    rows = spark.createDataFrame([(float(i), int(i > 5)) for i in range(10)], "a double, label int")
    model = NewtonLogit(["a"]).fit(rows)
    assert model.scalars["iterations"] <= 25 and model.weights[0] > 1
