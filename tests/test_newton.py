import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.legs import PERIODS, ROLES, legs
from latemark.plans import TreeConfig, run_trees
from latemark.plans.trees import labelled_legs
from latemark.training import NewtonTrees, NewtonTreesModel
from latemark.training.newton import Tree, best_splits, binned, cut_points


@pytest.fixture(scope="module")
def rows(spark):
    """Two steps in x decide, missing x is mostly late, y is noise."""
    frame = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 37).cast("double").alias("x"),
        (F.xxhash64("id") % 50).cast("double").alias("y"), F.col("id"),
    )
    late = F.when(F.col("x").isNull(), F.col("id") % 4 != 0).when(F.col("x") <= 11, F.col("id") % 5 == 0).otherwise(F.col("x") <= 25)
    frame = frame.withColumn("label", late.cast("int")).withColumn("weight", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    return frame.withColumn("held", F.col("id") % 7 == 3).persist()


def brute_first_split(points, penalty=1.0, least=1.0):
    """The best (gain, feature, cut, missing left) over every value, from sums over rows."""
    best = (0.0, None)
    for feature in (0, 1):
        values = sorted({p[feature] for p in points if p[feature] is not None})[:-1]
        for cut in values:
            for missing_left in (False, True):
                sides = {True: [0.0, 0.0], False: [0.0, 0.0]}
                for p in points:
                    left = missing_left if p[feature] is None else p[feature] <= cut
                    sides[left][0] += (0.5 - p[2]) * p[3]
                    sides[left][1] += 0.25 * p[3]
                (gl, hl), (gr, hr) = sides[True], sides[False]
                if min(hl, hr) >= least:
                    gain = gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - (gl + gr) ** 2 / (hl + hr + penalty)
                    if round(gain, 6) > best[0]:
                        best = (round(gain, 6), (feature, cut, missing_left, -gl / (hl + penalty), -gr / (hr + penalty)))
    return best


def test_first_split_equals_brute_force(spark, rows):
    points = [(r["x"], r["y"], r["label"], r["weight"]) for r in rows.collect()]
    gain, (feature, cut, missing_left, left, right) = brute_first_split(points)
    model = NewtonTrees(["x", "y"], weightCol="weight", maxIter=1, depth=1, stepSize=1.0, rowShare=1.0, featureShare=1.0).fit(rows)
    tree = model.trees[0]
    split = model.splits(spark).first()
    assert (split["feature"], split["cut"], split["gain"]) == ("xy"[feature], cut, gain) and bool(tree.missing_left[0]) == missing_left
    assert tree.value[1] == pytest.approx(left) and tree.value[2] == pytest.approx(right)
    scored = model.transform(rows).select("x", "probability").distinct().collect()
    for r in scored:
        goes = missing_left if r["x"] is None else r["x"] <= cut
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-(left if goes else right))))


def test_learns_saves_and_loads(spark, rows, tmp_path):
    trees = NewtonTrees(["x", "y"], weightCol="weight", validationCol="held", maxIter=25, depth=3, stepSize=0.3)
    model = trees.fit(rows)
    assert model.scalars["auc"][model.scalars["rounds"] - 1] == max(model.scalars["auc"]) > 0.9
    gains = {r["feature"]: r["importance"] for r in model.gains(spark).collect()}
    assert gains["x"] > 0.9 and sum(gains.values()) == pytest.approx(1)
    model.save(str(tmp_path / "model"))
    again = NewtonTreesModel.load(str(tmp_path / "model"))
    both = model.transform(rows).select("id", "probability").join(again.transform(rows).select("id", F.col("probability").alias("p")), "id")
    assert both.filter("probability <> p").count() == 0 and both.count() == 4000


def test_does_not_depend_on_partitions(spark, rows):
    trees = NewtonTrees(["x", "y"], maxIter=6, depth=3, stepSize=0.3, rowShare=0.6, featureShare=0.5)
    one, many = (trees.fit(rows.repartition(n)).trees for n in (1, 7))
    for a, b in zip(one, many, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value)
        assert len({f for f in a.feature if f >= 0}) == 1  # one of two features is drawn for a tree
    every = NewtonTrees(["x", "y"], maxIter=6, depth=3, stepSize=0.3, rowShare=1.0, featureShare=0.5).fit(rows).trees
    assert any(not np.allclose(a.value, b.value) for a, b in zip(one, every))


def test_stops_when_auc_no_longer_rises(spark, rows):
    turned = rows.withColumn("label", F.when(F.col("held"), 1 - F.col("label")).otherwise(F.col("label")))
    model = NewtonTrees(["x"], validationCol="held", maxIter=40, depth=2, patience=3, rowShare=1.0, featureShare=1.0).fit(turned)
    curve = [r["auc"] for r in model.curve(spark).orderBy("round").collect()]
    best = model.scalars["rounds"]
    assert len(curve) < 40 and len(curve) == best + 3 and curve[best - 1] == max(curve)


def test_more_rounds_than_one_lineage(spark, rows):
    few = rows.limit(400).persist()
    model = NewtonTrees(["x"], maxIter=23, depth=1, rowShare=1.0, featureShare=1.0).fit(few)
    assert len(model.trees) == 23


def test_awkward_rows(spark):
    schema = "x double, label int, weight double"
    none = NewtonTrees(["x"], weightCol="weight", maxIter=3).fit(spark.createDataFrame([], schema))
    odd = spark.createDataFrame([(None, 1, 1.0), (float("nan"), None, 1.0), (1.0, 0, None), (2.0, 1, 1.0)] * 9, schema)
    assert none.transform(odd).filter("probability <> 0.5").count() == 0
    one = NewtonTrees(["x"], weightCol="weight", maxIter=2, stepSize=1.0, rowShare=1.0).fit(odd)
    # nothing to split on; the leaf leans to the only label that counts
    assert one.trees[0].feature[0] == -1 and one.transform(odd).filter("probability <= 0.5").count() == 0
    with pytest.raises(ValueError):
        NewtonTrees(["x"], bins=300).fit(odd)


def test_bins_and_cuts(spark):
    assert binned(np.array([np.nan, 1.0, 1.5, 2.0, 9.0]), [1.0, 2.0]).tolist() == [0, 1, 2, 2, 3]
    frame = spark.range(5000).select((F.col("id") % 3).alias("few"), F.col("id").alias("many"), F.lit(None).cast("double").alias("none"))
    few, many, none = cut_points(frame, ["few", "many", "none"], 16)
    assert few == [0.0, 1.0] and none == [] and len(many) <= 15 and 200 < many[0] < 500
    assert best_splits(np.zeros((2, 1, 1, 4)), np.array([0]), [[1.0, 2.0]], 1.0, 1.0) == [None]
    assert Tree.empty(2).nodes(np.zeros((1, 3), np.uint8)).tolist() == [0, 0, 0]


def test_job_with_second_order_trees(spark, small, tmp_path):
    config = TreeConfig(
        roles=ROLES, periods=PERIODS, rounds=5, depth=3, positive_weight=None, second_order=True, after_departure=True,
        output=str(tmp_path), baseline_auc=0.5,
    )
    raw = legs(spark, small)
    run = run_trees(spark, config, raw)
    row = run.document.first()
    assert row["optimizer"] == "second-order gradient boosting" and row["max_iter"] == run.rounds_used <= 5
    assert run.importances.count() == 20 and run.loss_by_round is None and "loss_by_round" not in run.written
    curve = [r["auc"] for r in run.auc_by_round.orderBy("round").collect()]
    assert curve[run.rounds_used - 1] == max(curve)
    again = PipelineModel.load(run.written["model"])
    rows = labelled_legs(raw, config)
    one, other = (m.transform(rows).agg(F.sum("probability")).first()[0] for m in (run.model, again))
    assert one == pytest.approx(other)
    with pytest.raises(ValueError):
        run_trees(spark, TreeConfig(roles=ROLES, periods=PERIODS, second_order=True, stop_on="loss", positive_weight=None), raw)


def test_tasks_hold_one_block_at_a_time(spark):
    """Blocks of a partition are read one after the other, not as one batch that grows with it."""
    from latemark.training.newton import _opened, _packer

    rows = spark.range(50_000, numPartitions=1).selectExpr("cast(id % 2 as double) l", "1.0D w", "id d", "cast(id % 9 as double) f")
    blocks = rows.mapInArrow(_packer([[float(i) for i in range(8)]], False), "block binary, rows bigint")
    assert sum(r["rows"] for r in blocks.collect()) == 50_000 and blocks.count() >= 5
    state = iter([(bytes(r["block"]), bytes(8 * r["rows"])) for r in blocks.collect()])
    _, (bins, label, weight, draw), margin = next(_opened(state))
    assert bins.shape[1] == len(label) == len(weight) == len(margin) <= 10_000 and draw is None
    assert len(list(state)) == blocks.count() - 1


def test_nodes_are_those_of_a_walk_row_by_row():
    import numpy as np

    from latemark.training.newton import Tree

    tree = Tree.empty(3)
    for node, feature, cut, missing in ((0, 1, 4, True), (2, 0, 2, False), (5, 1, 9, True), (1, 0, 0, False)):
        tree.feature[node], tree.cut[node], tree.missing_left[node] = feature, cut, missing
    bins = np.random.default_rng(1).integers(0, 12, (2, 500)).astype(np.uint8)

    def walk(row):
        node = 0
        while tree.feature[node] >= 0:
            own = bins[tree.feature[node], row]
            node = 2 * node + 2 - bool(tree.missing_left[node] if own == 0 else own <= tree.cut[node])
        return node

    assert tree.nodes(bins).tolist() == [walk(i) for i in range(500)]
    assert not Tree.empty(3).nodes(bins).any()
