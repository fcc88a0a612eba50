import pytest

from latemark.features import OutOfFoldTargetMeanEncoder, TargetMeanEncoder

SCHEMA = "i int, k string, g int, label int"


def rows(spark):
    made = [(i, None if i % 13 == 0 else "hot" if i % 3 == 0 else f"k{i % 17}", i % 4, None if i % 29 == 0 else int(i % 5 < 2)) for i in range(600)]
    return made, spark.createDataFrame(made, SCHEMA).repartition(4)


def encoder(smoothing=5.0):
    return OutOfFoldTargetMeanEncoder(["k", "g"], ["k_rate", "g_rate"], foldCols=["i"], folds=3, smoothing=smoothing)


@pytest.mark.parametrize("smoothing", [5.0, 0.0])
def test_a_row_never_sees_the_labels_of_its_fold(spark, smoothing):
    made, df = rows(spark)
    model = encoder(smoothing).fit(df)
    fold = {r["i"]: r["f"] for r in df.select("i", model._fold().alias("f")).collect()}
    assert set(fold.values()) == {0, 1, 2}
    for r in model.transform_training(df).collect():
        others = [m for m in made if m[3] is not None and fold[m[0]] != fold[r["i"]]]
        prior = sum(m[3] for m in others) / len(others)
        for place, key in ((1, "k"), (2, "g")):
            same = [m[3] for m in others if r[key] is not None and m[place] == r[key]]
            n = len(same) + smoothing
            assert r[f"{key}_rate"] == pytest.approx((sum(same) + smoothing * prior) / n if n else prior)


def test_new_rows_and_saved_model(spark, tmp_path):
    made, df = rows(spark)
    model = encoder().fit(df)
    model.write().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    known = [m for m in made if m[3] is not None]
    prior = sum(m[3] for m in known) / len(known)
    hot = [m[3] for m in known if m[1] == "hot"]
    new = spark.createDataFrame([(1, "hot", 0, None), (2, "new", 99, None), (3, None, None, None)], SCHEMA)
    for one in (model, again):
        one.broadcast_rows = 0
        told = {r["i"]: (r["k_rate"], r["g_rate"]) for r in one.transform(new).collect()}
        assert told[1][0] == pytest.approx((sum(hot) + 5 * prior) / (len(hot) + 5))
        assert told[2] == told[3] == pytest.approx((prior, prior))


def test_too_few_folds(spark):
    with pytest.raises(ValueError, match="two folds"):
        OutOfFoldTargetMeanEncoder(["k"], foldCols=["i"], folds=1).fit(rows(spark)[1])


def test_large_tables_are_joined_before_small_ones(spark):
    """A row is shuffled as it came, without what broadcast tables add; columns stay in the order of the keys."""
    train = spark.createDataFrame([(i % 3, i, i % 2) for i in range(40)], "few int, many int, label int")
    model = TargetMeanEncoder(["few", "many"]).fit(train)
    before = model.transform(train)
    model.broadcast_rows = 10
    after = model.transform(train)
    assert after.columns == before.columns
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, before.collect()))
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]  # outermost first
    assert "few#" in joins[0] and any("_cold_key" in line for line in joins[1:])
