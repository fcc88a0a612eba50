import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from latemark.features import FrequencyEncoder, GroupMedianImputer, TargetMeanEncoder, ZScore
from latemark.operators import buckets, lookup_join
from latemark.operators.medians import exact_medians
from latemark.session import checkpointed


def test_frequency_counts_and_unseen(spark):
    train = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "c string, d int")
    test = spark.createDataFrame([("b", 1), ("z", 2), (None, 3)], "c string, d int")
    model = FrequencyEncoder(["c", "d"]).fit(train)
    assert sorted(tuple(r) for r in model.transform(test).collect()) == [(0, 0), (0, 2), (1, 1)]
    assert model.transform(train).columns == ["c_freq", "d_freq"]


def test_target_mean_falls_back_to_the_overall_mean(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "c string, label int")
    model = TargetMeanEncoder(["c"]).fit(train)
    found = model.transform(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string"))
    assert {r["c"]: r["c_delay_rate"] for r in found.collect()} == {"a": 0.5, "b": 0.0, "z": 0.5, None: 0.5}


def test_median_is_the_lower_one_with_fallback(spark):
    rows = [("r", float(v)) for v in (1, 2, 3, 4)] + [("s", 9.0), ("t", None)]
    train = spark.createDataFrame(rows, "route string, v double")
    model = GroupMedianImputer(["v"]).fit(train)
    test = spark.createDataFrame([("r", None), ("r", 7.0), ("t", None), ("new", None)], "route string, v double")
    assert [r["v_clean"] for r in model.transform(test).collect()] == [2.0, 7.0, 3.0, 3.0]


def test_scale_of_constant_and_single_rows_is_one(spark):
    one = spark.createDataFrame([(5.0, None)], "x double, y double")
    assert ZScore(["x", "y"]).fit(one).parameters == {"x": (5.0, 1.0), "y": (0.0, 1.0)}
    same = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert ZScore(["x"]).fit(same).transform(same).first()["x"] == 0.0


def test_encoders_keep_every_row(kept_clean):
    train = kept_clean.filter("year < 2000")
    for stage in (FrequencyEncoder(["carrier", "dest_id"]), TargetMeanEncoder(["carrier", "dest_id"])):
        assert stage.fit(train).transform(kept_clean).count() == kept_clean.count()


def test_encoders_survive_saving_in_a_pipeline(spark, kept_clean, tmp_path):
    stages = [
        TargetMeanEncoder(["dest_id"]), FrequencyEncoder(["carrier"]), ZScore(["distance", "carrier_freq"]),
        GroupMedianImputer(["taxi_out"], keyCol="origin_id"),
    ]
    model = Pipeline(stages=stages).fit(kept_clean)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    before, after = model.transform(kept_clean), again.transform(kept_clean)
    assert before.columns == after.columns
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


@pytest.fixture()
def skewed(spark):
    """A third of the rows on key 1, a third identical in every column, some keys null."""
    hot = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    equal = spark.range(3000).select(F.lit(2).alias("k"), F.lit(0).cast("bigint").alias("v"))
    rest = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 700 + 3).cast("int").alias("k"), F.col("id").alias("v"))
    return hot.unionAll(equal).unionAll(rest)


def test_lookup_gives_the_same_rows_either_way(skewed):
    table = skewed.filter("k is not null and k != 9").groupBy("k").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("v").alias("total"), F.max("v").alias("top")
    )
    size, total = table.count(), table.agg(F.sum("rows")).first()[0]
    args = (skewed, table, "k", ["total", "top"], size, total)
    small, large = lookup_join(*args), lookup_join(*args, broadcast_rows=0)
    assert small.columns == large.columns and small.count() == skewed.count()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_hot_keys_do_not_share_a_task(skewed, spark):
    """Shuffled join: hot, equal and null-keyed rows are spread over the partitions."""
    table = skewed.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("s"))
    rows = skewed.repartition(16)

    def largest_share(joined):
        placed = joined.groupBy(F.spark_partition_id().alias("p"))
        # the sum keeps the looked-up column, and with it the join, in the plan
        sizes = [r["n"] for r in placed.agg(F.count(F.lit(1)).alias("n"), F.sum("s")).collect()]
        return max(sizes) / sum(sizes)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = rows.join(table.hint("shuffle_merge"), "k", "left")
        spread = lookup_join(rows, table, "k", ["s"], table.count(), skewed.count(), broadcast_rows=0)
        assert largest_share(plain) > 0.33 and largest_share(spread) < 0.2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unseen_and_middling_keys_do_not_share_a_task(spark):
    """Half of the rows on a key that the table lacks, many keys just below a task's share."""
    unseen = spark.range(8000).select(F.lit(-1).alias("k"), F.col("id").alias("v"))
    middling = spark.range(8000).select((F.col("id") % 80).cast("int").alias("k"), F.col("id").alias("v"))
    rows = unseen.unionAll(middling).repartition(16)
    table = middling.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("s"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(rows, table, "k", ["s"], 80, 8000, broadcast_rows=0)
        placed = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("s")).collect()
        assert max(r["n"] for r in placed) < 2 * 16000 / 8
        assert joined.filter("k = -1 and s is not null").isEmpty() and joined.filter("k >= 0 and s is null").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_shuffled_lookup_reads_only_what_is_asked_for(spark, tmp_path):
    wide = spark.range(1000).select((F.col("id") % 50).cast("int").alias("k"), *[(F.col("id") * i).alias(f"c{i}") for i in range(6)])
    wide.write.parquet(str(tmp_path / "wide"))
    rows = spark.read.parquet(str(tmp_path / "wide"))
    table = wide.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.max("c1").alias("top"))
    joined = lookup_join(rows, table, "k", ["top"], 50, 1000, broadcast_rows=0).select("k", "top")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # the location may be cut short in the plan; the rows are the only files that it reads
    schemas = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "FileScan" in line]
    assert schemas and all(schema.count(":") <= 2 for schema in schemas)


def test_all_keys_are_counted_before_any_join(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.col("id"), *[F.when(F.col("id") % 11 > 0, F.col("id") % (50 + k)).alias(f"k{k}") for k in range(4)],
        (F.col("id") % 3 == 0).cast("int").alias("label"),
    )
    keys = [f"k{k}" for k in range(4)]
    model = TargetMeanEncoder(keys, [f"{k}_rate" for k in keys], "label").fit(rows)
    small = model.transform(rows).collect()
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    monkeypatch.setattr("latemark.operators.lookup.checkpointed", seen)
    model.broadcast_rows = 0
    large = model.transform(rows)
    counting = [p for p in plans if "Expand" in p]
    assert len(counting) == 1 and "Join" not in counting[0] and len(plans) == 1
    assert sorted(map(str, large.collect())) == sorted(map(str, small))


def test_imputer_keeps_its_accuracy(spark, tmp_path):
    imputer = GroupMedianImputer(["v"], keyCol="k", accuracy=77)
    imputer.write().save(str(tmp_path / "imputer"))
    again = GroupMedianImputer.load(str(tmp_path / "imputer"))
    assert again.getOrDefault(again.accuracy) == 77


def test_small_table_is_broadcast_and_large_is_not(skewed):
    table = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    table = table.withColumn("x", F.col("rows"))

    def plan(**options):
        joined = lookup_join(skewed, table, "k", ["x"], 10, 9000, **options)
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "SortMergeJoin" not in plan() and "SortMergeJoin" in plan(broadcast_rows=5)


@pytest.mark.parametrize("whole_group, rows_per_bucket, intervals", [(100_000, 1, 1), (0, 1_000_000, 1024), (0, 3, 8), (50, 1, 1024)])
def test_medians_are_exact_for_any_bucketing(spark, monkeypatch, whole_group, rows_per_bucket, intervals):
    """A third of the rows on one key, nulls and NaN left out, whole numbers stay whole."""
    monkeypatch.setattr("latemark.operators.medians.WHOLE_GROUP", whole_group)
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", rows_per_bucket)
    monkeypatch.setattr(buckets, "INTERVALS", intervals)
    drawn = random.Random(7)
    rows = [
        (
            None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{i % 40}",
            None if i % 7 == 0 else float("nan") if i % 11 == 0 else drawn.choice([-0.0, 0.0, drawn.gauss(0, 10), 1e9 + i]),
            None if i % 40 == 1 else drawn.randrange(-5, 30),
        )
        for i in range(3000)
    ]
    found = exact_medians(spark.createDataFrame(rows, "k string, x double, n int"), "k", ["x", "n"])
    assert dict(found.dtypes)["n_median"] == "int"
    told = {(r["_overall"], r["k"]): (r["rows"], r["x_median"], r["n_median"]) for r in found.collect()}

    def lower(values):
        values = sorted(v for v in values if v is not None and v == v)
        return values[(len(values) - 1) // 2] if values else None

    groups = {(0, k): [r for r in rows if r[0] == k] for k in {r[0] for r in rows}} | {(1, None): rows}
    assert told == {g: (len(m), lower(r[1] for r in m), lower(r[2] for r in m)) for g, m in groups.items()}


def test_medians_of_an_empty_table(spark):
    found = exact_medians(spark.createDataFrame([], "k string, x double"), "k", ["x"])
    assert [tuple(r) for r in found.collect()] == [(1, None, 0, None)]


def test_wide_table_of_few_rows_is_not_broadcast(skewed, monkeypatch):
    table = skewed.filter("k is not null").groupBy("k").agg(
        F.count(F.lit(1)).alias("rows"), F.repeat(F.lit("x"), 1000).alias("s")
    )
    size = table.count()

    def plan(**options):
        joined = lookup_join(skewed, table, "k", ["s"], size, 9000, **options)
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "SortMergeJoin" not in plan()
    monkeypatch.setattr("latemark.operators.lookup.BROADCAST_BYTES", 100_000)
    assert "SortMergeJoin" in plan() and "SortMergeJoin" in plan(table_bytes=200_000)
    assert "SortMergeJoin" not in plan(table_bytes=90_000)
    whole = lookup_join(skewed, table, "k", ["s"], size, 9000)
    assert whole.filter("k is not null and s is null").isEmpty() and whole.count() == skewed.count()


def test_fitted_tables_know_their_bytes(skewed, tmp_path, monkeypatch):
    named = skewed.withColumn("name", F.concat(F.lit("name-"), F.col("k").cast("string")))
    model = TargetMeanEncoder(["name", "k"], ["a", "b"], "v").fit(named)
    sizes = {k: t.table_bytes for k, t in model.lookups.items()}
    assert sizes["name"] > sizes["k"] > 8 * model.lookups["k"].table_rows
    model.write().save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model"))
    assert {k: t.table_bytes for k, t in again.lookups.items()} == sizes
    monkeypatch.setattr("latemark.operators.lookup.BROADCAST_BYTES", sizes["k"])
    assert again.lookups["k"].fits(10_000) and not again.lookups["name"].fits(10_000)
    assert again.transform(named).exceptAll(model.transform(named)).isEmpty()
