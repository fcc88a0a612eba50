from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from latemark.features import RankedIndexer, ranked_labels
from latemark.training.builtin import encoding_stages


def test_places_are_those_of_the_built_in_indexer(spark, kept_clean):
    keys = ["carrier", "origin_id", "dest_id", "sched_hhmm"]
    outputs = [f"{k}_index" for k in keys]
    built_in = StringIndexer(inputCols=keys, outputCols=outputs, handleInvalid="keep").fit(kept_clean)
    own = RankedIndexer(keys, outputs).fit(kept_clean)
    told = [m.transform(kept_clean).select(*keys, *outputs).distinct() for m in (built_in, own)]
    assert told[0].exceptAll(told[1]).isEmpty() and told[1].exceptAll(told[0]).isEmpty()


def test_places_are_gapless_over_many_tasks(spark):
    """200,000 categories, most of them ties: no two share a place and none is left out."""
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 200_000)).alias("c"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("d"),
    )
    ranked = ranked_labels(rows, ["c", "d"]).cache()
    told = ranked.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("place").alias("places"), F.min("place").alias("least"), F.max("place").alias("last"),
    )
    for r in told.collect():
        assert (r["n"], r["least"]) == (r["places"], 0) and r["last"] == r["n"] - 1
    assert ranked.filter((F.col("feature") == "c") & (F.col("place") == 0)).first()["category"] == "hot"
    left = ranked.select("feature", F.col("place").alias("p"), F.col("rows").alias("r"), F.col("category").alias("g"))
    right = ranked.select("feature", (F.col("place") - 1).alias("p"), "rows", "category")
    turned = left.join(right, ["feature", "p"]).filter(
        (F.col("r") < F.col("rows")) | ((F.col("r") == F.col("rows")) & (F.col("g") >= F.col("category")))
    )
    assert turned.isEmpty()


def test_unseen_null_and_saved(spark, tmp_path):
    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)], "c string, x double")
    test = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("z", 2.0), (None, 3.0)], "c string, x double")
    model = Pipeline(stages=encoding_stages(["c"], ["x"], by_lookup=True)).fit(train)
    model.write().save(str(tmp_path / "m"))
    for one in (model, PipelineModel.load(str(tmp_path / "m"))):
        found = {r["c"]: (r["c_index"], r["features"].toArray().tolist()) for r in one.transform(test).collect()}
        assert found == {
            "a": (0.0, [1.0, 0.0, 0.0]), "b": (1.0, [0.0, 1.0, 1.0]), "z": (2.0, [0.0, 0.0, 2.0]), None: (2.0, [0.0, 0.0, 3.0]),
        }


def test_columns_without_any_category(spark):
    nothing = spark.createDataFrame([(None,)], "c string")
    assert RankedIndexer(["c"]).fit(nothing).transform(nothing).first()["c_index"] == 0.0
