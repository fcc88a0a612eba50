"""The registered queries: every operator over whole tables of legs.

Each takes (spark, folder of the tables). Computed doubles are rounded to six places, so
that the order in which an engine adds numbers does not show.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.legs import (
    IMPUTED, LEG_TYPES, PERIODS, ROLES, START_YEAR, as_flights, cleaned, legs,
)
from latemark import operators as ops
from latemark.evaluation import (
    average_precision, best_round, binary_metrics, classification_report, compare_models,
    confusion_matrix, feature_importances, loss_curve, metrics_document, pr_curve,
    rank_statistics, ranking_metrics, roc_auc, training_curve,
)
from latemark.evaluation.curves import feature_names
from latemark.features import (
    FrequencyEncoder, GroupMedianImputer, OutOfFoldTargetMeanEncoder, TargetMeanEncoder, ZScore,
)
from latemark.features.vectors import hot_slot, vector_slot, vector_sum, vector_width
from latemark.functions import route_key
from latemark.plans import DescentConfig, OneHotConfig, TreeConfig, run_descent, run_onehot, run_trees
from latemark.plans.common import measured
from latemark.plans.onehot import positive_probability
from latemark.plans.trees import LABEL, fit_encoders, labelled_legs, rate_columns, tree_features
from latemark.session import held, scratch_path
from latemark.sources import (
    load_model, malformed_entries, quarantined_legs, read_legs, read_metrics, read_sample, read_staged, restaged, save_model, stage_legs,
    write_confusion, write_metrics, write_predictions, write_sample,
)
from latemark.evaluation.documents import DOCUMENT_SCHEMA
from latemark.training import (
    GradientDescentLogit, NewtonLogit, NewtonTrees, class_weight, first_trees, fit_onehot_logit, gbt_stages, onehot_logit_stages, score_linear,
)
from latemark.training.builtin import encoding_stages
from latemark.training.descent import RowBlocks
from latemark.training.weights import positive_weight

Query = Callable[[SparkSession, str], DataFrame]

RATIO, SEED = 0.8, 42
STEPS, RATE = 100, 0.1
CATEGORICAL, NUMERIC = list(ROLES.categorical), list(ROLES.numeric)
FREQUENCIES = [f"{c}_freq" for c in CATEGORICAL]
FEATURES = [*NUMERIC, *FREQUENCIES]
RATES = rate_columns(ROLES)
FIXED_WEIGHTS = [0.1, -0.2, 0.05, 0.0, 0.3, -0.1, 0.02, 0.2, -0.05, 0.15]
FIXED_BIAS = -0.4

REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


def r6(name: str | Column, alias: str | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return (F.round(column, 6) + F.lit(0.0)).alias(alias or name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round the named columns, or every double column."""
    chosen = names or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.select(*[r6(c) if c in chosen else F.col(c) for c in df.columns])


def only_ok(spark: SparkSession, ok: bool) -> DataFrame:
    return spark.createDataFrame([(bool(ok),)], "ok boolean")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned legs written once, for queries that pass over them more than once."""
    return restaged(cleaned(spark, sf_dir), "cleaned")


def split_legs(spark: SparkSession, sf_dir: str):
    return ops.temporal_split(staged(spark, sf_dir), "year", RATIO)


def by_clock(spark: SparkSession, sf_dir: str, passes: int = 1) -> DataFrame:
    """Cleaned legs scored by their departure time: many ties, some signal."""
    score = F.col("sched_hhmm") / F.lit(2400.0)
    rows = cleaned(spark, sf_dir) if passes == 1 else staged(spark, sf_dir)
    return rows.select(
        "label", score.alias("probability"), (score >= 0.5).cast("int").alias("prediction")
    )


# ---- sources and sinks -------------------------------------------------------------

@query
def read_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "legs-csv")
    backwards = [F.col(c).alias(c.upper()) for c in reversed(LEG_TYPES)]
    (
        legs(spark, sf_dir).select(*backwards).write
        .option("header", True).option("nullValue", "NA").csv(path)
    )
    return rounded(read_legs(spark, path, types=LEG_TYPES))


@query
def read_csv_decimal_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers written as ``7.0``, as exports of float columns have them."""
    path = scratch_path(spark, "legs-decimal")
    written = [
        (F.concat(F.col(c).cast("string"), F.lit(".0")) if kind in ("int", "bigint") else F.col(c)).alias(c)
        for c, kind in LEG_TYPES.items()
    ]
    legs(spark, sf_dir).select(*written).write.option("header", True).option("nullValue", "NA").csv(path)
    return rounded(read_legs(spark, path, types=LEG_TYPES))


@query
def malformed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that do not fit: every fifth supplier number gets a fraction, some days a word."""
    return malformed_entries(spark, _spoilt(spark, sf_dir), types=LEG_TYPES)


def _spoilt(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "legs-malformed")
    spoilt = legs(spark, sf_dir).select(*LEG_TYPES).withColumns({
        "origin_id": F.when(F.col("origin_id") % 5 == 0, F.col("origin_id") + 0.5).otherwise(F.col("origin_id")),
        "day": F.when(F.col("day") == 31, F.lit("last")).otherwise(F.col("day").cast("string")),
    })
    spoilt.write.option("header", True).option("nullValue", "NA").csv(path)
    return path


@query
def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry that does not fit, with what else its row tells."""
    rejected = quarantined_legs(spark, _spoilt(spark, sf_dir), types=LEG_TYPES).rejected
    return rounded(rejected.select(
        F.inline("misfits"), "year", "month", "day", "origin_id", "sched_hhmm", "distance",
        F.size(F.split("line", ",")).alias("entries"), F.contains("file", F.lit("legs-malformed")).alias("told_file"),
    ))


@query
def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quarantined_legs(spark, _spoilt(spark, sf_dir), types=LEG_TYPES).accepted)


@query
def read_csv_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flights-csv")
    flights = as_flights(legs(spark, sf_dir))
    flights.write.option("header", True).option("nullValue", "NA").csv(path)
    return rounded(read_legs(spark, path, strict=True))


@query
def staged_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "legs-staged")
    stage_legs(legs(spark, sf_dir), path)
    return read_staged(spark, path, [*LEG_TYPES]).groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sched_hhmm").alias("hhmm_sum"),
        F.count("delay").alias("delays"),
    )


@query
def sample_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sample")
    sample = ops.stratified_sample(staged(spark, sf_dir), "label", {0: 0.05, 1: 0.05}, SEED)
    write_sample(sample, path, "label")
    return rounded(read_sample(spark, path, sample))


def _clock_document(spark: SparkSession, sf_dir: str, **more) -> DataFrame:
    with held(by_clock(spark, sf_dir)) as scores:
        metrics, confusion = measured(scores)
        return metrics_document(
            spark, model="clock", mode="baseline", train_rows=0,
            test_rows=sum(n for *_, n in confusion), confusion=confusion, **metrics, **more,
        )


def _document_row(document: DataFrame) -> DataFrame:
    names = ("auc", "auc_desc_rank", "average_precision", "accuracy", "f1",
             "weighted_precision", "weighted_recall")
    cell = F.col("confusion")
    return document.select(
        "model", "mode", "test_rows", *[r6(n) for n in names],
        F.size(cell).alias("cells"), F.aggregate(
            cell, F.lit(0).cast("bigint"), lambda total, c: total + c["count"]
        ).alias("confusion_rows"),
    )


@query
def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_metrics(_clock_document(spark, sf_dir), scratch_path(spark, "run"), "baseline")
    return _document_row(read_metrics(spark, written, DOCUMENT_SCHEMA))


@query
def confusion_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = confusion_matrix(by_clock(spark, sf_dir))
    written = write_confusion(confusion, scratch_path(spark, "run"), "baseline")
    return spark.read.option("header", True).schema("label int, prediction int, count bigint").csv(written)


@query
def predictions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = write_predictions(by_clock(spark, sf_dir), scratch_path(spark, "run"), "baseline")
    return rounded(spark.read.parquet(written))


@query
def model_reload_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_legs(spark, sf_dir)
    stages = onehot_logit_stages(CATEGORICAL, NUMERIC)
    model = stages.fit(split.train)
    again = load_model(save_model(model, scratch_path(spark, "run"), "baseline"))
    first = positive_probability(model.transform(split.test)).select(
        *CATEGORICAL, *NUMERIC, F.col("probability").alias("before")
    )
    both = positive_probability(again.transform(first))
    return both.agg(
        ((F.max(F.abs(F.col("before") - F.col("probability"))) <= 1e-12) & (F.count(F.lit(1)) > 0)).alias("ok")
    )


# ---- cleaning and labels -----------------------------------------------------------

@query
def clean_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaned(spark, sf_dir))


@query
def exclude_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ops.exclude_periods(legs(spark, sf_dir), "year", "month", PERIODS)
    return kept.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sched_hhmm").alias("hhmm_sum")
    )


@query
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cleaning_report(legs(spark, sf_dir), ROLES, 1996, PERIODS)


@query
def label_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = ops.add_label(legs(spark, sf_dir), "delay", 15)
    return labelled.select("year", "month", "day", "origin_id", "dest_id", "delay", "label")


@query
def label_exclusive_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = ops.add_label(legs(spark, sf_dir), "delay", 15, inclusive=False, keep_unknown=True)
    return labelled.select("year", "month", "day", "origin_id", "dest_id", "delay", "label")


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_legs(spark, sf_dir)
    both = split.train.unionByName(split.test)
    return spark.createDataFrame(
        [("train", class_weight(split.train)), ("all", class_weight(both))], "scope string, weight double"
    ).select("scope", r6("weight"))


@query
def class_weight_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = split_legs(spark, sf_dir).train
    return ops.add_class_weight(train, class_weight(train)).groupBy("year", "label").agg(
        F.count(F.lit(1)).alias("rows"), r6(F.max("weight"), "weight"), r6(F.sum("weight"), "weight_sum")
    )


@query
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.add_calendar_features(legs(spark, sf_dir), ROLES).select(
        "year", "month", "day", "dayofweek", "sched_hhmm", "dep_hour", "dep_period",
        "is_weekend", "season", "route",
    )


@query
def route_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = F.when(F.col("carrier").isNotNull(), F.col("origin_id"))
    destination = F.when(F.col("dest_id") < 24, F.col("dest_id"))
    return legs(spark, sf_dir).select(route_key(origin, destination).alias("route")).groupBy("route").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _tree_parts(spark: SparkSession, sf_dir: str):
    rows = ops.add_calendar_features(staged(spark, sf_dir), ROLES).withColumnRenamed("label", LABEL)
    return ops.temporal_split(rows, "year", RATIO)


@query
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _tree_parts(spark, sf_dir)
    test = split.test
    for stage in fit_encoders(split.train, ROLES, IMPUTED):
        test = stage.transform(test)
    return rounded(ops.select_features(test, tree_features(ROLES), LABEL))


# ---- aggregates and encoders -------------------------------------------------------

@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.category_counts(cleaned(spark, sf_dir), CATEGORICAL)


@query
def delay_rates_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.add_calendar_features(cleaned(spark, sf_dir), ROLES)
    return rounded(ops.delay_rates(rows, list(RATES)))


@query
def group_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.add_calendar_features(legs(spark, sf_dir), ROLES)
    return rounded(ops.group_medians(rows, "route", IMPUTED))


@query
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.feature_stats(split_legs(spark, sf_dir).train, NUMERIC))


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.label_counts(cleaned(spark, sf_dir))


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.class_balance(cleaned(spark, sf_dir)))


@query
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_legs(spark, sf_dir)
    return ops.split_summary({"train": split.train, "test": split.test})


@query
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.distinct_years(cleaned(spark, sf_dir))


def _frequency(spark: SparkSession, sf_dir: str):
    split = split_legs(spark, sf_dir)
    return FrequencyEncoder(CATEGORICAL).fit(split.train), split


@query
def frequency_encode_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split = _frequency(spark, sf_dir)
    return rounded(model.transform(split.train))


@query
def frequency_encode_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split = _frequency(spark, sf_dir)
    return rounded(model.transform(split.test))


def _target_means(spark: SparkSession, sf_dir: str, broadcast_rows: int | None) -> DataFrame:
    split = _tree_parts(spark, sf_dir)
    model = TargetMeanEncoder(list(RATES), list(RATES.values()), LABEL).fit(split.train)
    if broadcast_rows is not None:
        model.broadcast_rows = broadcast_rows
    keys = ["year", "month", "day", "carrier", "origin_id", "dest_id", "sched_hhmm", "distance"]
    return rounded(model.transform(split.test).select(*keys, *RATES.values()))


@query
def target_mean_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_means(spark, sf_dir, None)


@query
def target_mean_encode_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as if no table were small enough to broadcast."""
    return _target_means(spark, sf_dir, 0)


FOLD_COLUMNS = ["year", "month", "day", "carrier", "origin_id", "dest_id", "sched_hhmm"]


def _out_of_fold(train: DataFrame):
    return OutOfFoldTargetMeanEncoder(list(RATES), list(RATES.values()), LABEL, foldCols=FOLD_COLUMNS).fit(train)


@query
def target_mean_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, rated without the rows of their own fold."""
    train = _tree_parts(spark, sf_dir).train
    return rounded(_out_of_fold(train).transform_training(train).select(*FOLD_COLUMNS, "distance", LABEL, *RATES.values()))


@query
def target_mean_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, rated by all training rows."""
    split = _tree_parts(spark, sf_dir)
    return rounded(_out_of_fold(split.train).transform(split.test).select(*FOLD_COLUMNS, "distance", *RATES.values()))


@query
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _tree_parts(spark, sf_dir)
    model = GroupMedianImputer(list(IMPUTED), keyCol="route").fit(split.train)
    return rounded(model.transform(split.test).select(
        "year", "month", "day", "route", "distance", *IMPUTED, "taxi_out_clean", "air_time_clean"
    ))


def _scaled(spark: SparkSession, sf_dir: str):
    """(scaled train, scaled test, late rows per on-time row in train)."""
    encoder, split = _frequency(spark, sf_dir)
    train = encoder.transform(split.train)
    scale = ZScore(FEATURES).fit(train)
    return scale.transform(train), scale.transform(encoder.transform(split.test))


@query
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _scaled(spark, sf_dir)
    return rounded(test.select(*FEATURES, "label"))


# ---- splits ------------------------------------------------------------------------

@query
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_legs(spark, sf_dir)
    return rounded(split.test).withColumn("first_test_year", F.lit(split.first_test_year))


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = ops.hash_split(cleaned(spark, sf_dir), RATIO, SEED)
    return rounded(test)


@query
def hash_three_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = {"train": 0.64, "validation": 0.16, "test": 0.2}
    marked = ops.mark_parts(cleaned(spark, sf_dir), shares, SEED)
    return marked.groupBy("part", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sched_hhmm").alias("hhmm_sum")
    )


@query
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ops.stratified_sample(cleaned(spark, sf_dir), "label", {0: 0.05, 1: 0.2}, SEED))


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = ops.stratified_split(staged(spark, sf_dir), "label", 0.2, SEED)
    return rounded(test)


@query
def split_parts_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test share no row and together hold every row, for both content splits."""
    rows = cleaned(spark, sf_dir)
    # both splits go by the same digest, which is taken once
    rows = restaged(rows.withColumn("_position", ops.content_position(rows.columns, SEED)), "cleaned")
    contents = [c for c in rows.columns if c != "_position"]
    splits = [
        ops.hash_split(rows, RATIO, SEED, contents, "_position"),
        ops.stratified_split(rows, "label", 0.2, SEED, contents, position="_position"),
    ]
    return only_ok(spark, _disjoint_and_whole(rows.drop("_position"), splits))


def _disjoint_and_whole(rows: DataFrame, splits: list[tuple[DataFrame, DataFrame]]) -> bool:
    """Whether the parts of each split are disjoint and hold every row as often as ``rows``.

    Equal rows of the whole and of all parts meet in one shuffle, where their copies are counted.
    """
    frames = [rows, *(part for split in splits for part in split)]
    tagged = [f.select(*rows.columns, F.lit(i).alias("_frame")) for i, f in enumerate(frames)]
    copies = reduce(DataFrame.unionAll, tagged).groupBy(*rows.columns).agg(
        *[F.count_if(F.col("_frame") == i).alias(f"_n{i}") for i in range(len(frames))]
    )
    wrong = F.lit(False)
    for i in range(1, len(frames), 2):
        train, test = F.col(f"_n{i}"), F.col(f"_n{i + 1}")
        wrong |= (train + test != F.col("_n0")) | ((train > 0) & (test > 0))
    return copies.filter(wrong).isEmpty()


# ---- gradient descent --------------------------------------------------------------

@query
def gradient_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _scaled(spark, sf_dir)
    with RowBlocks(train, FEATURES, "label") as blocks:
        sums = blocks.gradient_sums(FIXED_WEIGHTS, FIXED_BIAS)
        rows = [(n, s / blocks.rows) for n, s in zip([*FEATURES, "bias"], sums)]
    return rounded(spark.createDataFrame(rows, "feature string, slope double"))


def _descended(spark: SparkSession, sf_dir: str, weighted: bool):
    train, test = _scaled(spark, sf_dir)
    if weighted:
        train = ops.add_class_weight(train, class_weight(train))
    logit = GradientDescentLogit(
        FEATURES, weightCol="weight" if weighted else None, maxIter=STEPS, stepSize=RATE
    )
    return logit.fit(train), test


def _coefficients(spark: SparkSession, model) -> DataFrame:
    return rounded(spark.createDataFrame(list(model.coefficients.items()), "feature string, weight double"))


@query
def gd_weights_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, _descended(spark, sf_dir, False)[0])


@query
def gd_weights_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, _descended(spark, sf_dir, True)[0])


@query
def gd_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _scaled(spark, sf_dir)
    scored = score_linear(test, FEATURES, FIXED_WEIGHTS, FIXED_BIAS)
    return rounded(scored.select("label", "probability", "prediction"))


@query
def descent_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gradient-descent job, weighted: one row per metric."""
    config = DescentConfig(
        roles=ROLES, periods=PERIODS, start_year=START_YEAR, max_iter=STEPS, learning_rate=RATE,
        train_ratio=RATIO,
    )
    document = run_descent(spark, config, legs(spark, sf_dir)).document
    names = ["accuracy", "f1", "weighted_precision", "weighted_recall", "auc", "average_precision"]
    return document.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), r6(n, "value")) for n in names
    ])))


# ---- metrics -----------------------------------------------------------------------

@query
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(by_clock(spark, sf_dir))


@query
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(binary_metrics(by_clock(spark, sf_dir)))


@query
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(classification_report(by_clock(spark, sf_dir)))


@query
def roc_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(roc_auc(by_clock(spark, sf_dir, passes=2)))


@query
def roc_auc_fine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nearly tie-free score outside [0, 1]."""
    return rounded(roc_auc(staged(spark, sf_dir), score="distance"))


@query
def rank_sum_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank_statistics(by_clock(spark, sf_dir, passes=2)))


@query
def average_precision_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(average_precision(by_clock(spark, sf_dir, passes=2)))


@query
def pr_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pr_curve(by_clock(spark, sf_dir, passes=2)))


@query
def pr_curve_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pr_curve(staged(spark, sf_dir), score="distance", points=100))


@query
def ranking_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking_metrics(staged(spark, sf_dir), score="sched_hhmm", by=["carrier"]))


@query
def metrics_match_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own metrics against Spark's evaluators on the same predictions."""
    doubles = by_clock(spark, sf_dir, passes=2).withColumn("prediction", F.col("prediction").cast("double"))
    with held(doubles.withColumnRenamed("probability", "score")) as scores:
        metrics, _ = measured(scores.withColumnRenamed("score", "probability"))
        auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scores)
        pairs = [(metrics["auc"], auc)]
        for own, builtin in (
            ("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
            ("weighted_recall", "weightedRecall"),
        ):
            value = MulticlassClassificationEvaluator(metricName=builtin).evaluate(scores)
            pairs.append((metrics[own], value))
    return only_ok(spark, all(abs(a - b) < 1e-9 for a, b in pairs))


# ---- built-in models ---------------------------------------------------------------

def _encoded(spark: SparkSession, sf_dir: str):
    split = split_legs(spark, sf_dir)
    return Pipeline(stages=encoding_stages(CATEGORICAL, NUMERIC)).fit(split.train), split


@query
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, split = _encoded(spark, sf_dir)
    indexed = model.stages[0].transform(split.test)
    return indexed.groupBy("carrier", "dest_id", "origin_id").agg(
        *[F.max(f"{c}_index").alias(f"{c}_index") for c in CATEGORICAL], F.count(F.lit(1)).alias("rows")
    )


def _by_lookup(spark: SparkSession, sf_dir: str):
    split = split_legs(spark, sf_dir)
    return Pipeline(stages=encoding_stages(CATEGORICAL, NUMERIC, by_lookup=True)).fit(split.train), split


@query
def string_index_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same places from ranked tables, joined as if none were small enough to broadcast."""
    model, split = _by_lookup(spark, sf_dir)
    model.stages[0].broadcast_rows = 0
    indexed = model.stages[0].transform(split.test)
    return indexed.groupBy("carrier", "dest_id", "origin_id").agg(
        *[F.max(f"{c}_index").alias(f"{c}_index") for c in CATEGORICAL], F.count(F.lit(1)).alias("rows")
    )


@query
def one_hot_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of the 1 in the slots of every category, -1 for one not seen in training."""
    model, split = _by_lookup(spark, sf_dir)
    slots = [hot_slot(f"{c}_slots").alias(f"{c}_slot") for c in CATEGORICAL]
    hot = model.transform(split.test).select(*CATEGORICAL, *slots)
    return hot.groupBy(*hot.columns).agg(F.count(F.lit(1)).alias("rows"))


@query
def one_hot_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of the 1 in the encoded vector, -1 for a category not seen in training."""
    model, split = _encoded(spark, sf_dir)
    hot = model.transform(split.test)
    slots = [hot_slot(f"{c}_slots").alias(f"{c}_slot") for c in ("carrier", "dest_id")]
    return hot.select("carrier", "dest_id", *slots).groupBy("carrier", "dest_id", "carrier_slot", "dest_id_slot").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric slots of the assembled vector and the sum of its one-hot slots."""
    model, split = _encoded(spark, sf_dir)
    vector = model.transform(split.test).select("features")
    width = vector_width("features") - len(NUMERIC)
    tail = [r6(vector_slot("features", width + i), name) for i, name in enumerate(NUMERIC)]
    return vector.select(*tail, r6(vector_sum("features", width), "hot_slots"))


@query
def logit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_legs(spark, sf_dir)
    model = fit_onehot_logit(onehot_logit_stages(CATEGORICAL, NUMERIC), split.train)
    return rounded(positive_probability(model.transform(split.test)).select("label", "prediction", "probability"))


@query
def logit_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the optimum the mean prediction is the mean label, overall and weighted by a feature."""
    train = split_legs(spark, sf_dir).train
    with held(train):
        assembler = VectorAssembler(inputCols=["sched_hhmm", "sched_elapsed"], outputCol="features")
        logit = onehot_logit_stages(CATEGORICAL, NUMERIC, max_iter=200).getStages()[-1].setTol(1e-12)
        model = Pipeline(stages=[assembler, logit]).fit(train)
        error = F.col("probability") - F.col("label")
        found = positive_probability(model.transform(train)).agg(
            F.avg(error).alias("bias"), F.avg(error * F.col("sched_hhmm") / 2400).alias("slope")
        ).first()
    return only_ok(spark, abs(found["bias"]) < 1e-6 and abs(found["slope"]) < 1e-6)


NEWTON_LOGIT = {"hhmm": ("sched_hhmm", 2400), "elapsed": ("sched_elapsed", 50)}


def _two_features(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.col(c) / size for name, (c, size) in NEWTON_LOGIT.items()})


def _newton_logit(spark: SparkSession, sf_dir: str, weighted: bool):
    split = split_legs(spark, sf_dir)
    train = ops.add_class_weight(split.train, class_weight(split.train)) if weighted else split.train
    logit = NewtonLogit(list(NEWTON_LOGIT), weightCol="weight" if weighted else None)
    return logit.fit(_two_features(train)), _two_features(split.test)


@query
def newton_logit_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, _newton_logit(spark, sf_dir, False)[0])


@query
def newton_logit_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coefficients(spark, _newton_logit(spark, sf_dir, True)[0])


@query
def newton_logit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _newton_logit(spark, sf_dir, True)
    return rounded(model.transform(test).select("label", "sched_hhmm", "sched_elapsed", "probability", "prediction"))


@query
def logit_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The optimum that L-BFGS finds, weighted, to four places."""
    train = split_legs(spark, sf_dir).train
    train = _two_features(ops.add_class_weight(train, class_weight(train)))
    logit = onehot_logit_stages(CATEGORICAL, NUMERIC, "weight", max_iter=200).getStages()[-1].setTol(1e-12)
    assembler = VectorAssembler(inputCols=list(NEWTON_LOGIT), outputCol="features")
    found = Pipeline(stages=[assembler, logit]).fit(train).stages[-1]
    rows = [("bias", found.intercept), *zip(NEWTON_LOGIT, found.coefficients.toArray().tolist())]
    lines = spark.createDataFrame(rows, "feature string, weight double")
    return lines.select("feature", (F.round("weight", 4) + F.lit(0.0)).alias("weight"))


@query
def onehot_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = OneHotConfig(roles=ROLES, periods=PERIODS, start_year=START_YEAR)
    document = run_onehot(spark, config, legs(spark, sf_dir)).document
    late = F.aggregate(F.filter("confusion", lambda c: c["label"] == 1), F.lit(0).cast("bigint"), lambda a, c: a + c["count"])
    return document.select("mode", "max_iter", "train_rows", "test_rows", late.alias("late_test_rows"), r6("positive_weight"))


def _metrics_hold(spark: SparkSession, run) -> DataFrame:
    """Whether the published metrics are those of the written predictions."""
    published = read_metrics(spark, run.written["metrics"], DOCUMENT_SCHEMA).first()
    again, _ = measured(spark.read.parquet(run.written["predictions"]))
    return only_ok(spark, all(abs(published[name] - value) < 1e-9 for name, value in again.items()))


@query
def onehot_job_metrics_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = OneHotConfig(
        roles=ROLES, periods=PERIODS, start_year=START_YEAR, mode="baseline", output=scratch_path(spark, "run"), save_predictions=True
    )
    return _metrics_hold(spark, run_onehot(spark, config, legs(spark, sf_dir)))


@query
def tree_job_metrics_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = TreeConfig(
        roles=ROLES, periods=PERIODS, rounds=6, depth=3, positive_weight=None, output=scratch_path(spark, "run"), save_predictions=True
    )
    return _metrics_hold(spark, run_trees(spark, config, legs(spark, sf_dir)))


BOOSTED_FEATURES = [
    "year", "month", "dayofweek", "dep_hour", "dep_period", "is_weekend", "season", "distance",
    "sched_elapsed", "origin_id", "dest_id", "airline_delay_rate",
]


@contextmanager
def _boosted(spark: SparkSession, sf_dir: str, on_loss: bool = False, rounds: int = 5):
    """(booster, assembled test rows, assembled validation rows), from rows staged with the columns in use."""
    rows = labelled_legs(legs(spark, sf_dir), TreeConfig(roles=ROLES, periods=PERIODS)).dropna(subset=["carrier"])
    rows = ops.mark_parts(rows, {"train": 0.64, "validation": 0.16, "test": 0.2}, SEED)
    known = [c for c in BOOSTED_FEATURES if c in rows.columns]
    rows = rows.select("carrier", *known, LABEL, "part", (F.col("part") == "validation").alias("in_validation"))
    rows = restaged(rows, "parts")
    train = rows.filter(F.col("part") == "train")
    encoder = TargetMeanEncoder(["carrier"], ["airline_delay_rate"], LABEL).fit(train)
    encoded = encoder.transform(rows)
    learning = encoded.filter(F.col("part") != "test") if on_loss else encoded.filter(F.col("part") == "train")
    stages = gbt_stages(
        BOOSTED_FEATURES, LABEL, validation="in_validation" if on_loss else None, rounds=rounds, depth=4
    )
    assembler, booster = stages.fit(learning).stages
    assembled = assembler.transform(encoded)
    yield booster, assembled.filter(F.col("part") == "test"), assembled.filter("in_validation")


@query
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _boosted(spark, sf_dir) as (booster, test, _):
        scored = positive_probability(booster.transform(test))
        return rounded(scored.select(F.col(LABEL).alias("label"), "prediction", "probability"))


@query
def gbt_first_trees_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring with all trees one by one equals the model's own scoring."""
    with _boosted(spark, sf_dir) as (booster, test, _):
        own = positive_probability(booster.transform(test)).withColumnRenamed("probability", "whole")
        staged = first_trees(booster, own.drop("prediction", "rawPrediction"), booster.getNumTrees)
        apart = staged.agg(F.max(F.abs(F.col("whole") - F.col("probability")))).first()[0]
    return only_ok(spark, apart < 1e-9)


@query
def gbt_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting stops early where validation labels are turned round, and not where they are like the others."""
    rows = ops.add_calendar_features(cleaned(spark, sf_dir), ROLES)
    rows = ops.mark_parts(rows, {"train": 0.8, "validation": 0.2}, SEED)
    # the hour alone decides, so that every round gains on rows like those learnt from
    rows = rows.withColumn("in_validation", F.col("part") == "validation").withColumn("late", (F.col("dep_hour") >= 12).cast("int"))
    turned = rows.withColumn("late", F.when(F.col("in_validation"), 1 - F.col("late")).otherwise(F.col("late")))
    stages = gbt_stages(["dep_hour", "distance"], "late", validation="in_validation", rounds=5, depth=2, validation_tol=1e-6, row_share=1.0, feature_share=1.0)
    grown = []
    for frame in (rows, turned):
        kept = restaged(frame.select("dep_hour", "distance", "late", "in_validation"), "stop")
        grown.append(stages.fit(kept).stages[-1].getNumTrees)
    return only_ok(spark, grown[0] == 5 and grown[1] < 5)


@query
def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _boosted(spark, sf_dir) as (booster, test, _):
        names = feature_names(test)
    return rounded(feature_importances(spark, booster.featureImportances.toArray(), names))


@query
def importances_sum_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _boosted(spark, sf_dir) as (booster, test, _):
        table = feature_importances(spark, booster.featureImportances.toArray(), feature_names(test))
    return table.agg((F.abs(F.sum("importance") - 1.0) < 1e-9).alias("ok"))


@query
def boosting_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _boosted(spark, sf_dir) as (booster, _, validation):
        losses = loss_curve(booster, validation)
        curve = spark.createDataFrame(training_curve(booster, validation, LABEL).collect(), "round int, auc double")
    return rounded(curve.join(losses, "round"))


@query
def boosting_curve_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last point of the curve is the model's own auc, and the best round lies on it."""
    with _boosted(spark, sf_dir) as (booster, _, validation):
        curve = spark.createDataFrame(training_curve(booster, validation, LABEL).collect(), "round int, auc double")
        whole = roc_auc(positive_probability(booster.transform(validation)), LABEL).first()["auc"]
    last = curve.filter(F.col("round") == booster.getNumTrees).first()["auc"]
    return only_ok(spark, abs(whole - last) < 1e-9 and 1 <= best_round(curve, 30) <= booster.getNumTrees)


#: whole-numbered features, so that bins are values
NEWTON_FEATURES = ("dep_hour", "month", "day", "dayofweek")
NEWTON_ROUNDS, NEWTON_DEPTH, NEWTON_RATE = 12, 6, 0.2


def _newton(spark: SparkSession, sf_dir: str, stop: bool):
    """(model, all rows): rows of every fifth day are not learnt from; with ``stop`` they choose the round."""
    rows = ops.add_calendar_features(staged(spark, sf_dir), ROLES).withColumn("held_back", F.col("day") % 5 == 0)
    trees = NewtonTrees(
        list(NEWTON_FEATURES), validationCol="held_back" if stop else None, maxIter=NEWTON_ROUNDS, depth=NEWTON_DEPTH,
        stepSize=NEWTON_RATE, rowShare=1.0, featureShare=1.0,
    )
    return trees.fit(rows if stop else rows.filter(~F.col("held_back"))), rows


@query
def newton_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every split of the second-order trees with its gain, of all rounds."""
    return rounded(_newton(spark, sf_dir, False)[0].splits(spark), "gain")


@query
def newton_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of the features by the gain of all splits."""
    return rounded(_newton(spark, sf_dir, False)[0].gains(spark))


@query
def newton_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of the rows held back after every round."""
    return rounded(_newton(spark, sf_dir, True)[0].curve(spark))


@query
def newton_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all rows by the round of the best AUC."""
    model, rows = _newton(spark, sf_dir, True)
    return rounded(model.transform(rows).select(*NEWTON_FEATURES, "label", "probability", "prediction"), "probability")


@query
def tree_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the tree job counts in all its parts, with trees grown on a share of them."""
    config = TreeConfig(roles=ROLES, periods=PERIODS, sample_fraction=0.3, rounds=2, depth=2, positive_weight=None)
    document = run_trees(spark, config, legs(spark, sf_dir)).document
    return document.select((F.col("train_rows") + F.col("validation_rows")).alias("learning_rows"), "test_rows")


@query
def tree_model_is_measured_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned model, before and after saving, gives the scores that were measured."""
    config = TreeConfig(roles=ROLES, periods=PERIODS, rounds=6, depth=3, positive_weight=None, patience=1)
    run = run_trees(spark, config, legs(spark, sf_dir))
    again = load_model(save_model(run.model, scratch_path(spark, "run"), "trees"))
    booster = again.stages[-1]
    measured_scores = run.scored.withColumnRenamed("probability", "before").drop("prediction")
    both = positive_probability(booster.transform(measured_scores))
    apart = both.agg(F.max(F.abs(F.col("before") - F.col("probability")))).first()[0]
    return only_ok(spark, apart < 1e-12 and booster.getNumTrees == run.rounds_used)


@query
def job_row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the rows of a run went, from the run itself."""
    config = DescentConfig(roles=ROLES, periods=PERIODS, start_year=1996, max_iter=2, train_ratio=RATIO)
    return run_descent(spark, config, legs(spark, sf_dir)).accounting


@query
def tree_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job at its full size: rows of each class that the report rests on."""
    config = TreeConfig(roles=ROLES, periods=PERIODS, positive_weight=None)
    return run_trees(spark, config, legs(spark, sf_dir)).report.select("name", "support")


@query
def newton_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with second-order trees at its full size: rows of each class that the report rests on."""
    config = TreeConfig(roles=ROLES, periods=PERIODS, positive_weight=None, second_order=True, patience=5)
    return run_trees(spark, config, legs(spark, sf_dir)).report.select("name", "support")


# ---- documents ---------------------------------------------------------------------

@query
def metrics_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_row(_clock_document(spark, sf_dir))


@query
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs compared from the documents they published."""
    base = scratch_path(spark, "runs")
    clock = _clock_document(spark, sf_dir, optimizer="none", encoding="none", split="none")
    turned = by_clock(spark, sf_dir).withColumn("probability", 1 - F.col("probability"))
    with held(turned) as scores:
        metrics, confusion = measured(scores)
    other = metrics_document(
        spark, model="turned", mode="baseline", optimizer="none", encoding="none", split="none",
        confusion=confusion, **metrics,
    )
    paths = [write_metrics(d, f"{base}/{n}", "baseline") for n, d in (("clock", clock), ("turned", other))]
    compared = compare_models(read_metrics(spark, paths, DOCUMENT_SCHEMA), baseline_auc=0.5)
    return rounded(compared.select("model", "mode", "auc", "auc_gain"))
