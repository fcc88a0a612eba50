"""Gradient-descent job: frequency encoding, split by year, batch gradient descent."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.evaluation import metrics_document
from latemark.features import FrequencyEncoder, ZScore
from latemark.operators import add_class_weight, temporal_split
from latemark.plans.common import accounting, cleaned_legs, malformed, measured, publish, scores_only
from latemark.plans.config import DescentConfig, RunResult, check_mode
from latemark.session import held, owning_scratch
from latemark.sources import restaged
from latemark.training import GradientDescentLogit
from latemark.training.weights import positive_weight


@owning_scratch
def run_descent(spark: SparkSession, config: DescentConfig, legs: DataFrame | None = None) -> RunResult:
    """Read, clean, split by year, encode, train, score, measure and publish."""
    weighted = check_mode(config.mode)
    roles = config.roles
    cleaned = restaged(cleaned_legs(spark, config, legs), "cleaned", roles.year)
    # years, split sizes and class counts in one job: two rows per year
    per_year = cleaned.groupBy(roles.year, "label").agg(F.count(F.lit(1)).alias("n")).collect()
    split = temporal_split(
        cleaned, roles.year, config.train_ratio, [row[roles.year] for row in per_year]
    )
    in_train = [row for row in per_year if row[roles.year] < split.first_test_year]
    late = sum(row["n"] for row in in_train if row["label"] == 1)
    train_rows = sum(row["n"] for row in in_train)
    test_rows = sum(row["n"] for row in per_year) - train_rows
    weight = positive_weight(train_rows - late, late) if weighted else None

    encoder = FrequencyEncoder(list(roles.categorical)).fit(split.train)
    features = [*roles.numeric, *encoder.getOutputCols()]
    encoded = encoder.transform(split.train)
    scale = ZScore(features).fit(encoded)
    train = add_class_weight(scale.transform(encoded), weight)
    logit = GradientDescentLogit(
        features, weightCol="weight", maxIter=config.max_iter, stepSize=config.learning_rate
    ).fit(train)
    model = PipelineModel([encoder, scale, logit])

    scored = model.transform(split.test)
    with held(scores_only(scored)) as scores:
        metrics, confusion = measured(scores)
        document = metrics_document(
            spark, model="gradient_descent", optimizer="full batch gradient descent",
            encoding="frequency", split="by year", mode=config.mode, input=config.input,
            start_year=config.start_year, max_iter=config.max_iter,
            learning_rate=config.learning_rate, train_ratio=config.train_ratio,
            test_year_start=split.first_test_year, train_rows=train_rows, test_rows=test_rows,
            exclude_covid=bool(config.periods), positive_weight=weight if weighted else 1.0,
            weights=logit.coefficients, categorical_cols=roles.categorical,
            numerical_cols=roles.numeric, feature_cols=features, confusion=confusion, **metrics,
        )
        written = publish(config, config.mode, document, scores)
    return RunResult(document, model, scored, written, accounting(spark, config, legs), malformed(spark, config))
