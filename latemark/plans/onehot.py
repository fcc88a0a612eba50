"""One-hot job: index and one-hot encoding, content-hash split, L-BFGS."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.evaluation import metrics_document
from latemark.evaluation.curves import feature_names
from latemark.operators import add_class_weight, mark_parts
from latemark.plans.common import accounting, cleaned_legs, malformed, measured, publish, scores_only
from latemark.plans.config import OneHotConfig, RunResult, check_mode
from latemark.session import owning_scratch
from latemark.sources import restaged, save_model
from latemark.training import fit_onehot_logit, onehot_logit_stages
from latemark.training.weights import positive_weight


def positive_probability(scored: DataFrame) -> DataFrame:
    """Replace the class vector by the probability of class 1."""
    return scored.withColumn("probability", vector_to_array("probability")[1])


@owning_scratch
def run_onehot(spark: SparkSession, config: OneHotConfig, legs: DataFrame | None = None) -> RunResult:
    weighted = check_mode(config.mode)
    roles = config.roles
    shares = {"train": config.train_ratio, "test": 1.0 - config.train_ratio}
    marked = mark_parts(cleaned_legs(spark, config, legs), shares, config.seed)
    cleaned = restaged(marked, "cleaned")
    counts = {
        (row["part"], row["label"]): row["n"]
        for row in cleaned.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    rows = {p: sum(n for (part, _), n in counts.items() if part == p) for p in shares}
    scope = list(shares) if config.weight_scope == "all" else ["train"]
    weight = positive_weight(*[
        sum(counts.get((part, label), 0) for part in scope) for label in (0, 1)
    ]) if weighted else None

    train = add_class_weight(cleaned.filter(F.col("part") == "train"), weight)
    stages = onehot_logit_stages(
        roles.categorical, roles.numeric, "weight" if weighted else None, config.max_iter,
        by_lookup=config.by_lookup,
    )
    model = fit_onehot_logit(stages, train)
    raw_scores = model.transform(cleaned.filter(F.col("part") == "test").drop("part"))
    scored = positive_probability(raw_scores)
    logit = model.stages[-1]
    names = feature_names(raw_scores.select("features"))
    # staged, so that later passes do not send the labels to every task
    scores = restaged(scores_only(scored), "scores")
    metrics, confusion = measured(scores)
    document = metrics_document(
        spark, model="logistic_regression", optimizer="L-BFGS", encoding="one-hot",
        split="by content hash", mode=config.mode, input=config.input,
        start_year=config.start_year, max_iter=config.max_iter,
        train_ratio=config.train_ratio, seed=config.seed, train_rows=rows["train"],
        test_rows=rows["test"], exclude_covid=bool(config.periods), positive_weight=weight,
        weights={"bias": logit.intercept, **dict(zip(names, logit.coefficients.toArray()))},
        categorical_cols=roles.categorical, numerical_cols=roles.numeric,
        confusion=confusion, **metrics,
    )
    written = publish(config, config.mode, document, scores)
    if config.output:
        written["model"] = save_model(model, config.output, config.mode)
    return RunResult(document, model, scored, written, accounting(spark, config, legs), malformed(spark, config))
