"""Boosted-tree job: engineered features, three-way split, distributed boosting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.evaluation import (
    best_round, classification_report, compare_models, feature_importances, loss_curve,
    metrics_document, pr_curve, training_curve,
)
from latemark.evaluation.curves import feature_names
from latemark.features import GroupMedianImputer, TargetMeanEncoder
from latemark.operators import (
    add_calendar_features, add_class_weight, add_label, content_position, exclude_periods, mark_parts,
    select_features, stratified_sample, stratified_test,
)
from latemark.plans.common import accounting, load, malformed, measured, publish, scores_only
from latemark.plans.config import RunResult, TreeConfig
from latemark.plans.onehot import positive_probability
from latemark.roles import FLIGHTS, LegRoles
from latemark.session import held, owning_scratch
from latemark.sources import restaged, save_model, write_table
from latemark.training import NewtonTrees, gbt_stages, truncated
from latemark.training.weights import positive_weight

LABEL = "is_delayed"

CALENDAR = ("dep_hour", "dep_period", "is_weekend", "season")


def rate_columns(roles: LegRoles) -> dict[str, str]:
    """Key column → name of its rate column."""
    return {
        roles.carrier: "airline_delay_rate",
        roles.origin: "origin_delay_rate",
        roles.destination: "dest_delay_rate",
        "route": "route_delay_rate",
        "dep_hour": "hour_delay_rate",
        roles.month: "month_delay_rate",
    }


def tree_features(roles: LegRoles, after_departure: bool = True) -> list[str]:
    """Feature columns in table order; the imputed ones only with ``after_departure``."""
    year, month, day, weekday, _, distance, elapsed = roles.numeric
    cleaned = [f"{c}_clean" for c in roles.imputed] if after_departure else []
    return [
        year, month, day, weekday, *CALENDAR, distance, elapsed, *cleaned, roles.origin,
        roles.destination, *rate_columns(roles).values(),
    ]


TREE_FEATURES = tree_features(FLIGHTS)


@dataclass
class TreeResult(RunResult):
    report: DataFrame
    importances: DataFrame
    auc_by_round: DataFrame
    #: None for second-order trees, which are judged by auc alone
    loss_by_round: DataFrame | None
    curve: DataFrame
    comparison: DataFrame
    rounds_used: int


@dataclass
class Grown:
    """Fitted stages behind the encoders, and how they came about."""

    stages: list[Transformer]
    rounds: int
    optimizer: str
    importances: DataFrame
    auc_by_round: DataFrame
    loss_by_round: DataFrame | None

    def scored(self, df: DataFrame) -> DataFrame:
        return positive_probability(df).drop("rawPrediction") if "rawPrediction" in df.columns else df


def labelled_legs(df: DataFrame, config: TreeConfig) -> DataFrame:
    """Rows to learn from with calendar features and the label (strictly above the threshold)."""
    roles = config.roles
    if not config.keep_unknown:
        df = df.filter((F.col(roles.cancelled) == 0) & (F.col(roles.diverted) == 0))
    df = exclude_periods(df.filter(F.col(roles.year) >= config.start_year), roles.year, roles.month, config.periods)
    labelled = add_label(
        df, roles.delay, config.threshold, inclusive=False, keep_unknown=config.keep_unknown, output=LABEL
    )
    return add_calendar_features(labelled, roles)


def needed_columns(roles: LegRoles) -> tuple[str, ...]:
    return (*roles.required, *roles.imputed)


def fit_encoders(train: DataFrame, roles: LegRoles, imputed: Sequence[str]) -> list:
    rates = rate_columns(roles)
    stages = [TargetMeanEncoder(list(rates), list(rates.values()), LABEL).fit(train)]
    if imputed:
        stages.append(GroupMedianImputer(list(imputed), keyCol="route").fit(train))
    return stages


def _first_order(spark: SparkSession, config: TreeConfig, features: list[str], learned: DataFrame) -> Grown:
    """Gradient boosting, cut to the best round; ``learned`` is staged. Stopping on loss is Spark's own."""
    on_loss = config.stop_on == "loss"
    fitted = gbt_stages(
        features, LABEL, "weight", "in_validation" if on_loss else None, config.rounds,
        config.learning_rate, config.depth, config.row_share, config.feature_share, config.seed,
        packed=not on_loss,
    ).fit(learned if on_loss else learned.filter(~F.col("in_validation")))
    assembler, booster = fitted.stages
    validation = assembler.transform(learned.filter("in_validation"))
    auc_by_round = training_curve(booster, validation, LABEL)
    # bounded by the number of rounds; kept as rows so that the frames can be released
    auc_by_round = spark.createDataFrame(auc_by_round.collect(), "round int, auc double")
    loss_by_round = loss_curve(booster, validation)
    # rounds build on each other, so cutting later equals having stopped there
    used = booster.getNumTrees if on_loss else best_round(auc_by_round, config.patience)
    booster = truncated(booster, used)
    importances = feature_importances(spark, booster.featureImportances.toArray(), feature_names(validation))
    return Grown([assembler, booster], used, "gradient boosting", importances, auc_by_round, loss_by_round)


def _second_order(spark: SparkSession, config: TreeConfig, features: list[str], learned: DataFrame) -> Grown:
    """Trees by gradient and hessian, grown until the validation auc no longer rises; ``learned`` is held."""
    booster = NewtonTrees(
        features, LABEL, "weight", "in_validation", config.rounds, config.learning_rate, config.depth,
        config.penalty, rowShare=config.row_share, featureShare=config.feature_share, patience=config.patience, seed=config.seed,
    ).fit(learned)
    importances = booster.gains(spark).select("feature", "importance").orderBy("importance", "feature")
    return Grown([booster], booster.scalars["rounds"], "second-order gradient boosting", importances, booster.curve(spark), None)


@owning_scratch
def run_trees(spark: SparkSession, config: TreeConfig, legs: DataFrame | None = None) -> TreeResult:
    """Train on the training part, stop on the validation part, report on the test part."""
    if config.second_order and config.stop_on != "auc":
        raise ValueError("second-order trees stop on auc")
    roles = config.roles
    imputed = roles.imputed if config.after_departure else ()
    features = tree_features(roles, config.after_departure)
    raw = load(spark, config, needed_columns(roles)) if legs is None else legs
    base = labelled_legs(raw.select(*needed_columns(roles)), config)
    columns = base.columns
    shares = {"train": 1.0 - config.validation_share, "validation": config.validation_share}
    marked = mark_parts(base, shares, config.seed + 1, columns)
    # the input is read and digests are taken once; every later pass reads what is staged
    marked = restaged(marked.withColumn("_place", content_position(columns, config.seed)), "labelled")
    in_test = stratified_test(marked, LABEL, config.test_share, config.seed, columns, position="_place")
    rows = marked.withColumn("part", F.when(in_test, F.lit("test")).otherwise(F.col("part"))).drop("_place")
    counts = {
        (r["part"], r[LABEL]): r["n"]
        for r in rows.groupBy("part", LABEL).agg(F.count(F.lit(1)).alias("n")).collect()  # six rows
    }
    sizes = {p: sum(n for (part, _), n in counts.items() if part == p) for p in ("train", "validation", "test")}
    train, test = (rows.filter(F.col("part") == p) for p in ("train", "test"))
    weight = config.positive_weight or positive_weight(*[counts.get(("train", k), 0) for k in (0, 1)])
    encoders = PipelineModel(fit_encoders(train, roles, imputed))

    def table(part: DataFrame, *extra: str) -> DataFrame:
        return select_features(encoders.transform(part), [*extra, *features], LABEL)

    grown_on = train
    if config.sample_fraction < 1.0:
        rate = config.sample_fraction
        # another seed than the split's, or the sample would lie next to the test rows
        grown_on = stratified_sample(train, LABEL, {0: rate, 1: rate}, config.seed + 2, columns)
    learning = grown_on.unionByName(rows.filter(F.col("part") == "validation"))
    in_validation = learning.withColumn("in_validation", F.col("part") == "validation")
    learned = add_class_weight(table(in_validation, "in_validation"), weight, LABEL)
    grow = _second_order if config.second_order else _first_order
    if config.second_order:
        with held(learned):
            grown = grow(spark, config, features, learned)
    else:
        grown = grow(spark, config, features, restaged(learned, "learned"))
    model = PipelineModel([*encoders.stages, *grown.stages])
    scored = grown.scored(PipelineModel(grown.stages).transform(table(test)))
    with held(scores_only(scored, LABEL)) as scores:
        metrics, confusion = measured(scores)
        document = metrics_document(
            spark, model="boosted_trees", optimizer=grown.optimizer, encoding="target mean",
            split="stratified by content hash", mode=config.mode, input=config.input,
            start_year=config.start_year, max_iter=grown.rounds, learning_rate=config.learning_rate,
            train_ratio=1.0 - config.test_share, seed=config.seed, train_rows=sizes["train"],
            validation_rows=sizes["validation"], test_rows=sizes["test"], exclude_covid=bool(config.periods), positive_weight=weight,
            feature_cols=features, confusion=confusion, **metrics,
        )
        report = classification_report(scores)
        report = spark.createDataFrame(report.collect(), report.schema)  # five rows
        curve = pr_curve(scores, points=1000)
        curve = spark.createDataFrame(curve.collect(), curve.schema)  # about 1000 rows
        written = publish(config, config.mode, document, scores)
    importances = grown.importances
    if config.output:
        tables = {
            "report": report, "importances": importances, "pr_curve": curve,
            "auc_by_round": grown.auc_by_round, "loss_by_round": grown.loss_by_round,
        }
        tables = {name: t for name, t in tables.items() if t is not None}
        written |= {name: write_table(t, config.output, config.mode, name) for name, t in tables.items()}
        written["model"] = save_model(model, config.output, config.mode)
    return TreeResult(
        document, model, scored, written, accounting(spark, config, legs), malformed(spark, config),
        report, importances, grown.auc_by_round, grown.loss_by_round, curve,
        compare_models(document, config.baseline_auc), grown.rounds,
    )
