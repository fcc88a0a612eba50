"""Stages for the models Spark trains itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.features.index import RankedIndexer
from latemark.sources import restaged
from latemark.training.packed import PackedBoosting


def encoding_stages(categorical: Sequence[str], numeric: Sequence[str], by_lookup: bool = False) -> list:
    """Index, one-hot encode and assemble; unseen categories become all zeros.

    One indexer serves all columns, so their labels are counted in a single job. The indexer is
    Spark's own, whose labels name the slots but pass through the driver; ``by_lookup`` takes
    one that keeps them in tables and joins them, and slots are named by place.
    """
    indexed = [f"{c}_index" for c in categorical]
    slots = [f"{c}_slots" for c in categorical]
    if by_lookup:
        indexer = RankedIndexer(list(categorical), indexed)
    else:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep")
    return [
        indexer,
        OneHotEncoder(inputCols=indexed, outputCols=slots),
        VectorAssembler(inputCols=[*slots, *numeric], outputCol="features", handleInvalid="keep"),
    ]


def onehot_logit_stages(
    categorical: Sequence[str],
    numeric: Sequence[str],
    weight: str | None = None,
    max_iter: int = 20,
    label: str = "label",
    by_lookup: bool = False,
) -> Pipeline:
    """One-hot encoding and L-BFGS logistic regression; ``weight`` names a weight column."""
    logit = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter)
    if weight:
        logit = logit.setWeightCol(weight)
    return Pipeline(stages=[*encoding_stages(categorical, numeric, by_lookup), logit])


def fit_onehot_logit(stages: Pipeline, train: DataFrame) -> PipelineModel:
    """``stages.fit(train)`` for the stages of :func:`onehot_logit_stages`, for many labels.

    Every task of every iteration is sent the plan of its rows, with all labels and names of
    slots in it, so that labels would cost more the more tasks there are. Encoded rows are
    staged without names instead; the two passes over them then encode nothing, either.
    """
    *encoding, logit = stages.getStages()
    encoder = Pipeline(stages=encoding).fit(train)
    learnt = [logit.getLabelCol(), *([logit.getWeightCol()] if logit.isSet(logit.weightCol) else [])]
    features = logit.getFeaturesCol()
    rows = encoder.transform(train).select(features, *learnt).withMetadata(features, {})
    return PipelineModel([*encoder.stages, logit.fit(restaged(rows, "encoded"))])


def gbt_stages(
    features: Sequence[str],
    label: str = "is_delayed",
    weight: str | None = None,
    validation: str | None = None,
    rounds: int = 50,
    learning_rate: float = 0.05,
    depth: int = 6,
    row_share: float = 0.8,
    feature_share: float = 0.8,
    seed: int = 42,
    validation_tol: float = 0.01,
    packed: bool = False,
) -> Pipeline:
    """Boosted trees over binned features, trained where the rows are.

    ``validation`` names a boolean column; boosting stops when the loss on its rows no
    longer falls. ``packed`` grows the same kind of trees over blocks of bins instead of Spark's
    objects a row, see :mod:`latemark.training.packed`, for very many rows; all rounds are run.
    """
    if packed and validation:
        raise ValueError("packed rows are not boosted with validation")
    trees = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=rounds, stepSize=learning_rate,
        maxDepth=depth, subsamplingRate=row_share, featureSubsetStrategy=str(feature_share),
        maxBins=32, seed=seed, checkpointInterval=10,
    )
    if weight:
        trees = trees.setWeightCol(weight)
    if validation:
        trees = trees.setValidationIndicatorCol(validation).setParams(validationTol=validation_tol)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, PackedBoosting(trees) if packed else trees])


def truncated(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The same model cut to its first ``rounds`` trees; it scores, saves and loads like any."""
    if not 1 <= rounds <= model.getNumTrees:
        raise ValueError(f"rounds must lie between 1 and {model.getNumTrees}, got {rounds}")
    whole = model._java_obj
    session = SparkSession.active()
    trees, weights = whole.trees()[:rounds], list(model.treeWeights[:rounds])
    gateway = session.sparkContext._gateway
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    scales = gateway.new_array(gateway.jvm.double, rounds)
    for index in range(rounds):
        kept[index], scales[index] = trees[index], weights[index]
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_first{rounds}", kept, scales, whole.numFeatures(), whole.numClasses()
    )
    result = GBTClassificationModel(cut)
    for param, value in model.extractParamMap().items():
        if model.isSet(param) and result.hasParam(param.name):
            result.set(result.getParam(param.name), value)
    result._transfer_params_to_java()
    return result


def first_trees(
    model: GBTClassificationModel, df: DataFrame, rounds: int, threshold: float = 0.5
) -> DataFrame:
    """Score with the first ``rounds`` trees only, e.g. up to the best validation round."""
    margin = F.lit(0.0)
    scored = df
    for index, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights[:rounds])):
        scored = tree.setPredictionCol(f"_tree{index}").transform(scored)
        margin = margin + F.col(f"_tree{index}") * F.lit(weight)
    # the classifier's link: its loss is log(1 + exp(-2 * label * margin))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
    return scored.select(
        *df.columns, probability.alias("probability"),
        (probability >= threshold).cast("int").alias("prediction"),
    )
