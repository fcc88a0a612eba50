"""Exact ranking metrics: ROC AUC, average precision, precision-recall points.

Everything follows from one table, the tie groups: per distinct score the positives and
negatives at it and at or above it. It is built without a global sort or window:

1. rows are counted per score (partial counts first, so equal scores collapse early);
2. scores fall into ordered buckets cut at quantiles of a hash sample of distinct scores;
   bucket totals are few and give every bucket its offset;
3. a running sum inside each bucket completes the counts.

The sample decides only where buckets end, i.e. how even they are. The numbers are exact
for any cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.operators.buckets import ordered_buckets


def tie_groups(
    scored: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """(by…, score, pos, neg, cum_pos, cum_neg, all_pos, all_neg) from the highest score down.

    ``cum_*`` count the rows at or above the score, ``all_*`` all rows, within each ``by``
    group. Rows without label or score do not count.
    """
    rows = scored.select(
        *by, F.col(label).cast("int").alias("_label"), F.col(score).cast("double").alias("score")
    ).filter(F.col("_label").isin(0, 1) & F.col("score").isNotNull() & ~F.isnan("score"))
    # -0.0 and 0.0 are one score
    rows = rows.withColumn("score", F.col("score") + F.lit(0.0))
    groups = ordered_buckets(rows, "score").groupBy(*by, "_bucket", "score").agg(
        F.count_if(F.col("_label") == 1).alias("pos"),
        F.count_if(F.col("_label") == 0).alias("neg"),
    )
    # at most INTERVALS * MAX_CUTS rows per group
    totals = groups.groupBy(*by, "_bucket").agg(
        F.sum("pos").alias("_bucket_pos"), F.sum("neg").alias("_bucket_neg")
    )
    each = Window.partitionBy(*by)
    higher = each.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_of_{c}") for c in by], F.col("_bucket").alias("_of_bucket"),
        F.coalesce(F.sum("_bucket_pos").over(higher), F.lit(0)).alias("_pos_above"),
        F.coalesce(F.sum("_bucket_neg").over(higher), F.lit(0)).alias("_neg_above"),
        F.sum("_bucket_pos").over(each).alias("all_pos"),
        F.sum("_bucket_neg").over(each).alias("all_neg"),
    )
    within = (
        Window.partitionBy(*by, "_bucket").orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = groups.withColumns({
        "_pos_run": F.sum("pos").over(within), "_neg_run": F.sum("neg").over(within),
    })
    # without groups the offsets are bounded as above; with groups Spark picks the join
    offsets = offsets if by else F.broadcast(offsets)
    matches = reduce(
        lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_of_{c}")), by, F.col("_bucket") == F.col("_of_bucket")
    )
    # every row has its offset; a left join adds no filter, so that both sides share the
    # shuffled counts instead of reading the rows twice
    return running.join(offsets, matches, "left").select(
        *by, "score", "pos", "neg",
        (F.col("_pos_above") + F.col("_pos_run")).alias("cum_pos"),
        (F.col("_neg_above") + F.col("_neg_run")).alias("cum_neg"),
        "all_pos", "all_neg",
    )


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def ranking_metrics(
    scored: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """One row (per ``by`` group): auc, auc_desc_rank, average_precision, positives, negatives.

    ``auc`` counts tied pairs half. ``auc_desc_rank`` is the rank-sum statistic taken over
    descending minimum ranks: near 1 - auc, lower the more positives are tied. Metrics are
    null where a class is missing.
    """
    pos, neg, cum_pos, cum_neg = map(_double, ("pos", "neg", "cum_pos", "cum_neg"))
    pairs = F.max(_double("all_pos")) * F.max(_double("all_neg"))
    above = F.sum(neg * (cum_pos - pos / 2))
    below = F.sum(pos * (cum_neg - neg) - pos * (pos - 1) / 2)
    precision = F.sum(pos * cum_pos / (cum_pos + cum_neg))
    groups = tie_groups(scored, label, score, by)
    return groups.groupBy(*by).agg(
        F.try_divide(above, pairs).alias("auc"),
        F.try_divide(below, pairs).alias("auc_desc_rank"),
        F.try_divide(precision, F.max(_double("all_pos"))).alias("average_precision"),
        F.coalesce(F.max("all_pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.max("all_neg"), F.lit(0)).alias("negatives"),
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    return ranking_metrics(scored, label, score).select("auc")


def average_precision(scored: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    return ranking_metrics(scored, label, score).select("average_precision")


def rank_statistics(scored: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    return ranking_metrics(scored, label, score).select("auc_desc_rank", "positives", "negatives")


def pr_curve(
    scored: DataFrame, label: str = "label", score: str = "probability", points: int | None = None
) -> DataFrame:
    """(threshold, precision, recall, prevalence): one row per distinct score.

    Predicting 1 at or above the threshold gives that precision and recall; prevalence is
    the precision of a random ranking. With ``points`` the recall range is cut into that
    many steps and the last score reaching each step is kept, which bounds the output for
    plotting.
    """
    cum_pos, cum_neg = _double("cum_pos"), _double("cum_neg")
    all_pos, all_neg = _double("all_pos"), _double("all_neg")
    curve = tie_groups(scored, label, score).select(
        F.col("score").alias("threshold"),
        (cum_pos / (cum_pos + cum_neg)).alias("precision"),
        F.try_divide(cum_pos, all_pos).alias("recall"),
        (all_pos / (all_pos + all_neg)).alias("prevalence"),
        # whole numbers divided once, so that a share like 7 of 100 falls on its own step
        F.ceil(F.try_divide(cum_pos * (points or 1), all_pos)).alias("_step"),
    )
    if points is None:
        return curve.drop("_step")
    return (
        curve.groupBy("_step")
        .agg(F.min_by(F.struct("threshold", "precision", "recall", "prevalence"), "threshold").alias("_last"))
        .select("_last.*")
    )
