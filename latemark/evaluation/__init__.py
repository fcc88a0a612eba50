from latemark.evaluation.curves import best_round, feature_importances, loss_curve, training_curve
from latemark.evaluation.documents import METRIC_NAMES, compare_models, metrics_document
from latemark.evaluation.ranking import (
    average_precision, pr_curve, rank_statistics, ranking_metrics, roc_auc, tie_groups,
)
from latemark.evaluation.threshold import binary_metrics, classification_report, confusion_matrix

__all__ = [
    "METRIC_NAMES", "average_precision", "best_round", "binary_metrics",
    "classification_report", "compare_models", "confusion_matrix", "feature_importances",
    "loss_curve", "metrics_document", "pr_curve", "rank_statistics", "ranking_metrics",
    "roc_auc", "tie_groups", "training_curve",
]
