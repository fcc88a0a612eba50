from latemark.training.builtin import first_trees, fit_onehot_logit, gbt_stages, onehot_logit_stages, truncated
from latemark.training.descent import GradientDescentLogit, GradientDescentLogitModel, score_linear
from latemark.training.newton import NewtonTrees, NewtonTreesModel
from latemark.training.newton_logit import NewtonLogit
from latemark.training.weights import class_weight

__all__ = [
    "GradientDescentLogit", "GradientDescentLogitModel", "NewtonLogit", "NewtonTrees", "NewtonTreesModel",
    "class_weight", "first_trees", "fit_onehot_logit", "gbt_stages", "onehot_logit_stages", "score_linear", "truncated",
]
