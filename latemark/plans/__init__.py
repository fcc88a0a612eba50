from latemark.plans.config import DescentConfig, OneHotConfig, RunResult, TreeConfig
from latemark.plans.descent import run_descent
from latemark.plans.onehot import run_onehot
from latemark.plans.trees import TREE_FEATURES, run_trees

__all__ = [
    "DescentConfig", "OneHotConfig", "RunResult", "TREE_FEATURES", "TreeConfig",
    "run_descent", "run_onehot", "run_trees",
]
