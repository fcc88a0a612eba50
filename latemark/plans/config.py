"""Parameters and results of the jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from latemark.functions.predicates import PANDEMIC_PERIODS, Period
from latemark.roles import FLIGHTS, LegRoles
from latemark.session import remove_paths


@dataclass(kw_only=True)
class _Config:
    #: raw CSV path(s); not needed when a frame is passed to the job
    input: str | None = None
    #: folder for results; nothing is written without it
    output: str | None = None
    save_predictions: bool = False
    roles: LegRoles = FLIGHTS
    periods: Sequence[Period] = PANDEMIC_PERIODS
    threshold: float = 15


@dataclass(kw_only=True)
class DescentConfig(_Config):
    mode: str = "weighted"
    start_year: int = 2022
    max_iter: int = 100
    learning_rate: float = 0.1
    train_ratio: float = 0.8


@dataclass(kw_only=True)
class OneHotConfig(_Config):
    mode: str = "weighted"
    start_year: int = 2022
    max_iter: int = 20
    train_ratio: float = 0.8
    seed: int = 42
    #: rows the class weight is taken from: "train", or "all" to include the test rows
    weight_scope: str = "train"
    #: index categories by joined tables instead of labels in the driver, for very many labels
    by_lookup: bool = False


@dataclass(kw_only=True)
class TreeConfig(_Config):
    roles: LegRoles = field(default_factory=lambda: LegRoles(delay="departure_delay_mins"))
    periods: Sequence[Period] = ()
    mode: str = "trees"
    start_year: int = 1995
    #: share of the training rows that the trees are grown on; encoders are fitted and
    #: models measured on all rows whatever it is
    sample_fraction: float = 1.0
    test_share: float = 0.20
    #: share of the remaining rows used to choose the number of rounds
    validation_share: float = 0.20
    seed: int = 42
    rounds: int = 50
    learning_rate: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    feature_share: float = 0.8
    #: trees by gradient and hessian, which end while training; features are drawn per tree
    second_order: bool = False
    #: L2 penalty of the leaves of second-order trees
    penalty: float = 1.0
    #: None takes it from the training rows
    positive_weight: float | None = 4.9
    #: "auc": run all rounds, keep them up to the best validation auc; "loss": stop
    #: boosting as soon as the validation loss no longer falls
    stop_on: str = "auc"
    #: rounds without a better validation auc after which no later one is considered
    patience: int = 30
    #: also use columns only known after departure
    after_departure: bool = False
    #: keep cancelled, diverted and unknown-delay legs, the latter counted as on time
    keep_unknown: bool = False
    #: auc of another model to report the gain over
    baseline_auc: float | None = None


@dataclass
class RunResult:
    document: DataFrame
    model: PipelineModel
    scored: DataFrame
    written: dict[str, str]
    #: one row: rows read, rows past each cleaning rule in turn, rows kept
    accounting: DataFrame
    #: entries of the input that do not fit their column; None if a frame was given
    malformed: DataFrame | None
    #: folders that the lazy frames above still read
    scratch: list[str] = field(default_factory=list, kw_only=True)

    def discard(self, spark: SparkSession) -> None:
        """Delete what the run staged; ``scored`` cannot be read afterwards, written results can."""
        remove_paths(spark, self.scratch)
        self.scratch = []


def check_mode(mode: str) -> bool:
    """True for weighted, False for baseline."""
    if mode not in ("baseline", "weighted"):
        raise ValueError(f"mode must be baseline or weighted, got {mode!r}")
    return mode == "weighted"
