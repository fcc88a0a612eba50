from latemark.features.frequency import FrequencyEncoder, FrequencyEncoderModel
from latemark.features.index import RankedIndexer, RankedIndexerModel, ranked_labels
from latemark.features.median import GroupMedianImputer, GroupMedianImputerModel
from latemark.features.scale import ZScore, ZScoreModel
from latemark.features.target_mean import (
    OutOfFoldTargetMeanEncoder, OutOfFoldTargetMeanModel, TargetMeanEncoder, TargetMeanEncoderModel,
)

__all__ = [
    "FrequencyEncoder", "FrequencyEncoderModel", "GroupMedianImputer",
    "GroupMedianImputerModel", "OutOfFoldTargetMeanEncoder", "OutOfFoldTargetMeanModel", "RankedIndexer", "RankedIndexerModel", "TargetMeanEncoder",
    "TargetMeanEncoderModel", "ZScore", "ZScoreModel", "ranked_labels",
]
