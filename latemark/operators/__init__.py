from latemark.operators.aggregates import (
    category_counts, class_balance, delay_rates, distinct_years, feature_stats, group_medians,
    keyed_aggregates, label_counts, split_summary,
)
from latemark.operators.cleaning import (
    add_calendar_features, add_class_weight, add_label, clean_legs, cleaning_report,
    exclude_periods, select_features,
)
from latemark.operators.lookup import lookup_join
from latemark.operators.splits import (
    content_position, hash_parts, hash_split, mark_parts, stratified_sample, stratified_split,
    stratified_test, temporal_split,
)

__all__ = [
    "add_calendar_features", "add_class_weight", "add_label", "category_counts",
    "class_balance", "clean_legs", "content_position", "cleaning_report", "delay_rates", "distinct_years",
    "exclude_periods", "feature_stats", "group_medians", "hash_parts", "hash_split",
    "keyed_aggregates", "label_counts", "lookup_join", "mark_parts", "select_features", "split_summary",
    "stratified_sample", "stratified_split", "stratified_test", "temporal_split",
]
