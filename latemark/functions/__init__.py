from latemark.functions.calendar import day_period, departure_hour, route_key, season, weekend_flag
from latemark.functions.hashing import content_digest, digest_position
from latemark.functions.predicates import in_any_period, is_known, late_label

__all__ = [
    "content_digest", "day_period", "departure_hour", "digest_position", "in_any_period",
    "is_known", "late_label", "route_key", "season", "weekend_flag",
]
