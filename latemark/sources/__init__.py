from latemark.sources.legs import RAW_TYPES, malformed_entries, read_legs, read_staged, restaged, stage_legs
from latemark.sources.quarantine import Quarantine, quarantined_legs
from latemark.sources.sinks import (
    load_model, read_metrics, read_sample, save_model, write_confusion, write_metrics,
    write_predictions, write_sample, write_table,
)

__all__ = [
    "Quarantine", "RAW_TYPES", "load_model", "malformed_entries", "quarantined_legs", "read_legs", "read_metrics", "read_sample", "read_staged",
    "restaged", "save_model", "stage_legs", "write_confusion", "write_metrics", "write_predictions",
    "write_sample", "write_table",
]
