"""Column-level helpers. All are compositions of JVM built-ins (no Python UDFs)."""

from clickflow.functions.jsonfmt import ordered_json_object
from clickflow.functions.lists import split_ids
from clickflow.functions.timefmt import bucket_start_ms, clock_label, day_label, format_epoch_ms, stamp_label

__all__ = [
    "split_ids",
    "format_epoch_ms",
    "day_label",
    "clock_label",
    "stamp_label",
    "bucket_start_ms",
    "ordered_json_object",
]
