"""Ordered key/value entries to one JSON object string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_json_object(entries: Column) -> Column:
    """``array<struct<key, value>>`` -> ``{"k1":v1,"k2":v2}`` in array order.

    Keys must be unique (aggregate first); ``map_from_entries`` keeps entry order and
    ``to_json`` escapes keys. Entries are bounded per row by the callers (top-n lists,
    buckets of one window), so no unbounded group is ever collected.
    """
    return F.to_json(F.map_from_entries(entries))
