"""Table scans, typed rows, the ad-log line format and stream sources."""

from clickflow.sources.adslog import parse_ad_lines
from clickflow.sources.tables import as_actions, read_actions

__all__ = ["as_actions", "read_actions", "parse_ad_lines"]
