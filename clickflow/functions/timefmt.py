"""Epoch milliseconds to labels and buckets.

Labels are rendered in the session time zone (``spark.sql.session.timeZone``), the
Spark counterpart of the JVM default zone the original jobs formatted in.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_epoch_ms(ms: Column | str, fmt: str) -> Column:
    """Format epoch milliseconds with a datetime pattern."""
    return F.date_format(F.timestamp_millis(_c(ms)), fmt)


def day_label(ms: Column | str) -> Column:
    """C4: ``yyyy-MM-dd`` of an epoch-ms time."""
    return format_epoch_ms(ms, "yyyy-MM-dd")


def _unique(ms: Column | str, fmt: str) -> Column:
    """The label, with the UTC offset added for times in an hour that the session zone's
    clock shows for the second time (the end of daylight saving). No label is parsed: a wall
    clock time that occurs twice goes back to its first instant, and a zone of one offset has
    none."""
    ts = F.timestamp_millis(_c(ms))
    label = F.date_format(ts, fmt)
    spark = SparkSession.getActiveSession()
    zone = spark.conf.get("spark.sql.session.timeZone")
    if spark._jvm.java.time.ZoneId.of(zone, spark._jvm.java.time.ZoneId.SHORT_IDS).getRules().isFixedOffset():
        return label
    first = F.to_utc_timestamp(F.from_utc_timestamp(ts, zone), zone)
    return F.when(first < ts, F.date_format(ts, f"{fmt}XXX")).otherwise(label)


def clock_label(ms: Column | str, twelve_hour: bool = False) -> Column:
    """``HH:mm:ss``, unique within a day (see ``_unique``). ``twelve_hour=True``
    reproduces the original ``hh:mm:ss`` label, which has no am/pm marker, so 01:00:05 and
    13:00:05 print alike."""
    return _unique(ms, "hh:mm:ss" if twelve_hour else "HH:mm:ss")


def stamp_label(ms: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an epoch-ms time, unique (see ``_unique``)."""
    return _unique(ms, "yyyy-MM-dd HH:mm:ss")


def bucket_start_ms(ms: Column | str, size_ms: int) -> Column:
    """Start of the ``size_ms`` bucket holding the time (floor, also below 0)."""
    m = _c(ms)
    return m - F.pmod(m, F.lit(size_ms))
