"""The ad-click wire line ``<epoch ms> <province> <city> <userid> <adid>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

FIELDS = ("ts_ms", "province", "city", "userid", "adid")
# Epoch milliseconds of the years 1 to 9999, the range in which labels have four-digit years.
MIN_MS, MAX_MS = -62_135_596_800_000, 253_402_300_799_999


def parse_ad_lines(
    df: DataFrame,
    line_col: str = "line",
    mode: str = "fail",
    keep: list[str] | None = None,
    metrics: Observation | str | None = None,
) -> DataFrame:
    """Split each line on single spaces into a typed click row.

    Fields past the fifth are ignored. A line is malformed when it has fewer than five
    fields, an empty field among the five, or a time that is no integer or lies outside
    the years 1 to 9999. ``mode="fail"``
    raises on the first malformed line (the original job died there); ``mode="drop"``
    skips them; ``mode="quarantine"`` keeps them, with the line in a further column
    ``malformed`` (null in clicks), for streams that store them. Every expression is a JVM built-in, so parsing stays in codegen.
    Output: ``keep`` columns, ts_ms BIGINT, ts TIMESTAMP, province, city, userid, adid.

    ``metrics`` (an ``Observation``, or a name for streams, where the values appear in
    the query progress) collects ``lines`` and ``malformed`` counts as the data flows
    through the first action: no extra pass over the input.
    """
    if mode not in ("fail", "drop", "quarantine"):
        raise ValueError(f"mode must be 'fail', 'drop' or 'quarantine', not {mode!r}")
    extra = [f"`{c}`" for c in (keep or [])]
    line = f"`{line_col}`"
    # get() gives null past the end of the array (ANSI-safe), try_cast null on junk.
    split = df.selectExpr(*extra, f"split({line}, ' ') AS _p", f"{line} AS _line")
    fields = split.selectExpr(
        *extra,
        "try_cast(get(_p, 0) AS BIGINT) AS ts_ms",
        *[f"get(_p, {i}) AS {n}" for i, n in enumerate(FIELDS) if i > 0],
        "size(_p) < 5 OR " + " OR ".join(f"coalesce(get(_p, {i}) = '', true)" for i in range(5)) + " AS _bad",
        "_line",
    )
    bad = f"(_bad OR ts_ms IS NULL OR ts_ms NOT BETWEEN {MIN_MS}L AND {MAX_MS}L)"
    if metrics is not None:
        fields = fields.observe(
            metrics, F.count(F.lit(1)).alias("lines"), F.count_if(F.expr(bad)).alias("malformed")
        )
    if mode == "quarantine":
        # A null line is malformed too, and kept as an empty one.
        told = fields.selectExpr(*extra, f"{bad} AS _malformed", "ts_ms", *FIELDS[1:], "_line").selectExpr(
            *extra, *[f"CASE WHEN NOT _malformed THEN {c} END AS {c}" for c in FIELDS],
            "CASE WHEN _malformed THEN coalesce(_line, '') END AS malformed",
        )
        return told.selectExpr(
            *extra, "ts_ms", "timestamp_millis(ts_ms) AS ts", *FIELDS[1:], "malformed"
        )
    if mode == "drop":
        fields = fields.filter(f"NOT {bad}")
        ts = "ts_ms"
    else:
        ts = f"CASE WHEN {bad} THEN CAST(raise_error(concat('malformed ad line: ', coalesce(_line, '<null>'))) AS BIGINT) ELSE ts_ms END"
    return fields.selectExpr(*extra, f"{ts} AS ts_ms", *FIELDS[1:]).selectExpr(
        *extra, "ts_ms", "timestamp_millis(ts_ms) AS ts", *FIELDS[1:]
    )
