"""Read physical plans (for tests and for checking a job before running it at scale)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` output as a string (the initial adaptive plan unless executed)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """How many operators called ``name`` (e.g. ``Scan parquet``, ``Exchange``) the
    physical plan tree holds."""
    tree = plan_text(df, "formatted").split("\n\n")[0]
    return len(re.findall(rf"(?:^|[-+:] ){re.escape(name)}\b", tree, flags=re.M))
