"""Comma-joined id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_ids(col: Column | str, sep: str = ",") -> Column:
    """Split a comma list into its ids; empty ids stay and are dropped after the explode
    (a filter there runs inside codegen, a lambda over the array does not).

    Java's ``split`` dropped only trailing empties and counted leading or inner ones as
    a category ``""``; the jobs drop every empty id (``"1,2,,"`` -> 1,2; ``""`` and ``","``
    -> none; ``",6"`` -> 6). Duplicates are kept, so ``"4,4"`` counts twice. Ids are not
    trimmed. A null list gives null (explode then yields no row).
    """
    col = F.col(col) if isinstance(col, str) else col
    return F.split(col, sep)
