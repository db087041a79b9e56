"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimtide.schemas import SURROGATE_NULL_TEXT, SURROGATE_SEPARATOR


def surrogate_key(*cols: Column | str) -> Column:
    """Lower-case hex MD5 of the parts' text joined by '-', nulls replaced by
    the generic placeholder text (the public generic-key convention)."""
    parts = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit(SURROGATE_SEPARATOR))
        parts.append(F.coalesce(col.cast("string"), F.lit(SURROGATE_NULL_TEXT)))
    return F.md5(F.concat(*parts))
