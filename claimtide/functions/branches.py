"""Branches that few rows take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def apart(value: Column, rare: Callable[[Column], Column]) -> Column:
    """``rare(value)``, taken of a list of one: what few rows need stays out of
    the generated code of the others, of which Java leaves methods beyond 8,000
    bytes to its interpreter."""
    return F.get(F.transform(F.array(value), rare), F.lit(0))
