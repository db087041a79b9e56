"""Staging: trim, safe-cast and rename the raw history; drop unusable keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.functions.text import (
    AFTER_VISIBLE,
    FIRST_VISIBLE,
    UNICODE_WHITESPACE,
    blank_to_null,
    clean_text,
    safe_date,
    safe_decimal,
    upper_text,
)
from claimtide.schemas import DEFAULT_CURRENCY, STAGED_DATES, TEXT_DIMENSIONS


def stage_claims(raw: DataFrame) -> DataFrame:
    """One staged row per raw row with a non-blank claim number and a valid
    snapshot date.  A narrow projection + filter: no shuffle, and the null
    checks reach the Parquet scan."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    # same rows as the key filter below, stated on the raw columns so that the
    # scan gets IsNotNull filters (Parquet skips all-null row groups)
    raw = raw.where(F.col("claim_number").isNotNull() & F.col("snapshot_date").isNotNull())
    # told from the left edge alone: the filter may run apart from the trims
    left = F.ltrim(F.col("claim_number").cast("string"))
    visible = (left >= FIRST_VISIBLE) & (left < AFTER_VISIBLE)
    raw = raw.where(visible | (F.ltrim(left, F.lit(UNICODE_WHITESPACE)) != ""))
    claim = clean_text("claim_number")
    snapshot = safe_date("snapshot_date", types.get("snapshot_date"))
    staged = raw.select(
        claim.alias("claim_number"),
        snapshot.alias("snapshot_date"),
        *(clean_text(c).alias(c) for c in TEXT_DIMENSIONS),
        F.coalesce(blank_to_null(upper_text(clean_text("currency"))), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        *(safe_date(src, types.get(src)).alias(name) for name, src in STAGED_DATES),
        safe_decimal("value_of_trailer", types.get("value_of_trailer")).alias("value_of_trailer"),
    )
    return staged.where(F.col("snapshot_date").isNotNull())
