"""Re-open detection and the classified snapshot table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import schemas as S
from claimtide.functions.calendar import report_week, report_year
from claimtide.functions.categories import reopened_flag, wbr_tiers
from claimtide.functions.keys import surrogate_key
from claimtide.functions.money import product
from claimtide.session import broadcast_if_small

#: currency seeds up to this many rows are broadcast (checked by counting).
RATE_BROADCAST_LIMIT = 10_000


def first_closed_dates(staged: DataFrame) -> DataFrame:
    """Earliest Closed snapshot per claim.

    A plain grouped ``min``: each task pre-aggregates its rows, so a claim
    holding a third of the history still sends one row per task to the
    shuffle.  The result has one row per ever-closed claim.
    """
    return (
        staged.where(F.col("status") == S.STATUS_CLOSED)
        .groupBy("claim_number")
        .agg(F.min("snapshot_date").alias("first_closed_date"))
    )


def _with_closed_before(staged: DataFrame, history: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    # left join back on the claim through a hash table of its few narrow rows
    # (one a claim), so the wide side isn't sorted; AQE splits a hot claim
    closed = first_closed_dates(staged if history is None else history)
    closed = (closed.repartition(parts, "claim_number") if parts else closed).hint("shuffle_hash")
    before = (F.col("first_closed_date") < F.col("snapshot_date")).alias("_closed_before")
    if history is not None:
        return staged.join(closed, "claim_number", "left").select(staged["*"], before)
    # over the whole history only Open rows go through the join's shuffle; the
    # others can't be re-opened (a null status is unknown, so it counts as Open)
    is_open = F.coalesce(F.col("status") == S.STATUS_OPEN, F.lit(True))
    opened = staged.where(is_open)
    joined = opened.join(closed, "claim_number", "left").select(opened["*"], before)
    return joined.unionByName(staged.where(~is_open).withColumn("_closed_before", F.lit(None).cast("boolean")))


def detect_reopened(staged: DataFrame) -> DataFrame:
    """(claim_number, snapshot_date, is_reopened): Open now and Closed at an
    earlier snapshot date.  Same result as a running max over earlier rows
    when (claim, snapshot date) is unique, but without a per-claim window, so
    no single task has to hold a hot claim's history."""
    flagged = _with_closed_before(staged)
    return flagged.select(
        "claim_number",
        "snapshot_date",
        reopened_flag("status", F.col("_closed_before")).alias("is_reopened"),
    )


def convert_currency(staged: DataFrame, rates: DataFrame) -> DataFrame:
    """Staged rows + rate_to_usd + value_usd (unknown currency -> rate 1).

    The seed is broadcast once its row count is proven small: a seed built
    in Python has no size statistics, and a shuffle join would move the
    whole history by currency, a key with a handful of values.  A seed past
    the limit falls back to a planner-chosen join.  A code that the seed
    holds twice would multiply the history and is refused."""
    rates = rates.select("currency_code", "rate_to_usd")
    repeated = rates.where("currency_code is not null").groupBy("currency_code").count().where("count > 1").head()
    if repeated is not None:
        raise ValueError(f"currency code {repeated[0]!r} has several rates")
    rates = broadcast_if_small(rates, RATE_BROADCAST_LIMIT)
    joined = staged.join(rates, staged["currency"] == rates["currency_code"], "left").drop("currency_code")
    rate = F.coalesce(F.col("rate_to_usd"), F.lit(1).cast(S.RATE_TYPE))
    return joined.withColumn("value_usd", product("value_of_trailer", rate))


def classify(staged: DataFrame, rates: DataFrame, history: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """The classified table: key, staged columns, report weeks, tiers, USD.

    ``history`` is the full staged history the re-open flag looks back into;
    it defaults to ``staged``.  Passing a subset of snapshots as ``staged``
    (for example the latest per claim and week) classifies just those rows
    exactly as the full table would.  ``parts``: the number of partitions by
    claim that such a subset is dealt into, which the join then keeps."""
    flagged = convert_currency(_with_closed_before(staged, history, parts), rates)
    is_reopened = reopened_flag("status", F.col("_closed_before"))
    tier1, tier2, tier3 = wbr_tiers(is_reopened=is_reopened)
    return flagged.select(
        surrogate_key("claim_number", "snapshot_date").alias("claim_snapshot_key"),
        *S.STAGED_COLUMNS,
        report_year("snapshot_date").alias("report_year"),
        report_week("snapshot_date").alias("report_week"),
        report_year("submitted_date").alias("submitted_year"),
        report_week("submitted_date").alias("submitted_week"),
        report_year("case_date_closed").alias("closed_year"),
        report_week("case_date_closed").alias("closed_week"),
        tier1.alias("wbr_tier1"),
        tier2.alias("wbr_tier2"),
        tier3.alias("wbr_tier3"),
        F.col("value_usd").cast(S.USD_TYPE).alias("value_usd"),
    )


def told_columns() -> dict[str, Column]:
    """Classified columns that follow from others of their row.  A write that
    deals rows to tasks leaves them out and tells them after: the key alone is a
    quarter of a shuffled row's bytes."""
    # only a re-opened snapshot has that first tier
    _, tier2, tier3 = wbr_tiers(is_reopened=F.col("wbr_tier1") == S.TIER1_REOPENED)
    return {
        "claim_snapshot_key": surrogate_key("claim_number", "snapshot_date"),
        "report_year": report_year("snapshot_date"),
        "report_week": report_week("snapshot_date"),
        "submitted_year": report_year("submitted_date"),
        "submitted_week": report_week("submitted_date"),
        "closed_year": report_year("case_date_closed"),
        "closed_week": report_week("case_date_closed"),
        "wbr_tier2": tier2,
        "wbr_tier3": tier3,
    }
