"""Marts: current state, weekly/monthly state with transitions, period metrics.

Shuffle design (per mart, sized for a claim holding a third of all rows):

1. latest snapshot per (claim, period): ``row_number() = 1``.  Spark plans it
   as a *partial* WindowGroupLimit before the exchange, so every task keeps
   at most one row per (claim, period) before anything is shuffled;
2. previous period per claim: ``lag`` over the claim, on the deduplicated
   rows only.  A claim has at most one row per calendar period there, so the
   largest window partition is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtide import schemas as S
from claimtide.functions import calendar as cal
from claimtide.functions.categories import status_changed, transition_type, value_delta
from claimtide.functions.money import total
from claimtide.operators.classify import classify, told_columns


@dataclass(frozen=True)
class PeriodGrain:
    name: str
    year: str
    period: str
    start: str
    end: str
    label_prefix: str
    comparison_label: str
    default_period_count: int
    delta_column: str


WEEKLY = PeriodGrain(
    "weekly", "report_year", "report_week", "week_start_date", "week_end_date", "W", "WoW", 8,
    "week_over_week_value_delta_usd",
)
MONTHLY = PeriodGrain(
    "monthly", "metric_year", "metric_month", "month_start_date", "month_end_date", "M", "MoM", 12,
    "month_over_month_value_delta_usd",
)
GRAINS = {"weekly": WEEKLY, "monthly": MONTHLY}

def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Latest snapshot per key group (rank-1 filter -> partial group limit)."""
    order = Window.partitionBy(*keys).orderBy(F.col("snapshot_date").desc())
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def current_claims(classified: DataFrame) -> DataFrame:
    """Latest snapshot of every claim (one row per claim)."""
    return _latest(classified, ["claim_number"])


def _period_dates(grain: PeriodGrain) -> dict[str, Column]:
    d = F.col("snapshot_date")
    if grain is WEEKLY:
        return {"week_start_date": cal.week_start(d), "week_end_date": cal.week_end(d)}
    return {
        "metric_year": cal.metric_year(d),
        "metric_month": cal.metric_month(d),
        "month_start_date": cal.month_start(d),
        "month_end_date": cal.month_end(d),
    }


def _period_columns(classified: DataFrame, grain: PeriodGrain) -> DataFrame:
    return classified.withColumns(_period_dates(grain))


def period_state(classified: DataFrame, grain: PeriodGrain) -> DataFrame:
    """Latest state of each claim in each period, with the previous observed
    period's status, tier 1 and value, the transition and the value delta."""
    observed = _period_columns(classified, grain)
    if grain is WEEKLY:
        keys = ["claim_number", "report_year", "report_week"]
    else:
        keys = ["claim_number", grain.year, grain.period]
    return _with_previous(_latest(observed, keys), grain)


def _claim_order() -> list[Column]:
    """The claim as a window's key, its hash first: a sort tells nearly all
    claims apart by a number that it keeps beside the row, where the first
    bytes of claim numbers are the same for many."""
    return [F.xxhash64("claim_number"), F.col("claim_number")]


def latest_per_period(staged: DataFrame, grain: PeriodGrain) -> DataFrame:
    """Latest staged snapshot per claim and period (week start / month start
    identify the period one-to-one)."""
    d = F.col("snapshot_date")
    period = cal.week_start(d) if grain is WEEKLY else cal.month_start(d)
    order = Window.partitionBy(*_claim_order(), period).orderBy(d.desc())
    return staged.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def latest_per_segment(df: DataFrame) -> DataFrame:
    """Latest snapshot per claim, report week *and* calendar month.

    Every row that is the latest of its week or of its month is the latest
    of its (week, month) segment, so ``weekly_state`` and ``monthly_state``
    over these rows equal the same marts over the full history.  Building
    both marts from it reads and thins the full history once instead of
    twice; it has at most (claim-weeks + claim-months) rows."""
    d = F.col("snapshot_date")
    order = Window.partitionBy(F.col("claim_number"), cal.week_start(d), cal.month_start(d)).orderBy(d.desc())
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def period_state_from_staged(staged: DataFrame, rates: DataFrame, grain: PeriodGrain) -> DataFrame:
    """``period_state(classify(staged, rates), grain)`` planned for skew.

    The latest snapshot per claim and period is picked first, on staged
    rows, with the partial group limit thinning every task before the
    shuffle.  Only those rows are classified (the re-open flag still looks
    at the whole history through the per-claim first-closed dates), so the
    join and the ``lag`` window see at most one row per claim and period."""
    return period_state_of_latest(latest_per_period(staged, grain), rates, grain, staged)


def period_state_of_latest(latest: DataFrame, rates: DataFrame, grain: PeriodGrain, history: DataFrame) -> DataFrame:
    """The second half of ``period_state_from_staged``, of the ``latest`` staged
    rows per claim and period and the staged ``history``."""
    classified = classify(latest, rates, history=history)
    return _with_previous(_period_columns(classified, grain), grain, _claim_order())


def current_from_staged(staged: DataFrame, rates: DataFrame) -> DataFrame:
    """``current_claims(classify(staged, rates))``, picking first (see
    ``period_state_from_staged``)."""
    return classify(_latest(staged, ["claim_number"]), rates, history=staged)


def _with_previous(latest: DataFrame, grain: PeriodGrain, claim: Sequence[Column | str] = ("claim_number",)) -> DataFrame:
    by_claim = Window.partitionBy(*claim).orderBy(grain.start)
    with_previous = latest.withColumns(
        {
            "previous_status": F.lag("status").over(by_claim),
            "previous_wbr_tier1": F.lag("wbr_tier1").over(by_claim),
            "previous_value_usd": F.lag("value_usd").over(by_claim),
        }
    )
    return with_previous.withColumns(_transition(grain))


def _transition(grain: PeriodGrain) -> dict[str, Column]:
    return {
        "status_changed": status_changed("status", "previous_status"),
        "transition_type": transition_type("status", "previous_status"),
        grain.delta_column: value_delta("value_usd", "previous_value_usd"),
    }


def told_of_state(grain: PeriodGrain, needed: Sequence[str] = ()) -> dict[str, Column]:
    """Columns of a period state that follow from others of their row (see
    ``told_columns``), without those ``needed`` before."""
    told = {**told_columns(), **_period_dates(grain), **_transition(grain)}
    return {name: c for name, c in told.items() if name not in needed}


def weekly_state(classified: DataFrame) -> DataFrame:
    return period_state(classified, WEEKLY)


def monthly_state(classified: DataFrame) -> DataFrame:
    return period_state(classified, MONTHLY)


def weekly_transitions(weekly: DataFrame) -> DataFrame:
    """Weekly rows whose status changed (null-changed rows drop out)."""
    return weekly.where(F.col("status_changed")).withColumnRenamed("status", "current_status").select(
        *S.TRANSITION_COLUMNS
    )


def period_metrics(state: DataFrame, grain: PeriodGrain) -> DataFrame:
    """Counts, value and transition counts per period and dimension group.

    One hash aggregate with map-side partial aggregation; null dimensions form
    their own groups."""
    none = F.lit(0).cast(S.USD_TYPE)
    tt = F.col("transition_type")
    return state.groupBy(grain.year, grain.period, grain.start, grain.end, *S.METRIC_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.round(total(F.coalesce(F.col("value_usd"), none)), 2).alias("claim_value_usd"),
        F.count_if(tt == S.NEW_CLAIM).alias("new_claim_count"),
        F.count_if(tt == S.OPEN_TO_CLOSED).alias("open_to_closed_count"),
        F.count_if(tt == S.CLOSED_TO_OPEN).alias("reopened_count"),
        F.count_if(F.col("status_changed")).alias("status_change_count"),
    )


def weekly_metrics(weekly: DataFrame) -> DataFrame:
    return period_metrics(weekly, WEEKLY)


def monthly_metrics(monthly: DataFrame) -> DataFrame:
    return period_metrics(monthly, MONTHLY)
