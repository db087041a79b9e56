"""Claim classification and period-transition expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimtide import schemas as S
from claimtide.functions.money import difference


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reopened_flag(status: Column | str, closed_before: Column) -> Column:
    """Open now and closed at an earlier snapshot.

    Three-valued like the SQL original: null when the status is null and the
    claim was closed before, false when it was never closed before.
    """
    return (_col(status) == S.STATUS_OPEN) & F.coalesce(closed_before, F.lit(False))


def wbr_tiers(
    status: Column | str = "status",
    is_reopened: Column | str = "is_reopened",
    reason: Column | str = "reason",
    results: Column | str = "results",
    claim_results: Column | str = "insurance_claims_results",
) -> tuple[Column, Column, Column]:
    """The three classification tiers of a snapshot.

    Tier 3 ignores re-opening: a re-opened snapshot may still get an
    open-claim tier 3 value.
    """
    status, is_reopened = _col(status), _col(is_reopened)
    reason, results, claim_results = _col(reason), _col(results), _col(claim_results)

    is_open = status == S.STATUS_OPEN
    is_closed = status == S.STATUS_CLOSED
    reopened = is_open & is_reopened
    waiting = claim_results == S.ICR_WAITING
    found = reason == S.REASON_FOUND
    not_found = F.coalesce(reason, F.lit("")) != S.REASON_FOUND

    tier1 = (
        F.when(reopened, S.TIER1_REOPENED)
        .when(is_open, S.TIER1_ACTIVE)
        .when(is_closed, S.TIER1_CLOSED)
        .otherwise(S.TIER1_ACTIVE)
    )

    tier2 = (
        F.when(reopened, S.TIER2_REOPENED)
        .when(is_open & waiting, S.TIER2_WAITING)
        .when(is_open, S.TIER2_IN_PROCESS)
        .when(is_closed & found, S.TIER2_FOUND_RETURNED)
        .when(is_closed & not_found, S.TIER2_NOT_FOUND)
        .otherwise(S.TIER2_IN_PROCESS)
    )

    open_waiting = is_open & waiting
    closed_found = is_closed & found
    closed_not_found = is_closed & not_found
    tier3 = (
        F.when(open_waiting & (reason == S.REASON_FOUND), S.TIER3_FOUND)
        .when(open_waiting & (reason == S.REASON_NO_DATA), S.TIER3_POTENTIAL_CLAIM)
        .when(open_waiting & (reason == S.REASON_NOT_IN_NETWORK), S.TIER3_NOT_IN_NETWORK)
        .when(closed_found & (results == S.RESULT_CARRIER_PICKED_UP), S.TIER3_CARRIER_PICKED_UP)
        .when(closed_found & (results == S.RESULT_TOWING_YARD), S.TIER3_TOWING_YARD)
        .when(closed_found & (results == S.RESULT_RECOVERED), S.TIER3_RECOVERED)
        .when(closed_found & (results == S.RESULT_NO_RESPONSE), S.TIER3_NO_RESPONSE)
        .when(closed_not_found & (claim_results == S.ICR_NOT_LIABLE), S.TIER3_NOT_LIABLE)
        .when(
            closed_not_found & (F.coalesce(claim_results, F.lit("")) != S.ICR_NOT_LIABLE),
            S.TIER3_LIABLE,
        )
    )
    return tier1, tier2, tier3


def status_changed(status: Column | str, previous_status: Column | str) -> Column:
    """Previous status known and different (null when the status is null)."""
    status, previous = _col(status), _col(previous_status)
    return previous.isNotNull() & (status != previous)


def transition_type(status: Column | str, previous_status: Column | str) -> Column:
    status, previous = _col(status), _col(previous_status)
    return (
        F.when(previous.isNull(), S.NEW_CLAIM)
        .when((previous == S.STATUS_OPEN) & (status == S.STATUS_CLOSED), S.OPEN_TO_CLOSED)
        .when((previous == S.STATUS_CLOSED) & (status == S.STATUS_OPEN), S.CLOSED_TO_OPEN)
        .when(previous != status, S.STATUS_CHANGED)
        .otherwise(S.NO_CHANGE)
    )


def value_delta(value: Column | str, previous_value: Column | str) -> Column:
    """``round(value - previous, 2)``, subtracted at scale 9 whatever their size."""
    return F.round(difference(value, previous_value), 2)
