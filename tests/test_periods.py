from __future__ import annotations

from conftest import raw_rows, snapshot

from claimtide.operators.classify import classify
from claimtide.operators.periods import (
    MONTHLY,
    WEEKLY,
    current_claims,
    current_from_staged,
    monthly_state,
    period_state_from_staged,
    weekly_metrics,
    weekly_state,
    weekly_transitions,
)
from claimtide.operators.staging import stage_claims
from claimtide.sources.seeds import currency_rates


def _weekly(spark, rows):
    cls = classify(stage_claims(raw_rows(spark, rows)), currency_rates(spark))
    return weekly_state(cls)


def test_transition_types(spark):
    rows = [
        # week 1 Open, week 2 Pending -> STATUS_CHANGED
        snapshot("S", "2024-01-08", "Open"),
        snapshot("S", "2024-01-15", "Pending"),
        # Open -> null: NO_CHANGE, status_changed null, not a transition
        snapshot("N", "2024-01-08", "Open"),
        snapshot("N", "2024-01-15", None),
        # null -> Open: NEW_CLAIM, status_changed false
        snapshot("B", "2024-01-08", None),
        snapshot("B", "2024-01-15", "Open"),
    ]
    weekly = _weekly(spark, rows)
    got = {
        (r.claim_number, str(r.snapshot_date)): (r.transition_type, r.status_changed)
        for r in weekly.collect()
    }
    assert got[("S", "2024-01-15")] == ("STATUS_CHANGED", True)
    assert got[("N", "2024-01-15")] == ("NO_CHANGE", None)
    assert got[("B", "2024-01-15")] == ("NEW_CLAIM", False)
    assert got[("S", "2024-01-08")] == ("NEW_CLAIM", False)
    changed = [(r.claim_number, r.current_status) for r in weekly_transitions(weekly).collect()]
    assert changed == [("S", "Pending")]


def test_gap_and_two_snapshots_in_a_week(spark):
    rows = [
        snapshot("G", "2024-01-02", "Open", value_of_trailer="100"),
        snapshot("G", "2024-01-05", "Closed", value_of_trailer="150.555"),  # same week, later
        snapshot("G", "2024-02-01", "Open", value_of_trailer="100.5"),  # weeks later
    ]
    weekly = _weekly(spark, rows).orderBy("week_start_date").collect()
    assert len(weekly) == 2
    first, second = weekly
    assert first.status == "Closed" and str(first.snapshot_date) == "2024-01-05"
    assert second.previous_status == "Closed" and second.transition_type == "CLOSED_TO_OPEN"
    assert str(second.week_over_week_value_delta_usd) == "-50.06"  # round half away from zero


def test_null_dimension_group_kept(spark):
    rows = [
        snapshot("A", "2024-01-08", "Open", carrier_name=None),
        snapshot("B", "2024-01-08", "Open", carrier_name=None, value_of_trailer=None),
    ]
    m = weekly_metrics(_weekly(spark, rows)).collect()
    assert len(m) == 1
    assert m[0].carrier_name is None and m[0].claim_count == 2
    assert str(m[0].claim_value_usd) == "1000.00"
    assert m[0].new_claim_count == 2


def test_from_staged_equals_from_classified(spark):
    rows = []
    for i, day in enumerate(["2024-01-01", "2024-01-03", "2024-01-09", "2024-02-02", "2024-02-28", "2024-03-01"]):
        rows.append(snapshot("X", day, ["Open", "Closed"][i % 2], value_of_trailer=str(100 + i)))
        rows.append(snapshot("Y", day, ["Closed", "Open", "Open"][i % 3]))
    staged = stage_claims(raw_rows(spark, rows))
    rates = currency_rates(spark)
    cls = classify(staged, rates)
    for grain, direct in ((WEEKLY, weekly_state(cls)), (MONTHLY, monthly_state(cls))):
        planned = period_state_from_staged(staged, rates, grain)
        assert planned.columns == direct.columns
        assert sorted(map(tuple, planned.collect())) == sorted(map(tuple, direct.collect()))
    assert sorted(map(tuple, current_from_staged(staged, rates).collect())) == sorted(
        map(tuple, current_claims(cls).collect())
    )
