"""Random claim histories: the re-open flag equals a running max over earlier
rows (the original definition), and the skew-planned marts equal the direct
composition over the classified table."""

from __future__ import annotations

from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import raw_rows, snapshot

from claimtide.operators.classify import classify, detect_reopened
from claimtide.operators.periods import (
    MONTHLY,
    WEEKLY,
    current_claims,
    current_from_staged,
    latest_per_segment,
    monthly_state,
    period_state_from_staged,
    weekly_state,
)
from claimtide.operators.staging import stage_claims
from claimtide.sources.seeds import currency_rates

STATUSES = st.sampled_from(["Open", "Closed", None, "Pending"])
DAY0 = date(2023, 12, 20)


@st.composite
def histories(draw):
    rows = []
    for claim in ("A", "B", "C"):
        days = draw(st.lists(st.integers(min_value=0, max_value=80), min_size=1, max_size=12, unique=True))
        for d in days:
            rows.append((claim, DAY0 + timedelta(days=d), draw(STATUSES), draw(st.integers(0, 5000))))
    return rows


def _raw(spark, rows):
    return raw_rows(
        spark, [snapshot(c, d.isoformat(), s, value_of_trailer=str(v)) for c, d, s, v in rows]
    )


def _brute_reopened(rows):
    out = {}
    by_claim = {}
    for c, d, s, _v in sorted(rows, key=lambda r: (r[0], r[1])):
        prior_closed = by_claim.get(c, False)
        out[(c, d)] = None if s is None and prior_closed else (s == "Open" and prior_closed)
        by_claim[c] = prior_closed or s == "Closed"
    return out


@settings(max_examples=12, deadline=None)
@given(histories())
def test_reopened_equals_running_max(spark, rows):
    got = {(r.claim_number, r.snapshot_date): r.is_reopened
           for r in detect_reopened(stage_claims(_raw(spark, rows))).collect()}
    assert got == _brute_reopened(rows)


@settings(max_examples=6, deadline=None)
@given(histories())
def test_planned_marts_equal_direct(spark, rows):
    staged = stage_claims(_raw(spark, rows))
    rates = currency_rates(spark)
    cls = classify(staged, rates)
    pairs = (
        (period_state_from_staged(staged, rates, WEEKLY), weekly_state(cls)),
        (period_state_from_staged(staged, rates, MONTHLY), monthly_state(cls)),
        (current_from_staged(staged, rates), current_claims(cls)),
        (weekly_state(latest_per_segment(cls)), weekly_state(cls)),
        (monthly_state(latest_per_segment(cls)), monthly_state(cls)),
    )
    for planned, direct in pairs:
        assert planned.columns == direct.columns
        assert sorted(map(tuple, planned.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
