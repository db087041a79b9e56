from __future__ import annotations

from conftest import raw_rows, snapshot

from claimtide.operators.classify import classify, detect_reopened
from claimtide.operators.staging import stage_claims
from claimtide.sources.seeds import currency_rates


def _classified(spark, rows):
    return classify(stage_claims(raw_rows(spark, rows)), currency_rates(spark))


def test_reopen_sequence(spark):
    statuses = ["Open", "Closed", "Open", "Closed", "Open"]
    rows = [snapshot("R", f"2024-01-0{i + 1}", s) for i, s in enumerate(statuses)]
    flags = detect_reopened(stage_claims(raw_rows(spark, rows))).orderBy("snapshot_date").collect()
    assert [f.is_reopened for f in flags] == [False, False, True, False, True]


def test_reopen_null_status(spark):
    rows = [snapshot("N", "2024-01-01", "Closed"), snapshot("N", "2024-01-02", None)]
    flags = detect_reopened(stage_claims(raw_rows(spark, rows))).orderBy("snapshot_date").collect()
    assert [f.is_reopened for f in flags] == [False, None]
    last = _classified(spark, rows).orderBy("snapshot_date").collect()[-1]
    assert (last.wbr_tier1, last.wbr_tier2, last.wbr_tier3) == ("ACTIVE CASES", "In Process - Investigating", None)


def test_tier_cases(spark):
    rows = [
        # re-opened + waiting + Found -> tier 3 still "Found"
        snapshot("T1", "2024-01-01", "Closed"),
        snapshot("T1", "2024-01-02", "Open", insurance_claims_results="Waiting For Reply", reason="Found"),
        # closed, null reason, null result
        snapshot("T2", "2024-01-01", "Closed"),
        # closed, Found, other result
        snapshot("T3", "2024-01-01", "Closed", reason="Found", results="Other"),
        # closed, not found, not liable
        snapshot("T4", "2024-01-01", "Closed", reason="X", insurance_claims_results="Amazon Not Liable"),
        # open, waiting, potential claim
        snapshot("T5", "2024-01-01", "Open", insurance_claims_results="Waiting For Reply",
                 reason="No Data Found On Amazon Network"),
        # closed, found, carrier picked up
        snapshot("T6", "2024-01-01", "Closed", reason="Found", results="Carrier Has & Picked Up"),
        # unknown status
        snapshot("T7", "2024-01-01", "Pending"),
        # case sensitive status
        snapshot("T8", "2024-01-01", "open"),
    ]
    got = {
        (r.claim_number, str(r.snapshot_date)): (r.wbr_tier1, r.wbr_tier2, r.wbr_tier3)
        for r in _classified(spark, rows).collect()
    }
    assert got[("T1", "2024-01-02")] == ("RE-OPEN CLAIMS", "Re-Opened", "Found")
    assert got[("T2", "2024-01-01")] == ("CLOSED CASES", "Not Found", "Liable")
    assert got[("T3", "2024-01-01")] == ("CLOSED CASES", "Found And Returned", None)
    assert got[("T4", "2024-01-01")] == ("CLOSED CASES", "Not Found", "Not Liable")
    assert got[("T5", "2024-01-01")] == ("ACTIVE CASES", "Waiting For Reply From Insurance", "Not Found / Potential Claim")
    assert got[("T6", "2024-01-01")] == ("CLOSED CASES", "Found And Returned", "Carrier Picked Up")
    assert got[("T7", "2024-01-01")] == ("ACTIVE CASES", "In Process - Investigating", None)
    assert got[("T8", "2024-01-01")] == ("ACTIVE CASES", "In Process - Investigating", None)


def test_report_weeks_of_dates(spark):
    rows = [snapshot("W", "2024-12-29", "Closed", submitted="2021-01-02", case_date_closed="2024-12-28")]
    r = _classified(spark, rows).collect()[0]
    assert (r.report_year, r.report_week) == (2025, 1)
    assert (r.submitted_year, r.submitted_week) == (2020, 53)
    assert (r.closed_year, r.closed_week) == (2024, 52)


def test_a_currency_code_with_two_rates_is_refused(spark):
    from decimal import Decimal

    import pytest

    from claimtide.operators.classify import convert_currency
    from claimtide.operators.staging import stage_claims
    from claimtide.operators.quality import CURRENCY, run_checks
    from claimtide.schemas import CURRENCY_SCHEMA

    rates = spark.createDataFrame([("USD", "a", Decimal(1)), ("USD", "b", Decimal(2)), (None, "c", Decimal(1)), (None, "d", Decimal(1))], CURRENCY_SCHEMA)
    with pytest.raises(ValueError, match="USD"):
        convert_currency(stage_claims(raw_rows(spark, [snapshot("A", "2024-01-01", "Open")])), rates)
    assert [(r.check_name, r.failing_rows) for r in run_checks({CURRENCY: rates}).collect()] == [("unique:currency:currency_code", 1)]
