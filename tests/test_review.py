"""Review layer against the hand-derived demo answers (FIXTURES.md §3)."""

from __future__ import annotations

from claimtide.functions.formatting import comparison_text, display_column_name, money
from claimtide.operators import review as R
from claimtide.operators.extracts import (
    claims_extract,
    filter_options,
    has_rows,
    matching_caption,
    transitions_extract,
)
from claimtide.operators.periods import WEEKLY
from claimtide.sources.demo import demo_marts

NBSP = "\u00a0"


def test_demo_transitions_and_kpis(spark):
    marts = demo_marts(spark)
    tr = {r.claim_number: (r.transition_type, float(r.week_over_week_value_delta_usd))
          for r in marts["weekly_transitions"].collect()}
    assert tr == {"CLM-1001": ("OPEN_TO_CLOSED", 0.0), "CLM-1002": ("CLOSED_TO_OPEN", 0.0)}
    cards = {r.card: (r.value, r.delta, r.value_text, r.delta_text) for r in R.kpi_cards(marts["weekly_metrics"]).collect()}
    assert cards["Active claims"] == (0.0, -1.0, "0", "-1")
    assert cards["Closed claims"] == (1.0, 0.0, "1", "0")
    assert cards["Re-opened claims"] == (1.0, 1.0, "1", "1")
    assert cards["Claim value"] == (50000.0, 0.0, "$50,000", "$0")


def test_demo_weekly_review(spark):
    marts = demo_marts(spark)
    result = R.period_review(marts["weekly_metrics"], WEEKLY, "claim_count")
    assert (result.last_label, result.previous_label) == ("2026-W27", "2026-W26")
    pivot = result.pivot
    assert pivot.columns == ["WBR waterfall", "2026-W26", "2026-W27", "WoW"]
    rows = [tuple(r) for r in pivot.collect()]
    assert rows == [
        ("ACTIVE CASES", 1, 0, "-1 (-100.0%)"),
        (NBSP * 4 + "In Process - Investigating", 1, 0, "-1 (-100.0%)"),
        ("CLOSED CASES", 1, 1, "+0 (+0.0%)"),
        (NBSP * 4 + "Found And Returned", 0, 1, "+1 (new)"),
        (NBSP * 4 + "Not Found", 1, 0, "-1 (-100.0%)"),
        ("RE-OPEN CLAIMS", 0, 1, "+1 (new)"),
        (NBSP * 4 + "Re-Opened", 0, 1, "+1 (new)"),
    ]


def test_single_period_has_no_comparison(spark):
    marts = demo_marts(spark)
    one = marts["weekly_metrics"].where("report_week = 26")
    result = R.period_review(one, WEEKLY, "claim_value_usd")
    assert result.previous_label is None
    assert {r.WoW for r in result.pivot.collect()} == {"N/A"}
    cards = {r.card: (r.delta, r.delta_text) for r in R.kpi_cards(one).collect()}
    assert cards["Claim value"] == (None, None)


def test_comparison_text(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (5.0, 0.0), (5.0, 10.0), (0.0, -1200.0), (1234567.0, 1000.0), (9.0, 10000.0)],
        "cur double, prev double",
    )
    counts = [r[0] for r in df.select(comparison_text("cur", "prev", False)).collect()]
    values = [r[0] for r in df.select(comparison_text("cur", "prev", True)).collect()]
    assert counts[:3] == ["+0 (0.0%)", "+5 (new)", "-5 (-50.0%)"]
    assert values[3] == "+$1,200 (-100.0%)"
    assert counts[4] == "+1,233,567 (+123356.7%)"
    assert counts[5] == "-9,991 (-99.9%)"
    expected = [
        f"{(c - p):+,.0f} ({'new' if c else '0.0%'})" if p == 0 else f"{(c - p):+,.0f} ({(c - p) / p:+.1%})"
        for c, p in [(0.0, 0.0), (5.0, 0.0), (5.0, 10.0), (0.0, -1200.0), (1234567.0, 1000.0), (9.0, 10000.0)]
    ]
    assert counts == expected
    m = [r[0] for r in spark.createDataFrame([(1234.5,), (-1234.4,), (-0.4,)], "x double").select(money("x")).collect()]
    assert m == [f"${x:,.0f}" for x in (1234.5, -1234.4, -0.4)]


def test_hierarchy_sort_keys_bug_compatible(spark):
    rows = [
        (1, 1, "2024-01-07", "RE-OPEN CLAIMS", "Re-Opened", "Found", 3),
        (1, 1, "2024-01-07", "ACTIVE CASES", "Waiting For Reply From Insurance", "Found", 2),
    ]
    df = spark.createDataFrame(
        rows, "report_year int, report_week int, week_start_date string, wbr_tier1 string, "
        "wbr_tier2 string, wbr_tier3 string, claim_count long"
    )
    h = {(r.row_key, r.tier_level): r.sort_key for r in R.hierarchy_values(df, WEEKLY, "claim_count").collect()}
    assert h[("RE-OPEN CLAIMS|||Re-Opened|||Found", 3)] == "0400|Found|3|Re-Opened|Found"
    assert h[("RE-OPEN CLAIMS|||Re-Opened|||", 2)] == "1700|Re-Opened|2|Re-Opened|"
    assert h[("RE-OPEN CLAIMS||||||", 1)] == "1600||1||"


def test_headers_and_extracts(spark):
    assert display_column_name("wbr_tier1") == "WBR Tier 1"
    assert display_column_name("value_usd") == "Value USD"
    assert display_column_name("trailer_vin") == "Trailer VIN"
    marts = demo_marts(spark)
    ext = claims_extract(marts["current"], status=["Closed"], search="clm-100[1]")
    assert "Claim Snapshot Key" not in ext.columns and "Snapshot Date" not in ext.columns
    assert [r["Claim Number"] for r in ext.collect()] == ["CLM-1001"]
    tr = transitions_extract(marts["weekly_transitions"], transition_type=["CLOSED_TO_OPEN"])
    assert [r["Current Status"] for r in tr.collect()] == ["Open"]
    opts = {(r.dimension, r.value) for r in filter_options(marts["current"], ("status", "country")).collect()}
    assert opts == {("status", "Closed"), ("status", "Open"), ("country", "US")}


def test_captions_and_emptiness(spark):
    marts = demo_marts(spark)
    assert matching_caption(claims_extract(marts["current"]), "current claims") == "2 matching current claims"
    assert has_rows(marts["weekly_transitions"])
    assert not has_rows(claims_extract(marts["current"], country=["CA"]))


def test_numeric_sum_rules(spark):
    df = spark.createDataFrame([("ACTIVE CASES", "5", 2), ("ACTIVE CASES", "x", 3), ("CLOSED CASES", None, None)], "wbr_tier1 string, text string, claim_count int")
    sums = [R.numeric_sum(df, "text"), R.numeric_sum(df, "claim_count"), R.numeric_sum(df, "absent"), R.tier_metric(df, "ACTIVE CASES"), R.tier_metric(df, "OTHER"), R.tier_metric(df, "ACTIVE CASES", "absent")]
    assert list(df.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()) == [5.0, 5.0, 0.0, 5.0, 0.0, 0.0]
    assert list(df.limit(0).agg(R.numeric_sum(df, "claim_count"), R.tier_metric(df, "ACTIVE CASES")).first()) == [0.0, 0.0]


def test_orders_are_kept(spark):
    metrics = spark.createDataFrame([(2024, w, f"2024-0{m}-01", f"2024-0{m}-07") for w, m in ((9, 3), (1, 1), (5, 2))], "report_year int, report_week int, week_start_date string, week_end_date string")
    assert [r.report_week for r in R.period_dimension(metrics, WEEKLY).collect()] == [1, 5, 9]
    assert [p.label for p in R.collect_periods(metrics, WEEKLY)] == ["2024-W01", "2024-W05", "2024-W09"]
    rows = spark.createDataFrame([("a", "2024-01-07"), ("b", "2024-03-09"), ("c", "2024-02-10"), ("d", "2024-03-09")], "claim_number string, week_end_date string").repartition(4)
    days = [r["Week End Date"] for r in transitions_extract(rows).collect()]
    assert days == sorted(days, reverse=True) and len(days) == 4
