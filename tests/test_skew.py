"""A claim holding a third of the history: results equal a brute-force
pandas computation, and the plans thin rows per task before shuffling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL

from claimtide.operators.periods import WEEKLY, period_state_from_staged
from claimtide.operators.staging import stage_claims
from claimtide.sources.seeds import currency_rates
from claimtide.sources.testdata import testdata_history as adapted_history


def _skewed_history(spark):
    """The adapted test history with every third row moved to one claim
    (kept unique per day by dropping the clashing rows)."""
    raw = adapted_history(spark, SF_SMALL)
    hot = F.when(F.abs(F.hash("claim_number", "snapshot_date")) % 3 == 0, F.lit(" CLM-HOT ")).otherwise(
        F.col("claim_number")
    )
    moved = raw.withColumn("claim_number", hot)
    return moved.dropDuplicates(["claim_number", "snapshot_date"])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_claim_weekly_matches_brute_force(spark):
    staged = stage_claims(_skewed_history(spark)).cache()
    rates = currency_rates(spark)
    weekly = period_state_from_staged(staged, rates, WEEKLY)
    got = weekly.select("claim_number", "week_start_date", "snapshot_date", "status", "previous_status",
                        "wbr_tier1").toPandas()

    pdf = staged.select("claim_number", "snapshot_date", "status").toPandas()
    pdf["snapshot_date"] = pd.to_datetime(pdf["snapshot_date"])
    pdf["week_start"] = pdf["snapshot_date"] - pd.to_timedelta((pdf["snapshot_date"].dt.dayofweek + 1) % 7, unit="D")
    closed_first = pdf[pdf["status"] == "Closed"].groupby("claim_number")["snapshot_date"].min()
    latest = pdf.sort_values("snapshot_date").groupby(["claim_number", "week_start"]).tail(1).copy()
    latest = latest.sort_values(["claim_number", "week_start"])
    latest["previous_status"] = latest.groupby("claim_number")["status"].shift(1)
    first = latest["claim_number"].map(closed_first)
    reopened = (latest["status"] == "Open") & (first < latest["snapshot_date"])
    latest["tier1"] = "ACTIVE CASES"
    latest.loc[latest["status"] == "Closed", "tier1"] = "CLOSED CASES"
    latest.loc[reopened, "tier1"] = "RE-OPEN CLAIMS"

    assert len(got) == len(latest)
    hot_weeks = (latest["claim_number"] == "CLM-HOT").sum()
    assert hot_weeks > 50
    g = got.assign(snapshot_date=pd.to_datetime(got["snapshot_date"])).sort_values(["claim_number", "snapshot_date"])
    e = latest.sort_values(["claim_number", "snapshot_date"])
    assert list(g["snapshot_date"]) == list(e["snapshot_date"])
    assert list(g["previous_status"].fillna("-")) == list(e["previous_status"].fillna("-"))
    assert list(g["wbr_tier1"]) == list(e["tier1"])


def test_latest_rows_are_thinned_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        staged = stage_claims(_skewed_history(spark))
        weekly = period_state_from_staged(staged, currency_rates(spark), WEEKLY)
        plan = _plan(weekly)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the rank-1 filter is split: a partial limit below the exchange
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan
    # the per-claim first-closed dates come from a partial aggregate
    assert "partial_min" in plan
