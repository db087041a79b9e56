"""Demo data: two claims over two report weeks, and the six marts derived
from them with the library's own operators (a fixture for tests and for
trying the review/KPI operators without a warehouse)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimtide import schemas as S
from claimtide.operators.periods import (
    current_claims,
    monthly_metrics,
    monthly_state,
    weekly_metrics,
    weekly_state,
    weekly_transitions,
)

CLASSIFIED_SCHEMA = T.StructType(
    [
        T.StructField("claim_snapshot_key", T.StringType()),
        T.StructField("claim_number", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        *(T.StructField(c, T.StringType()) for c in S.TEXT_DIMENSIONS),
        T.StructField("currency", T.StringType()),
        *(T.StructField(name, T.DateType()) for name, _ in S.STAGED_DATES),
        T.StructField("value_of_trailer", S.VALUE_TYPE),
        *(
            T.StructField(c, T.LongType())
            for c in ("report_year", "report_week", "submitted_year", "submitted_week", "closed_year", "closed_week")
        ),
        T.StructField("wbr_tier1", T.StringType()),
        T.StructField("wbr_tier2", T.StringType()),
        T.StructField("wbr_tier3", T.StringType()),
        T.StructField("value_usd", S.USD_TYPE),
    ]
)

# claim, snapshot date, report year, report week, status, tier 1, tier 2, value
_DEMO_ROWS = (
    ("CLM-1001", date(2026, 6, 27), 2026, 26, "Open", "ACTIVE CASES", "In Process - Investigating", 28000),
    ("CLM-1002", date(2026, 6, 27), 2026, 26, "Closed", "CLOSED CASES", "Not Found", 22000),
    ("CLM-1001", date(2026, 7, 4), 2026, 27, "Closed", "CLOSED CASES", "Found And Returned", 28000),
    ("CLM-1002", date(2026, 7, 4), 2026, 27, "Open", "RE-OPEN CLAIMS", "Re-Opened", 22000),
)


def demo_classified(spark: SparkSession) -> DataFrame:
    rows = []
    for claim, snap, year, week, status, tier1, tier2, value in _DEMO_ROWS:
        row = {f.name: None for f in CLASSIFIED_SCHEMA.fields}
        row.update(
            claim_number=claim,
            snapshot_date=snap,
            carrier_name="Demo Carrier",
            country="US",
            status=status,
            source="Demo",
            currency="USD",
            value_of_trailer=Decimal(value),
            report_year=year,
            report_week=week,
            wbr_tier1=tier1,
            wbr_tier2=tier2,
            value_usd=Decimal(value),
        )
        rows.append(tuple(row[f.name] for f in CLASSIFIED_SCHEMA.fields))
    return spark.createDataFrame(rows, CLASSIFIED_SCHEMA)


def demo_marts(spark: SparkSession) -> dict[str, DataFrame]:
    classified = demo_classified(spark)
    weekly = weekly_state(classified)
    monthly = monthly_state(classified)
    return {
        "current": current_claims(classified),
        "weekly": weekly,
        "weekly_transitions": weekly_transitions(weekly),
        "weekly_metrics": weekly_metrics(weekly),
        "monthly": monthly,
        "monthly_metrics": monthly_metrics(monthly),
    }
