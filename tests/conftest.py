from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from claimtide.schemas import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("claimtide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="claimtide-test-ckpt-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def raw_rows(spark, rows: list[dict]):
    """Raw history DataFrame (all strings) from partial dicts."""
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def snapshot(claim: str, day: str, status: str | None, **extra) -> dict:
    base = {
        "claim_number": claim,
        "snapshot_date": day,
        "status": status,
        "source": "Provider A",
        "country": "US",
        "carrier_name": "Carrier 1",
        "submitted": "2024-01-01",
        "currency": "USD",
        "value_of_trailer": "1000",
    }
    base.update(extra)
    return base
