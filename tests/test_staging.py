from __future__ import annotations

from decimal import Decimal

from conftest import raw_rows, snapshot

from claimtide.operators.classify import classify, convert_currency
from claimtide.operators.staging import stage_claims
from claimtide.sources.seeds import currency_rates


def test_blank_keys_and_bad_dates_dropped(spark):
    rows = [
        snapshot("  ", "2024-01-01", "Open"),
        snapshot(None, "2024-01-01", "Open"),
        snapshot("  ", "2024-01-01", "Open"),
        snapshot("C1", "2024", "Open"),
        snapshot("C1", "2024-13-01", "Open"),
        snapshot("C1", "", "Open"),
        snapshot("C1", "2024-06", "Open"),
        snapshot("C1", "2024-06-01 10:00:00", "Open"),
        snapshot(" C1 ", "2024-6-5", "Open"),
    ]
    staged = stage_claims(raw_rows(spark, rows)).collect()
    assert [(r.claim_number, str(r.snapshot_date)) for r in staged] == [("C1", "2024-06-05")]


def test_currency_and_values(spark):
    rows = [
        snapshot("A", "2024-01-01", "Open", currency=" cad ", value_of_trailer="1000"),
        snapshot("B", "2024-01-01", "Open", currency="", value_of_trailer="1,200"),
        snapshot("C", "2024-01-01", "Open", currency=None, value_of_trailer="0.1234567895"),
        snapshot("D", "2024-01-01", "Open", currency="MXN", value_of_trailer=None),
    ]
    conv = convert_currency(stage_claims(raw_rows(spark, rows)), currency_rates(spark))
    got = {r.claim_number: (r.currency, r.value_of_trailer, r.value_usd) for r in conv.collect()}
    assert got["A"] == ("CAD", Decimal("1000.000000000"), Decimal("700.000000000"))
    assert got["B"] == ("USD", None, None)
    assert got["C"] == ("USD", Decimal("0.123456790"), Decimal("0.123456790"))
    assert got["D"] == ("MXN", None, None)


def test_classified_schema_and_key(spark):
    rows = [snapshot("A", "2024-01-01", "Open")]
    cls = classify(stage_claims(raw_rows(spark, rows)), currency_rates(spark))
    assert len(cls.columns) == 30
    r = cls.collect()[0]
    import hashlib

    assert r.claim_snapshot_key == hashlib.md5(b"A-2024-01-01").hexdigest()
    assert str(cls.schema["value_usd"].dataType) == "DecimalType(38,9)"


def test_instants_count_by_their_day_in_utc(spark):
    from pyspark.sql import functions as F

    from claimtide.functions.text import safe_date

    df = spark.createDataFrame([("2024-03-01T00:30:00Z",), ("2024-03-01T23:30:00Z",), ("1969-12-31T23:59:59Z",), (None,)], "t string").select(F.to_timestamp("t").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [str(r[0]) for r in df.select(safe_date("t", df.schema["t"].dataType)).collect()] == ["2024-03-01", "2024-03-01", "1969-12-31", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
