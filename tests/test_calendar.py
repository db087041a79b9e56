"""Report weeks: fixed edge dates and every day 1900-2100 against the
Thursday formula written out in plain Python."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from claimtide.functions import calendar as cal


def _bq_dow(d: date) -> int:  # 1 = Sunday ... 7 = Saturday
    return d.isoweekday() % 7 + 1


def thursday_formula(d: date) -> tuple[int, int, date]:
    thursday = d + timedelta(days=5 - _bq_dow(d))
    jan1 = date(thursday.year, 1, 1)
    first_thursday = jan1 + timedelta(days=(5 - _bq_dow(jan1) + 7) % 7)
    week = (thursday - first_thursday).days // 7 + 1
    start = d - timedelta(days=_bq_dow(d) - 1)
    return thursday.year, week, start


EDGES = [
    ("2020-12-31", 2020, 53, "2020-12-27"),
    ("2021-01-02", 2020, 53, "2020-12-27"),
    ("2021-01-03", 2021, 1, "2021-01-03"),
    ("2024-12-28", 2024, 52, "2024-12-22"),
    ("2024-12-29", 2025, 1, "2024-12-29"),
    ("2026-01-03", 2026, 1, "2025-12-28"),
    ("2026-01-04", 2026, 2, "2026-01-04"),
]


def test_edge_dates(spark):
    df = spark.createDataFrame([(d,) for d, *_ in EDGES] + [(None,)], "d string").select(
        F.col("d"),
        cal.report_year(F.to_date("d")).alias("y"),
        cal.report_week(F.to_date("d")).alias("w"),
        cal.week_start(F.to_date("d")).cast("string").alias("s"),
    )
    got = {r.d: (r.y, r.w, r.s) for r in df.collect()}
    for d, y, w, s in EDGES:
        assert got[d] == (y, w, s), d
    assert got[None] == (None, None, None)


def test_every_day_1900_2100(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'1900-01-01', DATE'2100-12-31', INTERVAL 1 DAY)) AS d"
    ).select(
        "d",
        cal.report_year("d").alias("y"),
        cal.report_week("d").alias("w"),
        cal.week_start("d").alias("s"),
        cal.week_end("d").alias("e"),
        cal.report_week_thursday("d").alias("t"),
    )
    rows = days.collect()
    assert len(rows) == 73414
    for r in rows:
        y, w, s = thursday_formula(r.d)
        assert (r.y, r.w, r.s) == (y, w, s), r.d
        assert r.e == s + timedelta(days=6)
        assert r.t == s + timedelta(days=4)
        assert 1 <= r.w <= 53
