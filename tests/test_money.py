"""Money of up to 29 whole digits, against Python's decimals."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from conftest import raw_rows, snapshot
from pyspark.sql import functions as F

from claimtide.functions import money
from claimtide.functions.categories import value_delta
from claimtide.operators import quality as Q
from claimtide.plans.build import build
from claimtide.sources.seeds import currency_rates

UNIT = Decimal("0.000000001")
LIMIT = Decimal(10) ** 29


def numbers(rng):
    digits = rng.choice([0, 1, 5, 14, 15, 16, 18, 19, 20, 25, 28, 29])
    whole = rng.choice([rng.randrange(10**digits), 10**digits - 1])
    part = rng.choice([0, 1, 999_999_999, 500_000_000, rng.randrange(10**9)])
    return f"{rng.choice(['', '-'])}{whole}.{part:09d}"


def held(x):
    return x if abs(x) < LIMIT else None


def text(x):
    return None if x is None else format(x, "f")


def decimal_frame(spark, rows, columns):
    """Through text: pickled decimals keep 34 digits only."""
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    return df.select(*(F.col(c).cast("decimal(18,9)" if c == "r" else "decimal(38,9)").alias(c) for c in columns))


def test_product_and_difference_equal_exact_arithmetic(spark):
    rng = random.Random(2)
    rates = ["1", "0.7", "0.05", "1.37", "0.000000001", "999999999.999999999", "123456789.987654321", "0"]
    rows = [(numbers(rng), numbers(rng), rng.choice(rates)) for _ in range(3000)] + [(None, "1", "1"), ("1", None, "2"), ("-0.000000001", "0", "0.5"), ("0", "0", "1")]
    df = decimal_frame(spark, rows, ["a", "b", "r"])
    string = lambda c: c.cast("string")
    got = df.select(string(money.product("a", "r")).alias("p"), string(money.difference("a", "b")).alias("d"), string(value_delta("a", "b")).alias("d2")).collect()
    wide = 0
    with localcontext() as context:
        context.prec = 120
        for (a, b, r), row in zip(rows, got, strict=True):
            p = None if a is None else held((Decimal(a) * Decimal(r)).quantize(UNIT, ROUND_HALF_UP))
            d = None if a is None or b is None else held(Decimal(a) - Decimal(b))
            assert (row.p is None) == (p is None) and (p is None or Decimal(row.p) == p), (a, r, row.p)
            assert (row.d is None) == (d is None) and (d is None or Decimal(row.d) == d), (a, b, row.d)
            if d is not None:
                assert Decimal(row.d2) == d.quantize(Decimal("0.01"), ROUND_HALF_UP)
            wide += p is not None and abs(p) >= 10**19
    assert wide > 500


def test_total_carries(spark):
    """Only the result must fit, not what is added up on the way."""
    rng = random.Random(3)
    rows = [("99999999999999999999999999999.999999999",)] * 3 + [("-99999999999999999999999999999.999999999",)] * 3 + [("0.999999999",)] * 5000 + [("-1.5",)] * 700 + [(numbers(rng),) for _ in range(50)] + [(None,)] * 3
    rows = [r for r in rows if r[0] is None or abs(Decimal(r[0])) < 10**27 or r[0].endswith("9" * 10)]
    got = decimal_frame(spark, rows, ["a"]).repartition(5).agg(money.total("a").cast("string").alias("s")).first().s
    with localcontext() as context:
        context.prec = 120
        assert Decimal(got) == sum(Decimal(r[0]) for r in rows if r[0] is not None)
    none = decimal_frame(spark, [(None,)], ["a"]).agg(money.total("a").alias("s")).first().s
    assert none is None


def test_wide_values_go_from_raw_to_metrics_unchanged(spark):
    big, low = "98765432109876543210987654321.123456789", "12345678901234567890.000000001"
    raw = raw_rows(
        spark,
        [
            snapshot("A", "2024-01-01", "Open", value_of_trailer=low),
            snapshot("A", "2024-01-09", "Open", value_of_trailer=big),
            snapshot("B", "2024-01-01", "Open", value_of_trailer=low, currency="CAD", carrier_name="Carrier 2"),
            snapshot("C", "2024-01-01", "Open", value_of_trailer="1e28", carrier_name="Carrier 3"),
            snapshot("D", "2024-01-01", "Open", value_of_trailer="1e29", carrier_name="Carrier 4"),
        ],
    )
    graph = build(raw, currency_rates(spark))
    values = {(r.claim_number, str(r.snapshot_date)): r.v for r in graph["classified"].select("claim_number", "snapshot_date", F.col("value_usd").cast("string").alias("v")).collect()}
    assert values["A", "2024-01-09"] == big and values["A", "2024-01-01"] == low
    assert values["C", "2024-01-01"] == "1" + "0" * 28 + ".000000000"
    rate = {r.currency_code: r.rate_to_usd for r in currency_rates(spark).collect()}["CAD"]
    with localcontext() as context:
        context.prec = 60
        assert Decimal(values["B", "2024-01-01"]) == (Decimal(low) * rate).quantize(UNIT, ROUND_HALF_UP)
        delta = (Decimal(big) - Decimal(low)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    week = graph["weekly"].where("claim_number = 'A' and previous_status is not null")
    assert week.select(F.col("week_over_week_value_delta_usd").cast("string")).first()[0] == text(delta)
    metrics = {(r.carrier_name, str(r.week_start_date)): r.v for r in graph["weekly_metrics"].select("carrier_name", "week_start_date", F.col("claim_value_usd").cast("string").alias("v")).collect()}
    assert metrics["Carrier 1", "2024-01-07"] == "98765432109876543210987654321.12"
    assert metrics["Carrier 1", "2023-12-31"] == "12345678901234567890.00"
    checks = {r.check_name: r.failing_rows for r in Q.run_checks({Q.SOURCE: raw.where("claim_number <> 'D'")}).collect()}
    assert checks["assert_no_value_cut"] == 0
    assert {r.check_name: r.failing_rows for r in Q.run_checks({Q.SOURCE: raw}).collect()}["assert_no_value_cut"] == 1
