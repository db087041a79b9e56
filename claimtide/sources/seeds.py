"""Reference tables: currency rates and the category hierarchy."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.schemas import (
    CATEGORY_HIERARCHY,
    CATEGORY_SCHEMA,
    CURRENCY_RATES,
    CURRENCY_SCHEMA,
)


def currency_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Currency seed (code, name, rate_to_usd decimal(18,9)).

    ``path`` reads a seed CSV with a header; without it the built-in rates
    are used.
    """
    if path:
        return spark.read.schema(CURRENCY_SCHEMA).option("header", "true").csv(path)
    rows = [(code, name, Decimal(rate)) for code, name, rate in CURRENCY_RATES]
    return spark.createDataFrame(rows, CURRENCY_SCHEMA)


def category_hierarchy(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Category seed; labels keep their leading spaces, blank match -> null."""
    if path:
        df = (
            spark.read.schema(CATEGORY_SCHEMA)
            .option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(path)
        )
        return df.withColumn("tier_match_value", F.nullif(F.col("tier_match_value"), F.lit("")))
    return spark.createDataFrame(list(CATEGORY_HIERARCHY), CATEGORY_SCHEMA)
