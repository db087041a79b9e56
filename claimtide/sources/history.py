"""Raw snapshot-history source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimtide.schemas import RAW_COLUMNS, RAW_SCHEMA


def read_history(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Full scan of the append-only history, projected to the 19 used columns.

    Parquet/ORC keep their stored types (staging safe-casts whatever it gets);
    text formats are read with an explicit all-string schema, never inferred.
    """
    reader = spark.read.options(**options)
    if fmt in ("csv", "json"):
        if fmt == "csv":
            reader = reader.option("header", "true")
        df = reader.schema(RAW_SCHEMA).format(fmt).load(path)
    else:
        df = reader.format(fmt).load(path)
    return df.select(*RAW_COLUMNS)


def history_table(spark: SparkSession, name: str) -> DataFrame:
    """The history registered as a catalog table."""
    return spark.table(name).select(*RAW_COLUMNS)
