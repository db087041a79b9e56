"""Tables written to the shared folder between the steps of an operator."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def every_column(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: computed once, its lineage cut, and read
    by every executor from the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes written tables that no result reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: one in so many rows makes a group a hot one; so many hot ones at most.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with their group's columns, by ``key``; ``groups`` has the
    number of rows of each group in ``size``.  Groups with a thousandth of the
    rows or more (a thousand at most) are broadcast, so no group, however
    large, meets in one task; the others are joined as usual."""
    hot = groups.where(F.col(size) >= max(2, rows.count() // HOT_SHARE))
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups, key)
    )
