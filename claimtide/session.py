"""Session helpers: a local session for tests/bench, the shared scratch folder
and size-checked broadcasting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows above which a "small" side is no longer broadcast explicitly.
BROADCAST_ROW_LIMIT = 10_000

#: session settings the operators are planned for (cluster and local alike):
#: AQE re-plans joins from measured sizes, splits skewed join and rebalance
#: partitions and merges small ones; partition sizes are targets per task.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimtide") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLAIMTIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a private one only where it is unset
    on a local master (tests, benchmarks).  A cluster must name a shared one."""
    value = checkpoint_dir(spark)
    if value:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(value)
        return value
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints and written tables"
        )
    value = tempfile.mkdtemp(prefix="claimtide-ckpt-")
    spark.conf.set("spark.checkpoint.dir", value)
    spark.sparkContext.setCheckpointDir(value)
    return value


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``limit`` rows.

    The check is ``limit(limit + 1).count()``: it stops reading after
    ``limit + 1`` rows, so checking a large side costs little.  Above the limit
    the side is returned unhinted and the planner/AQE choose the join.
    """
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df
