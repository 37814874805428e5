"""Session set-up, and tables written once so that later steps can share them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# A side is broadcast only when it is known to hold at most this many rows.
BROADCAST_ROWS = 300_000
# A table of words is sent to every task only up to this many bytes of text.
BROADCAST_BYTES = 32 << 20

# Arrow batches for Python: rows of text may be long, and a step holds several copies of a batch.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches near 8 MB, as a Python worker of each task holds some copies of one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def build_session(app: str) -> SparkSession:
    """Session of a job; master, memory and shared folders come from ``spark-submit``."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it; else one beside its tables."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table outlives lost executors, fixes whatever order or range
    boundaries the rows were given, and is not computed again by later steps.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised table for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= max_rows else df
