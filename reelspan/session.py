"""A session with the settings that the queries are tuned for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """Adaptive execution with skew handling; UTC; master and settings as given (a cluster sets its own)."""
    b = SparkSession.builder.appName("reelspan").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    for k, v in settings.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; one of our own only where none is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="reelspan-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: what is asked for several times is made once."""
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
