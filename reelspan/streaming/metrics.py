"""Streaming forms of the request metrics; each equals its batch form once the watermark has passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_minute(requests: DataFrame, at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Requests of each minute, evicted once the watermark passes."""
    return requests.withWatermark(at, late).groupBy(F.window(at, "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("minute"), "n")


def hopping_rate(requests: DataFrame, at: str = "ts", late: str = "10 minutes", minutes: int = 5) -> DataFrame:
    """Mean requests a minute over the last `minutes` minutes, every minute."""
    w = requests.withWatermark(at, late).groupBy(F.window(at, f"{minutes} minutes", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.end").alias("until"), (F.col("n") / F.lit(float(minutes))).alias("rpm"))


def correlate(starts: DataFrame, ends: DataFrame, late: str = "10 minutes", longest: str = "1 hour") -> DataFrame:
    """Starts with their ends: a stream-stream join on the request id, bounded in time; other ends are ignored."""
    a = starts.withWatermark("start_ts", late)
    b = ends.withColumnRenamed("request_id", "_id").withWatermark("end_ts", late)
    return a.join(b, F.expr(f"request_id = _id and end_ts >= start_ts and end_ts <= start_ts + interval {longest}")).drop("_id")


def snapshots(requests: DataFrame, sink, seconds: int = 1):
    """Running counters handed to sink(frame, epoch) every `seconds` seconds; returns the query."""
    counts = requests.groupBy("model").agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("succeeded"))
    return counts.writeStream.outputMode("update").foreachBatch(sink).trigger(processingTime=f"{seconds} seconds").start()
