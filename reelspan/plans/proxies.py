"""The driver's tables as the entities that the operators work on.

The tables hold no video: a user's event series stands for a video's frames (purchases for transition frames),
`embeddings` for features (labels for shots), `events` for requests (users for models), `documents` for
transcripts and audio segments, `conversations` for chat messages.  Semantics are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_micros(x: Column) -> Column:
    """Microseconds since 1970 of a time without a zone, read as UTC whatever the session's zone."""
    return F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), x).cast("timestamp"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_idx, p_single, event_id, value, ts)"""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), (F.row_number().over(w) - 1).alias("frame_idx"), F.when(F.col("event_type") == "purchase", 0.9).otherwise(0.1).cast("float").alias("p_single"), "event_id", "value", "ts")


FRAMES = "fr as (select user_id video_id, (row_number() over (partition by user_id order by ts, event_id) - 1)::int frame_idx, event_type = 'purchase' b, event_id, value, ts from events)"

SHOTS = (
    FRAMES
    + """,
f1 as (select *, coalesce((b <> lag(b) over (partition by video_id order by frame_idx))::int, 0) c from fr),
f2 as (select *, sum(c) over (partition by video_id order by frame_idx rows unbounded preceding) run from f1),
f3 as (select video_id, run, bool_or(b) b, min(frame_idx) lo, max(frame_idx) hi from f2 group by 1, 2),
f4 as (select *, max(hi) over (partition by video_id) last, bool_and(b) over (partition by video_id) allb from f3),
f5 as (select video_id, lo start_idx, case when allb then hi else least(hi + 1, last) end end_idx from f4 where not b or allb),
sh as (select video_id, row_number() over (partition by video_id order by start_idx)::int shot_id, start_idx, end_idx from f5)"""
)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, shot_id, frame_idx, embedding): one video, labels as shots."""
    return table(spark, sf_dir, "embeddings").select(F.lit(0).alias("video_id"), F.col("label").alias("shot_id"), F.col("vec_id").cast("int").alias("frame_idx"), "embedding")


def small_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features with shots of 50 rows at most by place, so that a shot stays small as the table grows."""
    return features(spark, sf_dir).withColumn("shot_id", F.floor(F.col("frame_idx") / 50).cast("int"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, model, start_s, end_s, success, has_images, response_s, event_id); times in seconds since 1970"""
    e = table(spark, sf_dir, "events")
    start = epoch_micros(F.col("ts"))
    return e.select(
        F.col("event_id").cast("string").alias("request_id"), F.col("user_id").alias("model"), (start / 1_000_000).alias("start_s"), ((start + F.floor(F.col("value") * 60_000_000)) / 1_000_000).alias("end_s"),
        (F.col("event_type") != "error").alias("success"), (F.col("event_type") == "view").alias("has_images"), F.col("value").alias("response_s"), "event_id", "props",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(media_id, seg_idx, size_bytes, dur_ms, dbfs): blocks of 100 documents of a source, in order, as one medium's segments."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat_ws("-", "source", F.floor(F.col("doc_id") / 2000).cast("string")).alias("media_id"), F.col("doc_id").alias("seg_idx"), F.col("n_chars").alias("size_bytes"), (F.col("n_chars") * 2).alias("dur_ms"), (-F.col("doc_id") % 70).cast("double").alias("dbfs"))


SEGMENTS = "sg as (select source || '-' || (doc_id // 2000) media_id, doc_id seg_idx, n_chars size_bytes, n_chars * 2 dur_ms, (-doc_id % 70)::double dbfs from documents)"
