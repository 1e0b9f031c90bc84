"""Frame sampling, shots from transition scores, frames of shots."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.operators import scan
from reelspan.operators.enrich import built_once

THRESHOLD = 0.3


def over_threshold(p: Column, threshold: float = THRESHOLD) -> Column:
    """Strictly greater, compared as 32-bit floats: 0.3f does not exceed 0.3."""
    return p.cast("float") > F.lit(threshold).cast("float")


def shots_from_scores(scores: DataFrame, threshold: float = THRESHOLD, key: str = "video_id", at: str = "frame_idx", p: str = "p_single", block: int = 1 << 16) -> DataFrame:
    """(key, shot_id, start_idx, end_idx), both ends inclusive.

    A maximal run of frames at or under the threshold is a shot; it takes in the first transition frame
    after it.  A series of transition frames only is one shot; an empty series has none; a null score is none over the
    threshold.  A series is scanned in blocks of `block` frames.
    """
    runs = scan.runs(scores, [key], at, over_threshold(F.col(p), threshold), block)
    alone = F.col("flag") & F.col("begins") & F.col("ends")
    found = runs.filter(~F.col("flag") | alone).select(key, F.col("lo").alias("start_idx"), (F.col("hi") + F.when(F.col("ends"), 0).otherwise(1)).alias("end_idx"))
    return scan.row_numbers(found, [key], "start_idx", "shot_id", block).select(key, "shot_id", "start_idx", "end_idx")


def frames_of_shots(frames: DataFrame, shots: DataFrame, key: str = "video_id", at: str = "frame_idx", block: int = 64) -> DataFrame:
    """Frames with the shot that holds them (inclusive bounds): a range join as a hash join on blocks of `block` frames."""
    spread = shots.withColumn("block", F.explode(F.sequence(F.floor(F.col("start_idx") / block), F.floor(F.col("end_idx") / block))))
    held = frames.withColumn("block", F.floor(F.col(at) / block)).join(spread, [key, "block"])
    return held.filter(F.col(at).between(F.col("start_idx"), F.col("end_idx"))).drop("block")


def every(frames: DataFrame, rate: int, at: str = "frame_idx") -> DataFrame:
    """Stride sampling with one phase for the whole series."""
    return frames.filter(F.pmod(F.col(at), F.lit(rate)) == 0)


def every_in_shot(frames: DataFrame, rate: int, at: str = "frame_idx") -> DataFrame:
    """Stride sampling that begins anew at each shot's start_idx."""
    return frames.filter(F.pmod(F.col(at) - F.col("start_idx"), F.lit(rate)) == 0)


def decimate(frames: DataFrame, most: int, keys: list[str], at: str = "frame_idx") -> DataFrame:
    """Every (n div most)-th frame of a group of n; not a hard cap, up to 2 * most - 1 frames stay."""
    w = Window.partitionBy(*keys)
    ranked = frames.withColumn("_i", F.row_number().over(w.orderBy(at)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    return ranked.filter(F.col("_i") % F.greatest(F.lit(1), F.floor(F.col("_n") / most)) == 0).drop("_i", "_n")


def sliding_windows(frames: DataFrame, key: str = "video_id", at: str = "frame_idx", width: int = 100, stride: int = 50) -> DataFrame:
    """(key, window_id, slot, frame_idx, kept): overlapping windows over a series padded with its first and last frames.

    The first window begins width/4 slots before frame 0; slots width/4 to width/4 + stride - 1 of each
    window are kept, so each frame is kept once.
    """
    lead = (width - stride) // 2
    spans = frames.groupBy(key).agg((F.max(at) + 1).alias("n"))
    spans = spans.withColumn("window_id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / stride).cast("int") - 1)))
    slots = spans.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).withColumn("raw", F.col("window_id") * stride + F.col("slot") - lead)
    return slots.select(key, "window_id", "slot", F.greatest(F.lit(0), F.least(F.col("raw"), F.col("n") - 1)).cast("int").alias(at), (F.col("slot").between(lead, lead + stride - 1) & (F.col("raw") < F.col("n"))).alias("kept"))


def number_frames(frames: DataFrame, key: str = "video_id") -> DataFrame:
    """frame_no and frame_name, in the order of shots and of keyframes inside them; names grow beyond three digits."""
    n = F.row_number().over(Window.partitionBy(key).orderBy("shot_id", "k_in_shot"))
    return frames.withColumn("frame_no", n).withColumn("frame_name", F.format_string("frame_%03d", F.col("frame_no")))


def score_frames(frames: DataFrame, model, key: str = "video_id", at: str = "frame_idx", width: int = 100, stride: int = 50) -> DataFrame:
    """(key, frame_idx, p_single): model(), built once a worker, scores windows of `width` frames; the middle `stride` scores of each are kept.

    frames(key, frame_idx, pixels); the model maps a window's list of pixels to a score each.  A window fits in a task.
    """
    slots = sliding_windows(frames, key, at, width, stride).join(frames.select(key, at, "pixels"), [key, at])
    kind = f"{key} {frames.schema[key].dataType.simpleString()}, {at} int, p_single float"

    get = built_once(model)

    def run(window: pd.DataFrame) -> pd.DataFrame:
        window = window.sort_values("slot")
        window["p_single"] = list(get()(window["pixels"].tolist()))
        return window.loc[window["kept"], [key, at, "p_single"]]

    return slots.groupBy(key, "window_id").applyInPandas(run, kind)
