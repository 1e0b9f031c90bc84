"""Keyframe metadata: joins with model results, repair, rendering, upload batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.functions.text import base64_of

UNKNOWN = "unknown"


def micro_batches(rows: DataFrame, size: int, keys: list[str], order: list[str]) -> DataFrame:
    """rows with batch_no: `size` rows a batch in order, the last batch with what is left."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / size))


def attach_results(stubs: DataFrame, results: DataFrame, on: list[str]) -> DataFrame:
    """Results with the keyframes they belong to; results of unknown keyframes go."""
    return results.join(stubs, on, "inner")


def missing_from(saved: DataFrame, metadata: DataFrame, on: list[str]) -> DataFrame:
    """Saved files without metadata."""
    return saved.join(metadata.select(*on), on, "left_anti")


def unknown_if_null(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(UNKNOWN))


def repair(metadata: DataFrame, saved: DataFrame, info: DataFrame, on: list[str], fields: list[str]) -> DataFrame:
    """metadata with a row for each saved file that lacked one, its fields from info or `unknown`."""
    lost = missing_from(saved, metadata, on).join(info, on, "left").select(*on, *[unknown_if_null(F.col(f)).alias(f) for f in fields])
    return metadata.select(*on, *[unknown_if_null(F.col(f)).alias(f) for f in fields]).unionByName(lost)


def zip_positions(batches: DataFrame, keys: list[str], items: str, responses: str) -> DataFrame:
    """Item i of a batch with response i; a missing or null response is "", further ones are ignored."""
    return batches.select(*keys, F.posexplode(items).alias("pos", "item"), responses).select(*keys, "pos", "item", F.coalesce(F.get(responses, F.col("pos")), F.lit("")).alias("response"))


def numeric_suffix(name: Column) -> Column:
    """frame_1000 sorts after frame_999."""
    return F.regexp_extract(name, r"(\d+)(?:\.\w+)?$", 1).cast("long")


def _json(x: Column) -> Column:
    """A number or string as JSON."""
    return F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")


def metadata_lines(frames: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, line_no, line): in order, the text of one JSON document a video, indented by three, its frames in numeric order.

    One row a frame, so that no task holds a whole document; write_documents() writes them.
    """
    fields = [("id", _json(F.col("id"))), ("time-stamp", _json(F.col("time_stamp"))), ("shot", _json(F.col("shot")))]
    tags = F.array_join(F.transform("tags", lambda t: F.concat(F.lit(" " * 12), _json(t))), ",\n")
    fields += [("tags", F.when(F.size("tags") == 0, "[]").otherwise(F.concat(F.lit("[\n"), tags, F.lit("\n" + " " * 9 + "]"))))]
    fields += [("ocr", _json(F.col("ocr"))), ("caption", _json(F.col("caption")))]
    body = F.concat_ws(",\n", *[F.concat(F.lit(" " * 9 + f'"{name}": '), F.coalesce(value, F.lit("null"))) for name, value in fields])
    w = Window.partitionBy(key).orderBy(numeric_suffix(F.col("frame_name")))
    name = F.concat(F.lit(" " * 6), _json(F.col("frame_name")), F.lit(": {\n"))
    end = F.when(F.lead(F.lit(1)).over(w).isNull(), "\n      }").otherwise("\n      },")
    rows = frames.select(key, F.row_number().over(w).alias("line_no"), F.concat(name, body, end).alias("line"))
    n = rows.groupBy(key).agg(F.max("line_no").alias("n"))
    ends = n.select(key, F.explode(F.array(F.struct(F.lit(0).alias("line_no"), F.concat(F.lit("{\n   "), _json(F.col(key).cast("string")), F.lit(": {")).alias("line")), F.struct((F.col("n") + 1).alias("line_no"), F.lit("   }\n}").alias("line")))).alias("x")).select(key, "x.*")
    return rows.unionByName(ends)


def summary_lines(keyframes: DataFrame, key: str = "video_id", shots: DataFrame | None = None) -> DataFrame:
    """(key, line_no, line): a header of totals and a blank line, then one line a keyframe, in numeric order.

    shots(key, shot_id) holds every shot; without it those that have a keyframe count.
    """
    total = (keyframes if shots is None else shots).groupBy(key).agg(F.countDistinct("shot_id").alias("shots"))
    head = keyframes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(total, key)
    head = head.select(key, F.posexplode(F.array(F.concat(F.lit("Video: "), F.col(key).cast("string")), F.concat(F.lit("Total shots: "), F.col("shots").cast("string")), F.concat(F.lit("Total keyframes: "), F.col("n").cast("string")), F.lit(""))).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy(numeric_suffix(F.col("frame_name")))
    line = F.format_string("%s.webp: Shot %d, Keyframe %d, Original Frame %d", F.col("frame_name"), F.col("shot_id").cast("int"), F.col("k_in_shot").cast("int"), F.col("frame_idx").cast("int"))
    return head.unionByName(keyframes.select(key, (F.row_number().over(w) + 3).alias("line_no"), line.alias("line")))


def upload_batches(files: DataFrame, metadata: DataFrame, size: int = 8, key: str = "video_id") -> DataFrame:
    """(key, batch_no, metadata_json, keyframes, is_final_batch): `size` images a batch by name; metadata in batch 0 only.

    A video without files has one batch without keyframes.
    """
    numbered = micro_batches(files, size, [key], ["name"])
    made = numbered.groupBy(key, "batch_no").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", base64_of(F.col("content")))))).alias("keyframes"))
    made = metadata.select(key, "metadata_json").join(made, key, "left").withColumn("batch_no", F.coalesce("batch_no", F.lit(0)))
    last = F.max("batch_no").over(Window.partitionBy(key))
    return made.select(key, "batch_no", F.when(F.col("batch_no") == 0, F.col("metadata_json")).alias("metadata_json"), "keyframes", (F.col("batch_no") == last).alias("is_final_batch"))


def layout_faults(listing: DataFrame, key: str = "video_id") -> DataFrame:
    """(key, has_metadata, n_webp, valid): an output folder needs metadata.json and an image at least."""
    out = listing.groupBy(key).agg(F.bool_or(F.lower("name") == "metadata.json").alias("has_metadata"), F.count_if(F.lower("name").endswith(".webp")).alias("n_webp"))
    return out.withColumn("valid", F.col("has_metadata") & (F.col("n_webp") > 0))


#: Models of this Python worker, by the call that asked for them.
_MODELS: dict = {}


def built_once(model: Callable) -> Callable:
    """A function that gives model(), built when a worker first asks and kept for its later tasks of the same query."""
    token = uuid.uuid4().hex

    def get():
        if token not in _MODELS:
            _MODELS.clear()  # models of earlier queries
            _MODELS[token] = model()
        return _MODELS[token]

    return get


def apply_model(rows: DataFrame, model: Callable, columns: str, keys: list[str]) -> DataFrame:
    """A model called once a batch: model() is built once a worker and maps a batch's rows (a pandas frame) to a frame of `columns`.

    Batches come to a task one behind the other, whole; it holds the batch it is at.
    """
    get = built_once(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f, held = get(), None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            own = frame[keys].apply(tuple, axis=1) if len(frame) else []
            edge = [0, *(i for i in range(1, len(frame)) if own.iat[i] != own.iat[i - 1])]
            for a, b in zip(edge, edge[1:]):
                yield f(frame.iloc[a:b].reset_index(drop=True))
            held = frame.iloc[edge[-1] :].reset_index(drop=True) if len(frame) else None
        if held is not None and len(held):
            yield f(held)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, columns)
