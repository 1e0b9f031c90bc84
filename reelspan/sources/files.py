"""File sources: binary images and videos, key sheets, playlists."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspan.functions.text import base_name, image_mime, is_url, stem
from reelspan.operators import scan
from reelspan.operators.enrich import built_once
from reelspan.session import parts_of


def images(spark: SparkSession, path: str, glob: str = "*.webp") -> DataFrame:
    """(path, name, mime, content) of the images of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", base_name(F.col("path")).alias("name"), image_mime(F.col("path")).alias("mime"), "content")


def videos(spark: SparkSession, path: str, glob: str = "*.mp4") -> DataFrame:
    """(video_id, path, content) of the videos of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(stem(F.col("path")).alias("video_id"), "path", "content")


def decode(videos: DataFrame, decoder, rate: int = 1, wanted: DataFrame | None = None) -> DataFrame:
    """(video_id, frame_idx, pixels): decoder() is built once a worker and yields (index, bytes) of a video's content.

    Frames outside the stride, or outside `wanted` (video_id, frame_idx), go.
    """

    get = built_once(decoder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = get()
        for b in batches:
            for video_id, content in zip(b["video_id"], b["content"]):
                rows = [(video_id, i, bytes(x)) for i, x in f(bytes(content)) if i % rate == 0]
                if rows:
                    yield pd.DataFrame(rows, columns=["video_id", "frame_idx", "pixels"])

    frames = videos.select("video_id", "content").mapInPandas(run, "video_id string, frame_idx int, pixels binary")
    return frames if wanted is None else frames.join(wanted, ["video_id", "frame_idx"])


def key_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header; pos numbers its rows within a file."""
    rows = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return rows.toDF(*[c.strip() for c in rows.columns]).withColumn("pos", F.monotonically_increasing_id())


#: Bytes of contents that a task of a join by path sorts.
DEALT = 1 << 25

#: Cells that a sheet's reader takes as empty.
EMPTY = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def named_keys(cells: DataFrame, provider: str, at: str = "pos", cell: str = "token") -> DataFrame:
    """(token, name, place) of a headerless sheet's cells: empty ones dropped, white space trimmed, the first of equal tokens kept.

    place counts distinct tokens in order, a blank one included, which itself is no key; a name holds the token's ends and its place.
    """
    trimmed = cells.filter(F.col(cell).isNotNull() & ~F.col(cell).isin(*EMPTY)).select(F.regexp_replace(cell, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "").alias("token"), F.col(at).alias("pos"))
    firsts = trimmed.groupBy("token").agg(F.min("pos").alias("pos"))
    placed = scan.row_numbers(firsts, [], "pos", "place", 1 << 20).withColumn("place", F.col("place") - 1)
    return placed.filter("token <> ''").select("token", F.format_string(f"{provider}-%s...%s-%d", F.left("token", F.lit(4)), F.right("token", F.lit(4)), F.col("place")).alias("name"), "place")


def plain_keys(spark: SparkSession, path: str, provider: str = "mistral") -> DataFrame:
    """(token, name, place) of column 0 of a headerless CSV."""
    cells = spark.read.csv(path, header=False, schema="_c0 string").select(F.col("_c0").alias("token"), F.monotonically_increasing_id().alias("pos"))
    return named_keys(cells, provider)


def playlist(texts: DataFrame, key: str = "playlist_id", text: str = "text") -> DataFrame:
    """(key, pos, uri, is_variant, remote): a variant list gives its first sub-playlist, a media list its segments in order."""
    lines = texts.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    variant = F.max(F.trim("line").startswith("#EXT-X-STREAM-INF")).over(Window.partitionBy(key))
    uris = lines.withColumn("is_variant", variant).filter((F.trim("line") != "") & ~F.trim("line").startswith("#"))
    uris = uris.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy("line_no")) - 1)
    return uris.filter(~F.col("is_variant") | (F.col("pos") == 0)).select(key, "pos", F.trim("line").alias("uri"), "is_variant", is_url(F.trim("line")).alias("remote"))


def folder_of(path: Column) -> Column:
    """The path up to and with its last slash; empty without one."""
    return F.regexp_extract(path, r"^(.*/)?", 1)


def resolved(base: Column, uri: Column) -> Column:
    """uri beside the folder `base`; a URL or an absolute path as it stands; `.` and `..` are worked out, as far as there are folders."""
    path = F.when(is_url(uri) | uri.startswith("/"), uri).otherwise(F.concat(base, uri))
    steps = F.filter(F.split(path, "/"), lambda x: x != ".")
    walk = F.aggregate(steps, F.array().cast("array<string>"), lambda done, x: F.when((x == "..") & (F.size(done) > 0) & (F.element_at(done, -1) != ".."), F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.concat(done, F.array(x))))
    return F.when(is_url(path), path).otherwise(F.array_join(walk, "/"))


def segments_of_playlists(playlists: DataFrame, files: DataFrame, depth: int = 1, beside_own: bool = False) -> DataFrame:
    """(path, pos, segment, content, error) of playlists(path): the segments of each in order, with their bytes or why there are none.

    files(path, content) holds playlists, segments and what was fetched from URLs.  A variant list is followed to its first sub-playlist,
    up to `depth` times, by a join; what is a variant list still then has no segments.  Segments lie beside the first list, or with beside_own
    beside the list that names them.  Contents of segments are joined last, by path; lists are texts of a few lines a segment.
    Files are dealt by path once for all joins, to as many tasks as it takes for about DEALT bytes each, however many there are.
    """
    size = files.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    files = files.select("path", "content").repartition(max(parts_of(files), -(-size // DEALT)), "path")  # a number given is not merged into fewer
    found = playlists.select("path").distinct().withColumn("at", F.col("path"))
    texts = files.select(F.col("path").alias("at"), F.col("content").cast("string").alias("text"))
    whole = None
    for level in range(depth + 1):
        read = found.join(texts, "at", "left")
        gone = read.filter("text is null").select("path", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("segment"), F.concat(F.lit("no playlist "), "at").alias("error"))
        own = read.filter("text is not null").withColumn("list", F.struct("path", "at"))
        entries = playlist(own.select("list", "text"), "list").select("list.path", "list.at", "pos", "uri", "is_variant")
        base = folder_of(F.col("at") if beside_own else F.col("path"))
        rows = gone.unionByName(entries.filter("not is_variant").select("path", "pos", resolved(base, F.col("uri")).alias("segment"), F.lit(None).cast("string").alias("error")))
        whole = rows if whole is None else whole.unionByName(rows)
        found = entries.filter("is_variant").select("path", resolved(folder_of(F.col("at")), F.col("uri")).alias("at"))
    held = whole.join(files.select(F.col("path").alias("segment"), F.col("content").cast("binary").alias("content")), "segment", "left")
    return held.select("path", "pos", "segment", "content", F.coalesce("error", F.when(F.col("content").isNull(), F.concat(F.lit("no segment "), "segment"))).alias("error"))
