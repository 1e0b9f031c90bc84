"""Headers of MP4 and QuickTime files: frame rate, number of frames and length, without reading the pictures.

A file is a row of boxes, each with its length: the walk jumps from head to head and reads only what is inside `moov`, of which
the sample tables are read no further than their counts of time steps.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.functions.text import stem
from reelspan.sources.staging import opened

HEADERS = "video_id string, path string, fps double, frames long, seconds double, width int, height int, error string"
#: Boxes that hold boxes, on the way to the sample times.
INSIDE = {b"moov", b"trak", b"mdia", b"minf", b"stbl"}


def boxes(file, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, first byte inside, first byte behind) of the boxes between two places."""
    at = start
    while at + 8 <= end:
        file.seek(at)
        head = file.read(16)
        if len(head) < 8:
            raise ValueError("the file ends inside a box")
        size, kind, inside = struct.unpack(">I", head[:4])[0], head[4:8], at + 8
        if size == 1:  # a length of 64 bits
            if len(head) < 16:
                raise ValueError("the file ends inside a box")
            size, inside = struct.unpack(">Q", head[8:16])[0], at + 16
        elif size == 0:  # up to the end
            size = end - at
        if size < inside - at or at + size > end:
            raise ValueError(f"box {kind.decode('latin-1')} at {at} has a wrong length")
        yield kind, inside, at + size
        at += size


def _times(file, inside: int) -> tuple[int, int]:
    """Units a second and length, of a box of times (version 0 or 1)."""
    file.seek(inside)
    body = file.read(32)
    return struct.unpack(">IQ", body[20:32]) if body[0] == 1 else struct.unpack(">II", body[12:20])


def _tracks(file, start: int, end: int, track: dict | None = None) -> Iterator[dict]:
    for kind, inside, behind in boxes(file, start, end):
        if kind == b"trak":
            own: dict = {}
            for _ in _tracks(file, inside, behind, own):
                pass
            yield own
        elif kind in INSIDE:
            yield from _tracks(file, inside, behind, track)
        elif track is not None and kind == b"mdhd":
            track["scale"], track["length"] = _times(file, inside)
        elif track is not None and kind == b"hdlr":
            file.seek(inside + 8)
            track["kind"] = file.read(4)
        elif track is not None and kind == b"tkhd":
            file.seek(behind - 8)
            track["width"], track["height"] = (x >> 16 for x in struct.unpack(">II", file.read(8)))
        elif track is not None and kind == b"stts":
            file.seek(inside + 4)
            n = struct.unpack(">I", file.read(4))[0]
            frames = units = 0
            while n:  # a table of many steps comes in pieces
                rows = min(n, 1 << 16)
                for count, step in struct.iter_unpack(">II", file.read(8 * rows)):
                    frames, units = frames + count, units + count * step
                n -= rows
            track["frames"], track["units"] = frames, units


def header_of(file, size: int) -> dict:
    """fps, frames, seconds, width and height of the first video track.  The rate is a mean over all frames; 0 without any."""
    for kind, inside, behind in boxes(file, 0, size):
        if kind == b"moov":
            for t in _tracks(file, inside, behind):
                if t.get("kind") == b"vide" and "frames" in t and t.get("scale"):
                    return {"fps": t["frames"] * t["scale"] / t["units"] if t["units"] else 0.0, "frames": t["frames"], "seconds": t["units"] / t["scale"], "width": t.get("width"), "height": t.get("height")}
            raise ValueError("no video track with sample times")
    raise ValueError("no movie header")


def video_headers(spark: SparkSession, path: str, glob: str = "*.mp4") -> DataFrame:
    """HEADERS of the videos of a folder; a file that can't be read has its error and a rate of 0, an empty one no row.

    The driver lists the folder; where the files' paths are in a table, `headers_of` reads them without that.
    """
    return headers_of(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path))


def headers_of(files: DataFrame) -> DataFrame:
    """HEADERS of files(path)."""
    listed = files.select(stem(F.col("path")).alias("video_id"), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for video, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                row = {"video_id": video, "path": at, "fps": 0.0, "frames": None, "seconds": None, "width": None, "height": None, "error": None}
                store, own = opened(at)
                with store.open_input_file(own) as file:
                    try:
                        row |= header_of(file, file.size())
                    except (ValueError, struct.error) as e:
                        row["error"] = str(e)
                rows.append(row)
            kinds = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32()}
            fields = [f.split(" ") for f in HEADERS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])

    return listed.mapInArrow(run, HEADERS)
