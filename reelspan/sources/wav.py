"""PCM audio: WAV headers, loudness and speech from samples, and the samples of stretches of time.

A file's header is read alone; its samples are dealt in pieces of PIECE_MS, each read by its own range, so a long recording is
in many tasks and a task holds one piece.  Sums of squares are exact for samples of up to 24 bits.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.functions.text import stem
from reelspan.operators import scan
from reelspan.session import cut, parts_of
from reelspan.sources.staging import opened

PIECE_MS = 60_000
PIECES = "media_id string, path string, rate int, channels int, width int, data_at long, frames long, len_ms long, from_ms long, to_ms long"


@dataclass
class Header:
    rate: int
    channels: int
    width: int
    data_at: int
    frames: int

    def ms(self) -> int:
        return round(1000 * self.frames / self.rate)


def header_of(file, size: int) -> Header:
    """The format and place of the samples; chunks that are not needed are jumped over.  A data chunk longer than the file ends with it."""
    head = file.read(12)
    if len(head) < 12 or head[:4] not in (b"RIFF", b"RF64") or head[8:] != b"WAVE":
        raise ValueError("no WAVE file")
    at, form = 12, None
    while at + 8 <= size:
        file.seek(at)
        kind, n = struct.unpack("<4sI", file.read(8))
        if kind == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", (body := file.read(min(n, 40)))[:16])
            code = struct.unpack("<H", body[24:26])[0] if code == 0xFFFE and len(body) >= 26 else code
            if code != 1 or bits not in (8, 16, 24, 32) or not rate or not channels:
                raise ValueError(f"not PCM of 8, 16, 24 or 32 bits: format {code}, {bits} bits")
            form = (rate, channels, bits // 8)
        elif kind == b"data":
            if form is None:
                raise ValueError("samples before their format")
            return Header(*form, at + 8, min(n, size - at - 8) // (form[1] * form[2]))
        at += 8 + n + n % 2
    raise ValueError("no samples")


def decoded(data: bytes, width: int) -> np.ndarray:
    """Samples as signed numbers, channels side by side."""
    if width == 1:
        return np.frombuffer(data, np.uint8).astype(np.int64) - 128
    if width == 3:
        raw = np.frombuffer(data, np.uint8).reshape(-1, 3).astype(np.int64)
        return ((raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16) ^ 0x800000) - 0x800000
    return np.frombuffer(data, "<i2" if width == 2 else "<i4").astype(np.int64)


def _ranged(store, path: str, h: Header, from_ms: int, to_ms: int) -> tuple[bytes, np.ndarray]:
    """The bytes of [from_ms, to_ms) and the first frame of each ms, and of the end, from the first one on."""
    edges = np.minimum(np.arange(from_ms, to_ms + 1) * h.rate // 1000, h.frames)
    frame = h.channels * h.width
    with store.open_input_file(path) as f:
        f.seek(h.data_at + int(edges[0]) * frame)
        return f.read(int(edges[-1] - edges[0]) * frame), edges - edges[0]


def _squares(data: bytes, edges: np.ndarray, h: Header) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squares and number of samples of each ms.  32-bit samples lose their last eight bits, so that sums fit."""
    x = decoded(data, h.width)
    if h.width == 4:
        x >>= 8
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((x * x).view(np.uint64))))  # modulo 2**64: differences stay exact
    at = edges * h.channels
    return total[at[1:]] - total[at[:-1]], np.diff(at)


def loud_bits(width: int) -> int:
    """Bits of the amplitude that sums of squares are in."""
    return 8 * min(width, 3)


# ---------------------------------------------------------------- files and pieces

def wav_files(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """(media_id, path) of the files of a folder; their contents are not read, and empty files are passed over.

    The driver lists the folder; where the files' paths are in a table, `named_files` takes them without that.
    """
    return named_files(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path))


def named_files(files: DataFrame) -> DataFrame:
    """(media_id, path) of files(path)."""
    return files.select(stem(F.col("path")).alias("media_id"), "path")


def pieces_of(files: DataFrame, piece_ms: int = PIECE_MS) -> DataFrame:
    """PIECES of files(media_id, path): one row a stretch of piece_ms, dealt over all tasks; a file without samples has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for media, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, at = opened(path)
                with store.open_input_file(at) as f:
                    try:
                        h = header_of(f, f.size())
                    except (ValueError, struct.error) as e:
                        raise ValueError(f"{path}: {e}") from e
                if h.frames:
                    rows.append((media, path, h.rate, h.channels, h.width, h.data_at, h.frames, h.ms()))
            names = ["media_id", "path", "rate", "channels", "width", "data_at", "frames", "len_ms"]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    heads = files.select("media_id", "path").mapInArrow(run, PIECES.split(", from_ms")[0])
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("len_ms") - 1, F.lit(0)), F.lit(piece_ms).cast("long")))
    made = heads.select("*", start.alias("from_ms")).withColumn("to_ms", F.least(F.col("from_ms") + piece_ms, "len_ms"))
    return made.repartition(parts_of(files), "media_id", "from_ms")  # rows are small, what they stand for is not: a number given stays


def _each(b: pa.RecordBatch) -> Iterator[tuple[dict, Header]]:
    for r in b.to_pylist():
        yield r, Header(r["rate"], r["channels"], r["width"], r["data_at"], r["frames"])


def loudness(pieces: DataFrame) -> DataFrame:
    """(media_id, len_ms, rms, dbfs): the integer root mean square of all samples, and 20 log10 of its share of full scale (null for silence)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r, h in _each(b):
                store, path = opened(r["path"])
                squares, n = _squares(*_ranged(store, path, h, r["from_ms"], r["to_ms"]), h)
                out.append((r["media_id"], r["len_ms"], loud_bits(h.width), sum(int(x) for x in np.add.reduceat(squares >> np.uint64(24), np.arange(0, len(squares), 1024))) * 2**24 + int((squares & np.uint64(2**24 - 1)).sum()) if len(squares) else 0, int(n.sum())))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.decimal128(38, 0)), pa.array(cols[4], pa.int64())], ["media_id", "len_ms", "bits", "squares", "n"])

    sums = pieces.mapInArrow(run, "media_id string, len_ms long, bits int, squares decimal(38,0), n long")
    made = sums.groupBy("media_id").agg(F.first("len_ms").alias("len_ms"), F.first("bits").alias("bits"), F.floor(F.sqrt(F.sum("squares").cast("double") / F.greatest(F.sum("n"), F.lit(1)))).alias("rms"))
    full = F.pow(F.lit(2.0), F.col("bits") - 1)
    return made.select("media_id", "len_ms", "rms", F.when(F.col("rms") > 0, 20 * F.log10(F.col("rms") / full)).alias("dbfs"), (full).alias("full_scale"))


def speech(pieces: DataFrame, min_silence_ms: int = 700, below: float = 14.0, keep_ms: int = 300, block_ms: int = 3_600_000) -> DataFrame:
    """(media_id, seg_idx, start_ms, end_ms): stretches between silences, with keep_ms of silence around them.

    A silence is made of windows of min_silence_ms, one from every ms on, whose integer root mean square is at most that of
    the whole medium less `below` decibels; windows join where they meet or overlap.  Neighbours share a silence too short
    for both their margins in its middle.  A medium without speech has no rows; one without silence has one.

    All samples are read twice, for the mean level and for the windows: what is found is written and read again where it is asked for more than once.
    """
    pieces = cut(pieces)
    level = cut(loudness(pieces))
    # a silent medium has no loudness: its threshold is zero, which every window reaches
    limit = F.coalesce(F.pow(F.lit(10.0), (F.col("dbfs") - below) / 20) * F.col("full_scale"), F.lit(0.0))
    levels = level.select("media_id", limit.alias("limit"))
    asked = pieces.join(levels, "media_id").repartition(parts_of(pieces), "media_id", "from_ms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            media, lo, hi = [], [], []
            for r, h in _each(b):
                stop = min(r["to_ms"], r["len_ms"] - min_silence_ms + 1)  # begins of windows
                if stop <= r["from_ms"]:
                    continue
                store, path = opened(r["path"])
                squares, n = _squares(*_ranged(store, path, h, r["from_ms"], stop + min_silence_ms - 1), h)
                sums, counts = (np.concatenate((np.zeros(1, x.dtype), np.cumsum(x))) for x in (squares, n))
                size = np.maximum(counts[min_silence_ms:] - counts[:-min_silence_ms], 1)
                silent = np.floor(np.sqrt((sums[min_silence_ms:] - sums[:-min_silence_ms]).astype(float) / size)) <= r["limit"]
                edge = np.flatnonzero(np.diff(np.concatenate(([False], silent, [False])).astype(np.int8)))
                media += [r["media_id"]] * (len(edge) // 2)
                lo += (edge[::2] + r["from_ms"]).tolist()
                hi += (edge[1::2] - 1 + r["from_ms"]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(media, pa.string()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["media_id", "lo", "hi"])

    runs = cut(asked.mapInArrow(run, "media_id string, lo long, hi long"))
    runs = scan.previous(runs, ["media_id"], "lo", "hi", "before", block_ms)
    new = F.col("before").isNull() | (F.col("lo") > F.col("before") + min_silence_ms)
    silences = scan.running_sum(runs, ["media_id"], "lo", new.cast("int"), "no", block_ms).groupBy("media_id", "no").agg(F.min("lo").alias("a"), (F.max("hi") + min_silence_ms).alias("b"))
    # what ends where a silence begins; the last one where the medium ends
    ends = silences.select("media_id", "a", F.struct("a", "b").alias("s")).unionByName(level.select("media_id", F.col("len_ms").alias("a"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("s")))
    ends = scan.previous(ends, ["media_id"], "a", "s", "p", block_ms).join(level.select("media_id", "len_ms"), "media_id")
    start, end = F.coalesce("p.b", F.lit(0)), F.col("a")
    found = ends.filter(end > start)
    middle = lambda x, y: F.floor((x + y) / 2)
    left = F.when(F.col("p.a") > 0, F.when(start - F.col("p.a") < 2 * keep_ms, middle(F.col("p.a"), start)).otherwise(start - keep_ms)).otherwise(F.greatest(F.lit(0), start - keep_ms))
    right = F.when(F.col("s.b") < F.col("len_ms"), F.when(F.col("s.b") - end < 2 * keep_ms, middle(end, F.col("s.b"))).otherwise(end + keep_ms)).otherwise(F.least("len_ms", end + keep_ms))
    made = found.select("media_id", left.alias("start_ms"), right.alias("end_ms"))
    return scan.row_numbers(made, ["media_id"], "start_ms", "seg_idx", block_ms).select("media_id", "seg_idx", "start_ms", "end_ms")


def _placed(segments: DataFrame, files: DataFrame) -> DataFrame:
    """segments(media_id, seg_idx, start_ms, end_ms) with the path and format of their file, dealt over all tasks."""
    heads = pieces_of(files, 1 << 40).drop("from_ms", "to_ms")
    return segments.select("media_id", "seg_idx", "start_ms", "end_ms").join(heads, "media_id").repartition(parts_of(files), "media_id", "seg_idx")


def samples_of(segments: DataFrame, files: DataFrame) -> DataFrame:
    """segments(media_id, seg_idx, start_ms, end_ms) with rate, channels, width and content, the raw samples; each is read by its own range."""
    asked = _placed(segments, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                ((r, h),) = _each(one)
                store, path = opened(r["path"])
                data, _ = _ranged(store, path, h, r["start_ms"], r["end_ms"])
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in ("media_id", "seg_idx", "start_ms", "end_ms", "rate", "channels", "width")), pa.array([data], pa.binary())], ["media_id", "seg_idx", "start_ms", "end_ms", "rate", "channels", "width", "content"])

    kinds = dict(f.split(" ") for f in PIECES.split(", "))
    return asked.mapInArrow(run, f"media_id string, seg_idx {segments.schema['seg_idx'].dataType.simpleString()}, start_ms long, end_ms long, rate {kinds['rate']}, channels int, width int, content binary")


def _measures(data: bytes, rate: int, channels: int, width: int) -> tuple[int, int, float]:
    """Bytes, milliseconds and loudness of samples; silence is minus infinity."""
    x = decoded(data, width)
    x = x >> 8 if width == 4 else x
    rms = int(np.sqrt(float(sum(int((p * p).sum()) for p in np.array_split(x, len(x) // 65536 + 1))) / max(1, len(x))))
    return len(data), round(1000 * len(x) / channels / rate), 20 * float(np.log10(rms / 2.0 ** (loud_bits(width) - 1))) if rms else float("-inf")


def measured(samples: DataFrame) -> DataFrame:
    """samples_of() rows with size_bytes, dur_ms and dbfs of their own samples, as `audio.good_chunks` takes them; silence is minus infinity."""
    schema = T.StructType([*samples.schema.fields]).add("size_bytes", "long").add("dur_ms", "long").add("dbfs", "double")
    at = {c: samples.columns.index(c) for c in ("rate", "channels", "width", "content")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in range(b.num_rows):
                rate, channels, width, data = (b.column(at[c])[r].as_py() for c in ("rate", "channels", "width", "content"))
                rows.append(_measures(data or b"", rate, channels, width))
            size, ms, level = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size, pa.int64()), pa.array(ms, pa.int64()), pa.array(level, pa.float64())], schema.names)

    return samples.mapInArrow(run, schema)


def measures_of(segments: DataFrame, files: DataFrame) -> DataFrame:
    """segments with size_bytes, dur_ms and dbfs, as measured(samples_of()) has them, without the samples: these stay in the task that reads them."""
    names = ["media_id", "seg_idx", "start_ms", "end_ms", "size_bytes", "dur_ms", "dbfs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r, h in _each(b):
                store, path = opened(r["path"])
                rows.append(_measures(_ranged(store, path, h, r["start_ms"], r["end_ms"])[0], h.rate, h.channels, h.width))
            size, ms, level = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:4]), pa.array(size, pa.int64()), pa.array(ms, pa.int64()), pa.array(level, pa.float64())], names)

    return _placed(segments, files).mapInArrow(run, f"media_id string, seg_idx {segments.schema['seg_idx'].dataType.simpleString()}, start_ms long, end_ms long, size_bytes long, dur_ms long, dbfs double")


def wav_header(rate: int, channels: int, width: int, n_bytes: int) -> bytes:
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n_bytes, b"WAVE", b"fmt ", 16, 1, channels, rate, rate * channels * width, channels * width, 8 * width, b"data", n_bytes)
