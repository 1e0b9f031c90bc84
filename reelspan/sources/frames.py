"""Raw video frames as a data source: `spark.read.format("rawframes")`, `df.write.format("rawframes")`, and frames by wanted index.

A video is `<video>.rgb24`, or a folder `<video>` of segments `<first>.rgb24`, each a run of frames from index `first` on.
All frames have width x height x 3 bytes, so a frame's place in its file is known and nothing has to be decoded to reach it.

Reading plans partitions by file and frame range.  Predicates on video_id (=, in) drop files; those on frame_idx (=, in, <, <=, >, >=)
become ranges or single indices (see `predicates` for how they come here); `stride` and `phase` keep every stride-th frame.  A task seeks to what is left and reads
no byte of other frames, unless the option `gap` allows it to read over that many bytes to save a request.

A last frame that is cut off does not count.  Frames are served in order within a file; nothing is said of the order of files.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from reelspan.sources.predicates import allow_pushdown, as_option, filters_of
from reelspan.sources.staging import Job, Staged, file_name, opened

SCHEMA = "video_id string, frame_idx long, pixels binary"
END = ".rgb24"
OUT = 8 << 20


@dataclass(frozen=True)
class Segment:
    """A file of frames `first` to `first + n - 1`."""

    video: str
    path: str
    first: int
    n: int


def segments_of(store: fs.FileSystem, top: str, frame: int, video: str | None = None) -> list[Segment]:
    """Segments of all videos in folder `top`, or of the file `top`, by path; with `video`, `top` is that video's file or folder."""
    info = store.get_file_info(top)
    if info.type == fs.FileType.NotFound:
        return []
    files = [info] if info.is_file else store.get_file_info(fs.FileSelector(top, recursive=True))
    found = []
    for x in files:
        name = x.path[len(top) :].strip("/") if not info.is_file else x.base_name
        if not x.is_file or not name.endswith(END) or name.startswith(("_", ".")):
            continue
        folder, _, own = name[: -len(END)].rpartition("/")
        if re.fullmatch("[0-9]+", own) and (folder or video is not None and not info.is_file):
            found.append(Segment(video or unquote(folder.rpartition("/")[2]), x.path, int(own), x.size // frame))
        else:
            found.append(Segment(video or unquote(own), x.path, 0, x.size // frame))
    return sorted(found, key=lambda s: s.path)


def reads(indices: Iterable[int], frame: int, gap: int) -> Iterator[list[int]]:
    """Ascending indices in runs that one read serves: a run goes on over at most `gap` unwanted bytes, up to OUT bytes in all."""
    run: list[int] = []
    for i in indices:
        if run and ((i - run[-1] - 1) * frame > gap or (i - run[0] + 1) * frame > OUT):
            yield run
            run = []
        run.append(i)
    if run:
        yield run


def frames_at(file, indices: Iterable[int], frame: int, gap: int = 0) -> Iterator[tuple[int, bytes]]:
    """(index in the file, pixels) of ascending indices, by one seek and one read a run."""
    for run in reads(indices, frame, gap):
        file.seek(run[0] * frame)
        data = file.read((run[-1] - run[0] + 1) * frame)
        for i in run:
            one = data[(i - run[0]) * frame : (i - run[0] + 1) * frame]
            if len(one) == frame:
                yield i, one


def _batches(rows: Iterator[tuple[str, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[str, int, bytes]] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 64
        if size >= OUT:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    video, at, pixels = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(video, pa.string()), pa.array(at, pa.int64()), pa.array(pixels, pa.binary())], ["video_id", "frame_idx", "pixels"])


# ---------------------------------------------------------------- reading

@dataclass
class Piece:
    """Frames start, start + step, ... below stop of a segment, or the listed ones; indices are the video's."""

    segment: Segment
    start: int
    stop: int
    step: int
    only: list[int] | None = None

    def indices(self) -> Iterable[int]:
        return self.only if self.only is not None else range(self.start, self.stop, self.step)

    def __len__(self) -> int:
        return len(self.only) if self.only is not None else len(range(self.start, self.stop, self.step))


@dataclass
class Pieces(InputPartition):
    pieces: list[Piece]


class FrameReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.columns, self.path = [c.name for c in schema], options["path"]
        self.frame = int(options.get("width", 48)) * int(options.get("height", 27)) * 3
        self.stride, self.phase = int(options.get("stride", 1)), int(options.get("phase", 0))
        self.per_task, self.gap = int(options.get("framespertask", max(1, (64 << 20) // self.frame))), int(options.get("gap", 0))
        self.low, self.high, self.only, self.videos = 0, None, None, None
        if self.stride < 1:
            raise ValueError("stride is to be 1 or more")
        for f in filters_of(options.get("where")):
            if not self._takes(f):
                raise ValueError(f"the scan can't judge {f}")

    def _takes(self, f: Filter) -> bool:
        """Narrows the scan by f and says so; False for what Spark is to judge."""
        if isinstance(f, IsNotNull):
            return f.attribute in (("video_id",), ("frame_idx",), ("pixels",))
        if f.__class__ not in (EqualTo, EqualNullSafe, In, LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual) or f.value is None:
            return False
        values = set(f.value) if isinstance(f, In) else {f.value}
        if f.attribute == ("video_id",) and isinstance(f, (EqualTo, EqualNullSafe, In)):
            self.videos = values if self.videos is None else self.videos & values
        elif f.attribute != ("frame_idx",):
            return False
        elif isinstance(f, (EqualTo, EqualNullSafe, In)):
            self.only = values if self.only is None else self.only & values
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        else:
            stop = f.value + isinstance(f, LessThanOrEqual)
            self.high = stop if self.high is None else min(self.high, stop)
        return True

    def pieces(self) -> Iterator[Piece]:
        """What the scan reads, in pieces of per_task frames at most."""
        store, top = opened(self.path)
        for s in segments_of(store, top, self.frame):
            if self.videos is not None and s.video not in self.videos:
                continue
            low, high = max(self.low, s.first), s.first + s.n if self.high is None else min(self.high, s.first + s.n)
            if self.only is not None:
                own = sorted(i for i in self.only if i is not None and low <= i < high and (i - self.phase) % self.stride == 0)
                for i in range(0, len(own), self.per_task):
                    yield Piece(s, low, high, self.stride, own[i : i + self.per_task])
                continue
            low += (self.phase - low) % self.stride
            for start in range(low, high, self.per_task * self.stride):
                yield Piece(s, start, min(high, start + self.per_task * self.stride), self.stride)

    def partitions(self) -> list[Pieces]:
        packs: list[Pieces] = []
        held = 0
        for p in self.pieces():
            if not packs or held + len(p) > self.per_task:
                packs.append(Pieces([]))
                held = 0
            packs[-1].pieces.append(p)
            held += len(p)
        return packs or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)

        def rows() -> Iterator[tuple[str, int, bytes]]:
            for p in partition.pieces:
                s = p.segment
                if "pixels" not in self.columns:  # indices are known without opening the file
                    yield from ((s.video, i, b"") for i in p.indices())
                    continue
                with store.open_input_file(s.path) as file:
                    for i, pixels in frames_at(file, (i - s.first for i in p.indices()), self.frame, self.gap):
                        yield s.video, i + s.first, pixels

        for b in _batches(rows()):
            yield b.select(self.columns)


class PushedFrameReader(FrameReader):
    """Takes Spark's own filters too."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self._takes(f):
                yield f


# ---------------------------------------------------------------- writing

class FrameWriter(DataSourceArrowWriter):
    """Rows of a task in order of video_id and frame_idx; a segment ends where an index does not follow, or at segmentFrames."""

    def __init__(self, options: dict, overwrite: bool):
        self.job, self.overwrite = Job(options["path"]), overwrite
        self.frame = int(options.get("width", 48)) * int(options.get("height", 27)) * 3
        self.most = int(options.get("segmentframes", 1 << 30))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, attempt = self.job.begin()
        done, out, video, following, n = Staged(), None, None, None, 0
        for b in iterator:
            for v, i, pixels in zip(*(b.column(c).to_pylist() for c in ("video_id", "frame_idx", "pixels"))):
                if len(pixels) != self.frame:
                    raise ValueError(f"frame {i} of {v} has {len(pixels)} bytes, not {self.frame}")
                if out is None or v != video or i != following or n == self.most:
                    if out is not None:
                        out.close()
                    name = f"{attempt}/{len(done.files)}{END}"
                    out, n = store.open_output_stream(f"{self.job.folder()}/{name}", compression=None), 0
                    done.files.append((name, f"{file_name(v)}/{i:012d}{END}"))
                out.write(pixels)
                video, following, n, done.rows = v, i + 1, n + 1, done.rows + 1
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Staged | None]) -> None:
        if self.overwrite:
            store, top = opened(self.job.path)
            for s in segments_of(store, top, self.frame):
                store.delete_file(s.path)
        self.job.commit(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        self.job.abort()


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rawframes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (PushedFrameReader if options.get("pushdown") == "true" else FrameReader)(schema, options)

    def writer(self, schema, overwrite: bool) -> FrameWriter:
        return FrameWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def raw_frames(spark: SparkSession, path: str, width: int = 48, height: int = 27, where: list[tuple] | None = None, pushdown: bool = False, **options) -> DataFrame:
    """(video_id, frame_idx, pixels) of the videos under path that satisfy `where`, judged in the scan.

    pushdown: Spark's filters go into the scan as well; then load anew for every scan.
    """
    spark.dataSource.register(FrameSource)
    if pushdown:
        allow_pushdown(spark)
    return spark.read.format("rawframes").options(width=width, height=height, where=as_option(where or []), pushdown=pushdown, **options).load(path)


def write_frames(frames: DataFrame, path: str, width: int = 48, height: int = 27, segment: int = 4096, mode: str = "append") -> None:
    """frames(video_id, frame_idx, pixels) as raw segments of up to `segment` frames; a long video is written by many tasks."""
    frames.sparkSession.dataSource.register(FrameSource)
    rows = frames.select(F.col("video_id").cast("string"), F.col("frame_idx").cast("long"), "pixels")
    block = F.floor(F.col("frame_idx") / segment)
    dealt = rows.withColumn("block", block).repartition("video_id", "block").sortWithinPartitions("video_id", "frame_idx").drop("block")
    dealt.write.format("rawframes").options(width=width, height=height, segmentFrames=segment).mode(mode).save(path)


# ---------------------------------------------------------------- wanted frames

def wanted_frames(wanted: DataFrame, path: str, width: int = 48, height: int = 27, block: int = 4096, gap: int = 0) -> DataFrame:
    """(video_id, frame_idx, pixels) of the indices in wanted(video_id, frame_idx), each once; those without a frame are skipped.

    Indices are grouped by video and block of frames; a task lists the segments of its videos and reads only the
    frames asked for.  Neither indices nor frames pass the driver, and a long video's blocks are in many tasks.
    """
    frame = width * height * 3
    rows = wanted.select(F.col("video_id").cast("string").alias("video_id"), F.col("frame_idx").cast("long").alias("frame_idx")).filter("video_id is not null and frame_idx >= 0")
    groups = rows.groupBy("video_id", F.floor(F.col("frame_idx") / block).alias("block")).agg(F.sort_array(F.collect_set("frame_idx")).alias("indices")).select("video_id", "indices")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)
        known: dict[str, list[Segment]] = {}

        def of(video: str) -> list[Segment]:
            if video not in known:
                if len(known) > 1000:
                    known.clear()
                name = file_name(video)
                own = [s for at in (f"{top}/{name}{END}", f"{top}/{name}") for s in segments_of(store, at, frame, video)]
                known[video] = sorted(own, key=lambda s: s.first)
            return known[video]

        def rows() -> Iterator[tuple[str, int, bytes]]:
            for b in batches:
                for video, indices in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    own = of(video)
                    firsts, held = [s.first for s in own], {}
                    for i in indices:
                        k = bisect_right(firsts, i) - 1
                        if k >= 0 and i < firsts[k] + own[k].n:
                            held.setdefault(k, []).append(i - firsts[k])
                    for k, at in held.items():
                        with store.open_input_file(own[k].path) as file:
                            for i, pixels in frames_at(file, at, frame, gap):
                                yield video, i + firsts[k], pixels

        yield from _batches(rows())

    return groups.mapInArrow(run, SCHEMA)
