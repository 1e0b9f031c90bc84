"""Raw frames: what is read against all frames decoded, and how many bytes a scan touches."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from reelspan.sources import frames as raw
from reelspan.sources.staging import Job, Staged, file_name

W, H = 4, 3
FRAME = W * H * 3


def video(n, seed):
    return np.random.default_rng(seed).integers(0, 256, (n, FRAME), dtype=np.uint8)


@pytest.fixture(scope="module")
def videos(tmp_path_factory):
    top = tmp_path_factory.mktemp("raw")
    known = {"a": video(100, 1), "b/ä": video(37, 2), "cut": video(5, 3), "empty": video(0, 4)}
    (top / "a.rgb24").write_bytes(known["a"].tobytes())
    (top / file_name("b/ä")).mkdir()
    for first, to in ((0, 10), (10, 30), (30, 37)):
        (top / file_name("b/ä") / f"{first}.rgb24").write_bytes(known["b/ä"][first:to].tobytes())
    (top / "cut.rgb24").write_bytes(known["cut"].tobytes() + b"xyz")
    (top / "empty.rgb24").write_bytes(b"")
    (top / "notes.txt").write_bytes(b"no frames")
    return str(top), known


def everything(known):
    return {(v, i): x.tobytes() for v, own in known.items() for i, x in enumerate(own)}


def collected(df):
    rows = df.collect()
    out = {(r.video_id, r.frame_idx): bytes(r.pixels) for r in rows}
    assert len(out) == len(rows)
    return out


def test_scan_equals_all_frames(spark, videos):
    path, known = videos
    for per in (1, 7, 1000):
        assert collected(raw.raw_frames(spark, path, W, H, framesPerTask=per)) == everything(known)
    assert raw.raw_frames(spark, path, W, H, framesPerTask=7).rdd.getNumPartitions() >= 142 // 7


@pytest.mark.parametrize("condition", ["frame_idx = 7", "frame_idx in (3, 40, 99, 100)", "frame_idx >= 10 and frame_idx < 33", "frame_idx > 35 and video_id = 'a'", "video_id in ('cut', 'b/ä')", "frame_idx % 3 = 1 and frame_idx <= 20", "frame_idx = 2 or video_id = 'cut'", "frame_idx is null", "frame_idx > 5 and frame_idx < 3", "video_id > 'b' and not frame_idx = 2"])
def test_predicates(spark, videos, condition):
    path, known = videos
    rows = spark.createDataFrame([(v, i, x) for (v, i), x in everything(known).items()], raw.SCHEMA)
    want = collected(rows.filter(condition))
    assert collected(raw.raw_frames(spark, path, W, H, pushdown=True).filter(condition)) == want
    assert collected(raw.raw_frames(spark, path, W, H).filter(condition)) == want


def test_predicates_of_a_load_are_its_own(spark, videos):
    path, known = videos
    one = raw.raw_frames(spark, path, W, H, where=[("video_id", "=", "a"), ("frame_idx", "<", 30), ("frame_idx", ">", 20)])
    want = {k: x for k, x in everything(known).items() if k[0] == "a" and 20 < k[1] < 30}
    both = one.filter("frame_idx = 22").unionByName(one.filter("frame_idx = 25")).unionByName(one)
    assert sorted(r.frame_idx for r in both.collect()) == sorted([22, 25, *range(21, 30)]) and collected(one) == want
    assert collected(raw.raw_frames(spark, path, W, H, where=[("frame_idx", "in", [1, 4, 400])])) == {k: x for k, x in everything(known).items() if k[1] in (1, 4)}
    with pytest.raises(ValueError, match="no such predicate"):
        raw.raw_frames(spark, path, W, H, where=[("frame_idx", "around", 3)])
    with pytest.raises(Exception, match="can't judge"):
        raw.raw_frames(spark, path, W, H, where=[("pixels", "=", "x")]).count()


def test_stride_begins_anew_in_no_segment(spark, videos):
    path, known = videos
    for stride, phase in ((5, 0), (7, 3), (1000, 2)):
        want = {k: x for k, x in everything(known).items() if (k[1] - phase) % stride == 0}
        assert collected(raw.raw_frames(spark, path, W, H, stride=stride, phase=phase, framesPerTask=4)) == want


class Counting:
    """A file that keeps the ranges read from it."""

    def __init__(self, data):
        self.data, self.at, self.ranges = data, 0, []

    def seek(self, at):
        self.at = at

    def read(self, n):
        self.ranges.append((self.at, n))
        self.at += n
        return self.data[self.at - n : self.at]


def reader(path, filters, **options):
    own = raw.PushedFrameReader(T.StructType().add("video_id", "string").add("frame_idx", "long").add("pixels", "binary"), {"path": path, "width": W, "height": H} | options)
    return own, list(own.pushFilters(filters))


def test_only_wanted_bytes_are_read(videos):
    path, known = videos
    file = Counting(known["a"].tobytes())
    got = dict(raw.frames_at(file, range(0, 100, 5), FRAME))
    assert [got[i] for i in range(0, 100, 5)] == [known["a"][i].tobytes() for i in range(0, 100, 5)]
    assert file.ranges == [(i * FRAME, FRAME) for i in range(0, 100, 5)]
    file = Counting(known["a"].tobytes())
    assert len(dict(raw.frames_at(file, [3, 4, 5, 50, 52, 99], FRAME, gap=FRAME))) == 6
    assert file.ranges == [(3 * FRAME, 3 * FRAME), (50 * FRAME, 3 * FRAME), (99 * FRAME, FRAME)]
    own, left = reader(path, [EqualTo(("video_id",), "a"), GreaterThan(("frame_idx",), 9), LessThanOrEqual(("frame_idx",), 40), In(("pixels",), (b"x",))], stride=10)
    assert len(left) == 1
    assert [(p.segment.video, *p.indices()) for p in own.pieces()] == [("a", 10, 20, 30, 40)]
    own, _ = reader(path, [In(("frame_idx",), (5, 12, 36))])
    assert [(p.segment.first, *p.indices()) for p in own.pieces() if p.segment.video == "b/ä"] == [(0, 5), (10, 12), (30, 36)]


def test_predicates_leave_the_plan(spark, videos):
    plan = raw.raw_frames(spark, videos[0], W, H, pushdown=True).filter("video_id = 'a' and frame_idx between 3 and 5")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter [" not in plan


def test_wanted_frames(spark, videos):
    path, known = videos
    asked = [("a", 3), ("a", 3), ("a", 99), ("a", 100), ("b/ä", 0), ("b/ä", 29), ("b/ä", 30), ("b/ä", 36), ("b/ä", 37), ("cut", 4), ("cut", 5), ("none", 1), (None, 1), ("a", None), ("a", -1), ("empty", 0)]
    wanted = spark.createDataFrame(asked, "video_id string, frame_idx long")
    want = {k: x for k, x in everything(known).items() if k in asked}
    for block, gap in ((4096, 0), (2, 0), (50, 10_000)):
        assert collected(raw.wanted_frames(wanted, path, W, H, block, gap)) == want
    assert raw.wanted_frames(wanted.limit(0), path, W, H).count() == 0


def test_written_frames_come_back(spark, tmp_path):
    rows = [(v, i, bytes([i % 256]) * FRAME) for v, n in (("x", 50), ("a b/c", 9), (".hidden", 2)) for i in range(n)] + [("x", i, bytes([i % 256]) * FRAME) for i in (60, 61, 80)]
    df = spark.createDataFrame(rows, raw.SCHEMA).repartition(5)
    raw.write_frames(df, str(tmp_path / "w"), W, H, segment=16)
    assert collected(raw.raw_frames(spark, str(tmp_path / "w"), W, H)) == {(v, i): x for v, i, x in rows}
    assert sorted(os.listdir(tmp_path / "w" / "x")) == [f"{i:012d}.rgb24" for i in (0, 16, 32, 48, 60, 80)]
    assert not (tmp_path / "w" / "_temporary").exists()
    raw.write_frames(df.filter("frame_idx < 3"), str(tmp_path / "w"), W, H, mode="overwrite")
    assert {i for _, i in collected(raw.raw_frames(spark, str(tmp_path / "w"), W, H))} == {0, 1, 2}
    with pytest.raises(Exception, match="has 3 bytes"):
        raw.write_frames(df.withColumn("pixels", F.lit(b"abc")), str(tmp_path / "bad"), W, H)
    assert not [x for _, _, names in os.walk(tmp_path / "bad") for x in names]


def test_repeated_attempts_and_commits(tmp_path):
    job = Job(str(tmp_path / "t"))
    kept = []
    for attempt in range(3):  # two attempts fail
        store, folder = job.begin()
        with store.open_output_stream(f"{job.folder()}/{folder}/0") as f:
            f.write(b"%d" % attempt)
        kept = [Staged([(f"{folder}/0", "v/one")])]
    job.commit([*kept, None])
    job.commit(kept)  # the driver repeats its commit
    assert (tmp_path / "t" / "v" / "one").read_bytes() == b"2" and os.listdir(tmp_path / "t") == ["v"]
    with pytest.raises(FileNotFoundError):
        job.commit([Staged([("x/0", "v/two")])])
