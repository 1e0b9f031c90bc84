"""Sinks under failures: files and uploads come once, whole, and jobs that were interrupted go on."""

from __future__ import annotations

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from reelspan.sources import sinks


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, x), path) for d, _, names in os.walk(path) for x in names if "_ledger" not in d and not x.endswith(".crc"))


def files(spark, n=20):
    return spark.range(n, numPartitions=4).select(F.format_string("v%d/frame_%03d.webp", F.col("id") % 3, F.col("id")).alias("name"), F.repeat(F.col("id").cast("string"), 10).cast("binary").alias("content"))


def test_files_after_a_failure_and_again(spark, tmp_path):
    flag = str(tmp_path / "fail")

    def failing():
        def encode(data):
            if data == b"17" * 10 and not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("lost")
            return data + b"!"

        return encode

    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        sinks.write_files(files(spark), path, failing, job="one")
    assert not [x for x in tree(path) if not x.startswith("_temporary")]
    for _ in range(2):  # the second time the ledger has it
        got = sinks.write_files(files(spark), path, failing, job="one").collect()
        assert len(got) == 20 and {r.n_bytes for r in got} == {11, 21}
    assert tree(path) == sorted(f"v{i % 3}/frame_{i:03d}.webp" for i in range(20))
    assert (tmp_path / "out" / "v2" / "frame_017.webp").read_bytes() == b"17" * 10 + b"!"


def test_an_interrupted_move_goes_on(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_files(files(spark, 3), path, job="a")
    # as if the driver was lost after the moves and before the ledger
    spark.createDataFrame([(f"v{i % 3}/frame_{i:03d}.webp", 10, "_temporary/b/x/0") for i in range(3)], sinks.MANIFEST).write.parquet(f"{path}/_temporary/b/manifest")
    assert sinks.write_files(files(spark, 3).filter("false"), path, job="b").count() == 3
    spark.createDataFrame([("v9/none", 10, "_temporary/c/x/0")], sinks.MANIFEST).write.parquet(f"{path}/_temporary/c/manifest")
    with pytest.raises(Exception, match="gone"):
        sinks.write_files(files(spark, 3), path, job="c")


def test_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, b"x"), ("b/c", b"")], "name string, content binary")
    assert sorted(tuple(r) for r in sinks.write_files(df, str(tmp_path / "o")).collect()) == [("a", 0), ("b/c", 0)]
    assert sinks.write_files(df.limit(0), str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError, match="2 files are named"):
        sinks.write_files(df.union(df), str(tmp_path / "t"))


@pytest.mark.parametrize("name", ["../x", "/x", "a/../../x", "", "_ledger/x", "."])
def test_names_stay_inside(spark, tmp_path, name):
    with pytest.raises(ValueError, match="named"):
        sinks.write_files(spark.createDataFrame([(name, b"1")], "name string, content binary"), str(tmp_path / "o"))


def test_stream_of_files_over_a_restart(spark, tmp_path):
    source, path, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    calls = str(tmp_path / "calls")

    def counting():
        def encode(data):
            with open(calls, "ab") as f:
                f.write(data + b"\n")
            return data

        return encode

    for n in range(3):
        files(spark, 4).select(F.concat(F.lit(f"e{n}/"), "name").alias("name"), "content").coalesce(1).write.mode("append").parquet(source)
        q = sinks.stream_files(spark.readStream.schema("name string, content binary").parquet(source), path, check, counting, availableNow=True)
        q.awaitTermination(120)
        q.stop()
    assert tree(path) == sorted(f"e{n}/v{i % 3}/frame_{i:03d}.webp" for n in range(3) for i in range(4))
    assert len(open(calls, "rb").read().split()) == 12
    # an epoch that comes again does nothing
    sinks.write_files(files(spark, 4), path, counting, job="epoch-0")
    assert len(open(calls, "rb").read().split()) == 12


def test_archives(spark, tmp_path):
    rows = [(v, f"frame_{i:03d}.webp", bytes([i]) * 1000) for v in ("a", "b/c", "ü") for i in (3, 1, 2)] + [(None, "x", b"y"), ("a", None, b"y"), ("a", "empty", None)]
    df = spark.createDataFrame(rows, "video_id string, name string, content binary").repartition(4)
    path = str(tmp_path / "z")
    made = sinks.write_archives(df, path)
    names = {r.name: r.n_bytes for r in made.collect()}
    assert set(names) == {"a.zip", "b%2Fc.zip", "%C3%BC.zip"}
    for name, size in names.items():
        assert os.path.getsize(f"{path}/{name}") == size
    with zipfile.ZipFile(f"{path}/a.zip") as z:
        assert z.testzip() is None and z.namelist() == ["empty", "frame_001.webp", "frame_002.webp", "frame_003.webp"] and z.read("frame_002.webp") == b"\x02" * 1000
    got = sinks.archive_entries(made, path)
    assert got.count() == 10 and got.filter("length(content) = 1000").count() == 9


def test_uploads_once(spark, tmp_path):
    log, ledger = str(tmp_path / "log"), str(tmp_path / "ledger")

    def client(lost_at=None, refused=()):
        class Client:
            def send(self, row):
                if row["upload_id"] == lost_at:
                    raise RuntimeError("lost")
                if row["upload_id"] in refused:
                    return False
                with open(log, "a") as f:
                    f.write(row["upload_id"] + "\n")
                return True

            def fallback(self, key):
                with open(log, "a") as f:
                    f.write(f"{key} fallback\n")
                return key != "c"

        return Client

    batches = spark.createDataFrame([(v, i) for v in ("a", "b", "c") for i in range(12)] + [(None, 0)], "video_id string, batch_no long").repartition(3)
    run = lambda c: {r.video_id: (r.sent, r.total, r.delivered) for r in sinks.upload(batches, c, ledger).collect()}
    with pytest.raises(Exception, match="lost"):
        run(client("a/10"))
    want = {"a": (12, 12, True), "b": (5, 12, True), "c": (0, 12, False)}
    assert run(client(refused=("b/5", "c/0"))) == want
    sent = open(log).read().split("\n")
    assert sorted(x for x in sent if x.startswith("a/")) == sorted(f"a/{i}" for i in range(12))
    assert [x for x in sent if x.startswith("a/")] == [f"a/{i}" for i in range(12)]
    assert run(client(refused=("b/5", "c/0"))) == want  # nothing of it comes again but the fallback that failed
    again = open(log).read().split("\n")
    assert sorted(again) == sorted([*sent, "c fallback"])


def test_files_are_read_by_the_names_that_the_sink_returns(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"d/{i} é%.bin", bytes([i]) * i) for i in range(30)], "name string, content binary").repartition(4)
    made = sinks.write_files(rows, path)
    (tmp_path / "out" / "d" / "other.bin").write_bytes(b"not of this job")
    got = sinks.read_files(made, path, most=40)
    assert {(r.name, bytes(r.content)) for r in got.collect()} == {(f"d/{i} é%.bin", bytes([i]) * i) for i in range(30)}
    assert not [f for f in got.inputFiles() if f.endswith(".bin")]  # the driver has listed none of them
    assert {r.path for r in sinks.paths_of(made, path).collect()} == {f"{path}/d/{i} é%.bin" for i in range(1, 30)}  # an empty file has no row


def test_joined_files_are_encoded_where_they_are_written(spark, tmp_path):
    parts = spark.createDataFrame([("a", 1, b"x"), ("a", 0, b"head"), ("b", 0, None)], "path string, pos int, content binary")
    made = sinks.write_joined(parts, str(tmp_path / "j"), encoder=lambda: lambda part: part * 3 if len(part) == 1 else part)
    assert {(r.name, r.n_bytes) for r in made.collect()} == {("a", 7), ("b", 0)}
    assert (tmp_path / "j" / "a").read_bytes() == b"headxxx"
