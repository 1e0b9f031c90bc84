"""Sinks: text documents by key; files and ZIP archives that show once, whole; ordered uploads, each once, with a fallback.

A write of files is a job in two steps.  Tasks write their files aside, each attempt in a folder of its own, and Spark commits one manifest row
a file; the manifest holds only the attempts that count.  Then tasks move what the manifest names into place, which can be repeated.
A job that was done is in the ledger and is not done again; one that was interrupted goes on where it stood.  Names, not files, pass the
driver, and none of them by itself.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.sources.staging import file_name, opened

MANIFEST = "name string, n_bytes long, staged string"
#: Names that would lie outside the target, or among a job's own files.
OUTSIDE = r"^$|^/|(^|/)[.]{1,2}(/|$)|^_temporary(/|$)|^_ledger(/|$)"


def write_documents(rows: DataFrame, path: str, key: str, text: str, order: str | None = None) -> None:
    """Text files under path/key=..., the lines of a key in order."""
    by = [key, order] if order else [key]
    rows.repartition(F.col(key)).sortWithinPartitions(*by).select(key, text).write.mode("overwrite").partitionBy(key).text(path)


# ---------------------------------------------------------------- files by manifest

def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def _committed(staged: DataFrame | None, spark: SparkSession, path: str, job: str) -> DataFrame:
    """Moves a job's files into place and enters them in the ledger: (name, n_bytes)."""
    store, top = opened(path)
    work, done = f"_temporary/{job}", f"_ledger/{job}"
    ledger = f"{path.rstrip('/')}/{done}"
    if not _exists(store, f"{top}/{done}/_SUCCESS"):
        manifest = f"{path.rstrip('/')}/{work}/manifest"
        if not _exists(store, f"{top}/{work}/manifest/_SUCCESS"):
            staged.write.mode("overwrite").parquet(manifest)
        rows = spark.read.schema(MANIFEST).parquet(manifest)
        if bad := rows.filter(F.col("name").rlike(OUTSIDE)).first():
            raise ValueError(f"a file can't be named {bad['name']!r} here")
        if twice := rows.groupBy("name").count().filter("count > 1").first():
            raise ValueError(f"{twice['count']} files are named {twice['name']}")

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, here = opened(path)
            made: set[str] = set()
            for b in batches:
                for name, at in zip(b.column("name").to_pylist(), b.column("staged").to_pylist()):
                    target = f"{here}/{name}"
                    if (parent := target.rpartition("/")[0]) not in made:
                        own.create_dir(parent, recursive=True)
                        made.add(parent)
                    if _exists(own, f"{here}/{at}"):
                        own.move(f"{here}/{at}", target)
                    elif not _exists(own, target):
                        raise FileNotFoundError(f"a staged file is gone: {at}")
                yield b.select(["name", "n_bytes"])

        rows.mapInArrow(move, "name string, n_bytes long").write.mode("overwrite").parquet(ledger)
        store.delete_dir(f"{top}/{work}")
        if not store.get_file_info(fs.FileSelector(f"{top}/_temporary")):
            store.delete_dir(f"{top}/_temporary")
    return spark.read.schema("name string, n_bytes long").parquet(ledger)


def _staged(path: str, job: str) -> tuple[fs.FileSystem, str, str]:
    """A folder for one attempt: file system, absolute and relative path."""
    store, top = opened(path)
    folder = f"_temporary/{job}/{uuid.uuid4().hex}"
    store.create_dir(f"{top}/{folder}", recursive=True)
    return store, f"{top}/{folder}", folder


def write_files(rows: DataFrame, path: str, encoder: Callable | None = None, job: str | None = None) -> DataFrame:
    """(name, n_bytes) of rows(name, content) as one file each under a shared path, encoded by encoder() if given.

    A name may have folders (`video/frame_001.webp`).  A null content is an empty file; rows without a name go; two rows
    of one name are an error.  The same `job` a second time writes nothing.
    """
    job = job or uuid.uuid4().hex

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder() if encoder else bytes
        store, folder, relative = _staged(path, job)
        n = 0
        for b in batches:
            names, sizes, at = b.column(0).to_pylist(), [], []
            for content in b.column(1):
                data = encode(content.as_py() or b"")
                at.append(f"{relative}/{n}")
                with store.open_output_stream(f"{folder}/{n}", compression=None) as f:
                    f.write(data)
                sizes.append(len(data))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(at, pa.string())], ["name", "n_bytes", "staged"])

    given = rows.filter("name is not null").select(F.col("name").cast("string"), F.col("content").cast("binary"))
    return _committed(given.mapInArrow(stage, MANIFEST), rows.sparkSession, path, job)


def read_files(made: DataFrame, path: str, most: int = 1 << 23) -> DataFrame:
    """(name, content) of the files made(name) under path, as the sinks return them; each is opened by the task that has its name.

    A listing of the folder would bring every file's state to the driver.  A task holds about `most` bytes, or one file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], ["name", "content"])
        for b in batches:
            rows, held = [], 0
            for name in b.column(0).to_pylist():
                with store.open_input_file(f"{top}/{name}") as f:
                    rows.append((name, f.read()))
                held += len(rows[-1][1])
                if held >= most:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return made.select("name").mapInArrow(run, "name string, content binary")


def paths_of(made: DataFrame, path: str) -> DataFrame:
    """(path) of the files made(name, n_bytes) under path that are not empty, without a listing."""
    return made.filter("n_bytes > 0").select(F.concat(F.lit(f"{path.rstrip('/')}/"), "name").alias("path"))


def stream_files(rows: DataFrame, path: str, checkpoint: str, encoder: Callable | None = None, **trigger):
    """A running query that writes each row of a stream of (name, content) as a file, once, whatever restarts there are."""
    each = lambda frame, epoch: write_files(frame, path, encoder, f"epoch-{epoch}")
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


# ---------------------------------------------------------------- archives

def write_archives(files: DataFrame, path: str, key: str = "video_id", job: str | None = None) -> DataFrame:
    """(name, n_bytes): a flat deflated `<key>.zip` of each key's files(key, name, content), in order of name.

    Rows come to the task in order and go into the archive one by one: it holds one batch of files, not a video's.
    """
    job = job or uuid.uuid4().hex

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder, relative = _staged(path, job)
        done: list[tuple[str, int, str]] = []
        video = stream = archive = None

        def close() -> None:
            if archive is not None:
                archive.close()
                size = stream.tell()
                stream.close()
                done.append((f"{file_name(video)}.zip", size, f"{relative}/{len(done)}"))

        for b in batches:
            for i in range(b.num_rows):
                own = b.column(0)[i].as_py()
                if archive is None or own != video:
                    close()
                    video = own
                    stream = store.open_output_stream(f"{folder}/{len(done)}", compression=None)
                    archive = zipfile.ZipFile(_Counted(stream), "w", zipfile.ZIP_DEFLATED)
                info = zipfile.ZipInfo(b.column(1)[i].as_py(), (1980, 1, 1, 0, 0, 0))
                info.compress_type = zipfile.ZIP_DEFLATED
                archive.writestr(info, b.column(2)[i].as_py() or b"")
        close()
        if done:
            names, sizes, at = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(at, pa.string())], ["name", "n_bytes", "staged"])

    given = files.select(F.col(key).cast("string").alias("key"), F.col("name").cast("string"), F.col("content").cast("binary")).filter("key is not null and name is not null")
    dealt = given.repartition("key").sortWithinPartitions("key", "name")
    return _committed(dealt.mapInArrow(stage, MANIFEST), files.sparkSession, path, job)


def write_joined(parts: DataFrame, path: str, key: str = "path", at: str = "pos", job: str | None = None, encoder: Callable | None = None) -> DataFrame:
    """(name, n_bytes): for each key one file named by it, its parts(key, at, content) one behind the other in order of `at`.

    Parts come to the task in order and are written as they come, so it holds one Arrow batch of them.  encoder(), if given, makes what is
    written of each content in the task that writes it, so that only what it needs for that is shuffled.
    """
    job = job or uuid.uuid4().hex

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder() if encoder else bytes
        store, folder, relative = _staged(path, job)
        done: list[tuple[str, int, str]] = []
        now = stream = None

        def close() -> None:
            if stream is not None:
                done.append((now, stream.tell(), f"{relative}/{len(done)}"))
                stream.close()

        for b in batches:
            for own, content in zip(b.column(0).to_pylist(), b.column(2)):
                if own != now:
                    close()
                    now, stream = own, store.open_output_stream(f"{folder}/{len(done)}", compression=None)
                stream.write(encode(content.as_py() or b""))
        close()
        if done:
            names, sizes, where = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(where, pa.string())], ["name", "n_bytes", "staged"])

    given = parts.select(F.col(key).cast("string").alias("key"), F.col(at).alias("at"), F.col("content").cast("binary")).filter("key is not null")
    return _committed(given.repartition("key").sortWithinPartitions("key", "at").mapInArrow(stage, MANIFEST), parts.sparkSession, path, job)


class _Counted(io.RawIOBase):
    """What zipfile needs of an output that can only go on."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)


def archive_entries(archives: DataFrame, path: str) -> DataFrame:
    """(archive, name, content) of the files inside archives(name) under path; a task reads one entry at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)
        for b in batches:
            for archive in b.column(0).to_pylist():
                with store.open_input_file(f"{top}/{archive}") as f, zipfile.ZipFile(f) as z:
                    for entry in z.infolist():
                        yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([entry.filename]), pa.array([z.read(entry)], pa.binary())], ["archive", "name", "content"])

    return archives.select("name").mapInArrow(run, "archive string, name string, content binary")


# ---------------------------------------------------------------- uploads

def upload(batches: DataFrame, client: Callable, ledger: str | None = None, key: str = "video_id") -> DataFrame:
    """(key, sent, total, delivered): each key's batches sent in order of batch_no until one fails, then the fallback.

    client() is built once a task; it has send(row) and fallback(key), which return whether they succeeded.  What was sent is
    entered in `ledger`, a shared folder, and never sent again, so a repeated task or a later run goes on where the
    last one stood.  A task lost between a sending and its entry sends that one batch again, with the same `upload_id`,
    by which a receiver knows it.  A task reads its keys' batches in order and holds one Arrow batch of them.
    """
    columns = [c for c in batches.columns if c != key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        store, top = opened(ledger) if ledger else (None, "")

        def sent_before(mark: str) -> bool:
            return store is not None and _exists(store, f"{top}/{mark}")

        def enter(mark: str) -> None:
            if store is not None:
                store.create_dir(f"{top}/{mark}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{top}/{mark}", compression=None) as f:
                    f.write(b"")

        def result(video, sent: int, total: int) -> dict:
            mark = f"{file_name(str(video))}/fallback"
            ok = sent == total or sent_before(mark)
            if not ok and (ok := bool(own.fallback(video))):
                enter(mark)
            return {key: video, "sent": sent, "total": total, "delivered": bool(ok)}

        now, sent, total, going = None, 0, 0, True
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                if total and row[key] != now:
                    out.append(result(now, sent, total))
                    sent, total, going = 0, 0, True
                now, total = row[key], total + 1
                if not going:
                    continue
                mark = f"{file_name(str(now))}/{row['batch_no']}"
                going = sent_before(mark)
                if not going and own.send(row | {"upload_id": f"{now}/{row['batch_no']}"}):
                    enter(mark)
                    going = True
                sent += going
            if out:
                yield pd.DataFrame(out)
        if total:
            yield pd.DataFrame([result(now, sent, total)])

    dealt = batches.select(key, *columns).filter(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, "batch_no")
    return dealt.mapInPandas(run, f"{key} {batches.schema[key].dataType.simpleString()}, sent long, total long, delivered boolean")
