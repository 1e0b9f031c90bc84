"""Audio segments: silence split, quality filter, size-bounded packing, ordered transcripts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.operators import scan

MEGABYTE = 1024 * 1024


def good_chunks(chunks: DataFrame, max_bytes: int, min_bytes: float = 0.05 * MEGABYTE, min_ms: int = 1000, min_dbfs: float = -50.0) -> DataFrame:
    """Chunks of a useful size, length and loudness."""
    return chunks.filter((F.col("size_bytes") >= min_bytes) & (F.col("dur_ms") >= min_ms) & (F.col("dbfs") >= min_dbfs) & (F.col("size_bytes") <= max_bytes))


def pack(segments: DataFrame, limit: int, key: str = "media_id", at: str = "seg_idx", size: str = "size_bytes") -> DataFrame:
    """segments with chunk_no: a chunk takes segments in order while their sizes add up to at most `limit`; a larger one stands alone.

    Segments of a medium come to a task in order; it keeps a number and a sum of the medium it is at.  A null size counts as none.
    """
    kind = lambda c: segments.schema[c].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunk, total = None, 0, 0
        for b in batches:
            numbers = []
            for own, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                n = n or 0
                if (own,) != now:
                    now, chunk, total = (own,), 0, n
                elif total + n <= limit:
                    total += n
                else:
                    chunk, total = chunk + 1, n
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers, pa.int32())], [key, at, "chunk_no"])

    dealt = segments.select(key, at, F.col(size).cast("long")).repartition(key).sortWithinPartitions(key, at)
    placed = dealt.mapInArrow(run, f"{key} {kind(key)}, {at} {kind(at)}, chunk_no int")
    return segments.join(placed, [key, at])


def pack_encoded(segments: DataFrame, limit: int, encoder: Callable, key: str = "media_id", at: str = "seg_idx") -> DataFrame:
    """(key, chunk_no, first, last, dur_ms, size_bytes, content): segments(key, at, dur_ms, content) in chunks whose encoded size is at most `limit`.

    encoder() is built once a task and maps a list of contents to the bytes of all of them together.  A chunk takes the next
    segment if the encoding of both stays within the limit; else it is closed and the segment begins the next one, whatever its own
    size.  Segments come in order and a task holds one chunk; each segment is encoded with its chunk once, so the work grows
    with the segments, and with the length of a chunk.
    """
    kind = lambda c: segments.schema[c].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        now, chunk, held, made, ms, ends = None, 0, [], b"", 0, (None, None)

        def closed() -> pa.RecordBatch:
            columns = [pa.array([now[0]], kinds[0]), pa.array([chunk], pa.int32()), pa.array([ends[0]], kinds[1]), pa.array([ends[1]], kinds[1]), pa.array([ms], pa.int64()), pa.array([len(made)], pa.int64()), pa.array([made], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, [key, "chunk_no", "first", "last", "dur_ms", "size_bytes", "content"])

        for b in batches:
            kinds = (b.schema.field(0).type, b.schema.field(1).type)
            for i in range(b.num_rows):
                own, place, n, content = b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py() or 0, b.column(3)[i].as_py() or b""
                both = encode([*held, content]) if (own,) == now else None
                if both is not None and len(both) <= limit:
                    held.append(content)
                    made, ms, ends = both, ms + n, (ends[0], place)
                    continue
                if now is not None:
                    yield closed()
                chunk = chunk + 1 if (own,) == now else 0
                now, held, ms, ends = (own,), [content], n, (place, place)
                made = encode(held)
        if now is not None:
            yield closed()

    dealt = segments.select(key, at, F.col("dur_ms").cast("long"), F.col("content").cast("binary")).repartition(key).sortWithinPartitions(key, at)
    return dealt.mapInArrow(run, f"{key} {kind(key)}, chunk_no int, first {kind(at)}, last {kind(at)}, dur_ms long, size_bytes long, content binary")


def speech(loudness: DataFrame, key: str = "media_id", at: str = "ms", level: str = "dbfs", step_ms: int = 100, min_silence_ms: int = 700, below: float = 14.0, keep_ms: int = 300, block_ms: int = 3_600_000) -> DataFrame:
    """(key, seg_idx, start_ms, end_ms): stretches between silences of at least min_silence_ms, with keep_ms around them.

    Silence is quieter than the medium's mean loudness less `below`.  A medium without speech has no rows.  A medium is
    scanned in blocks of block_ms.
    """
    whole = loudness.groupBy(key).agg((F.avg(level) - below).alias("_quiet"), F.min(at).alias("_first"), (F.max(at) + step_ms).alias("_len"))
    steps = scan.with_carry(loudness.select(key, F.col(at), F.col(level)), whole.select(key, "_quiet"), [key])
    loud = scan.runs(steps, [key], at, F.col(level) < F.col("_quiet"), block_ms).filter(~F.col("flag")).select(key, F.col("lo").alias("a"), (F.col("hi") + step_ms).alias("b"))
    # a short silence belongs to the speech around it: a stretch begins where the silence before is long, or with the medium
    loud = scan.previous(loud, [key], "a", "b", "before", block_ms)
    begins = F.col("before").isNull() | (F.col("a") - F.col("before") >= min_silence_ms)
    parts = scan.running_sum(loud, [key], "a", begins.cast("int"), "seg_idx", block_ms).groupBy(key, "seg_idx").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    parts = scan.with_carry(parts, whole.drop("_quiet"), [key])
    # so does one at either end of the medium
    start = F.when(F.col("a") - F.col("_first") < min_silence_ms, F.col("_first")).otherwise(F.col("a"))
    end = F.when(F.col("_len") - F.col("b") < min_silence_ms, F.col("_len")).otherwise(F.col("b"))
    return parts.select(key, F.col("seg_idx").cast("int").alias("seg_idx"), F.greatest(F.lit(0), start - keep_ms).alias("start_ms"), F.least("_len", end + keep_ms).alias("end_ms"))


def joined_in_order(parts: DataFrame, keys: list[str], at: str, text: str, separator: str = " ") -> DataFrame:
    """Texts of a group joined in order."""
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), F.col(text).alias("text")))), lambda s: s["text"]), separator).alias("text"))
