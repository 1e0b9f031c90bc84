"""Helpers the operators of this package share: tables, cutting lineage, Arrow text, word hashes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where the session names none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="reelspan-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Spark's setting by which the shuffle files of a query go with its end, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files; for those that run once."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/reelspan-{uuid.uuid4().hex}"
    with shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, with as many underscores behind it as it takes to be no column of df, in either case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named by position: mapInArrow looks columns up by name, which fails for names with a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


#: Small sides of joins are broadcast up to so many rows (a few numbers each); beyond that both sides are shuffled.
BROADCAST_ROWS = 250_000


#: Tables of bits are broadcast up to so many rows of 64; a sieve has a bit for each of as many hash values.
SLOTS = 1 << 18


def beside(rows: DataFrame, table: DataFrame, on: str, numbers: str | None = None, how: str = "inner", sparse: bool = False) -> DataFrame:
    """rows with the columns of table, which has one row a key (numbers: its array column).

    The table is counted, arrays by their items, and broadcast while it is small, so that a frequent key is in no single task.
    sparse, for inner joins: few rows meet the table, and only those that may are shuffled if it is not small.
    """
    table = cut(table)
    size = table.agg(F.coalesce(F.sum(F.size(numbers)) if numbers else F.count(F.lit(1)), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    if max(size.n, size.rows) <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on, how)
    return (sifted(rows, table, on) if sparse else rows).join(table, on, how)


def marked(rows: DataFrame, keys: DataFrame, at: Column, name: str) -> DataFrame:
    """rows with a column name: whether their position `at`, which both tables have, occurs in keys.

    Rows meet a bit for each position, not the keys: wide rows are not shuffled before SLOTS * 64 positions.
    """
    slot, bits = free_name(rows, "slot"), free_name(rows, "bits")
    bit = at.bitwiseAND(63).cast("int")
    table = cut(keys.groupBy(F.shiftright(at, 6).alias(slot)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(bits)))
    few = table.limit(SLOTS + 1).count() <= SLOTS
    met = rows.withColumn(slot, F.shiftright(at, 6)).join(F.broadcast(table) if few else table, slot, "left")
    return met.withColumn(name, F.coalesce(F.getbit(F.col(bits), bit) == 1, F.lit(False))).drop(slot, bits)


def _sieve(rows: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """rows with a column name: whether the hash of their key is one of the keys'."""
    return marked(rows, keys, F.pmod(F.xxhash64(on), F.lit(SLOTS * 64)), name)


def sifted(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """rows that may have a key of keys, by a broadcast bit for each hash value: all that have, few others.  An exact join follows."""
    name = free_name(rows, "may")
    return _sieve(rows, keys, on, name).filter(F.col(name)).drop(name)


def without(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """rows whose key is none of keys, null keys included; of many keys, only rows that may have one are shuffled."""
    keys = cut(keys.select(on).distinct())
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), on, "left_anti")
    name = free_name(rows, "may")
    told = _sieve(rows, keys, on, name)
    return told.filter(~F.col(name)).unionByName(told.filter(F.col(name)).join(keys, on, "left_anti")).drop(name)


def bucket_of(column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus: how the contracts split rows into folds."""
    return F.pmod(F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")), F.lit(modulus))


def parts_of(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what one has taken goes back to the system before the next, so that a worker kept for later tasks holds little."""
    libc = ctypes.CDLL(None)
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)


# ---------------------------------------------------------------- Arrow text

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column, without a Python object per row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each (a longer row stands alone)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


# ---------------------------------------------------------------- word hashes

#: Bytes that are hashed at once where a worker's memory counts: tables of powers and what a piece needs are about 50 times that.
PIECE = 1 << 18

#: Bytes that end a word: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and 64-bit hash of each word of a byte string, A-Z lower-cased."""
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_RANDOM[LOWER[data]] * up[: len(data)], out=total[1:])
    return start, mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def whole_words(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Pieces of a text of about `most` bytes that end at white space or at the text's end."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + most, end)
        while to < end and not SPACE[data[to]]:
            step = np.flatnonzero(SPACE[data[to : to + most]])
            to = min(to + (int(step[0]) if len(step) else most), end)
        yield data[at:to]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, hashes, offsets of each row's hashes), in pieces of bounded memory.

    Words are maximal runs of bytes other than \\x20 and \\x09-\\x0D.  A row of more than `most` bytes is
    hashed in pieces that end at white space, so memory follows the longest word, not the longest text.
    """
    for a, b in slices(offsets, most):
        if b - a == 1 and offsets[b] - offsets[a] > most:
            found = [_word_hashes(p)[1] for p in whole_words(data[offsets[a] : offsets[b]], most)]
            one = np.concatenate(found)
            yield a, b, one, np.array([0, len(one)], np.int64)
            continue
        # rows are joined without a separator, so each row's first byte must begin a word: hash rows with a space between
        own = offsets[a : b + 1] - offsets[a]
        rows = b - a
        text = np.full(int(own[-1]) + rows, 0x20, np.uint8)
        keep = np.ones(len(text), bool)
        keep[own[1:] + np.arange(rows)] = False
        text[keep] = data[offsets[a] : offsets[b]]
        start, hashes = _word_hashes(text)
        yield a, b, hashes, np.searchsorted(start, own + np.arange(rows + 1)).astype(np.int64)
