"""Order MinHash document fingerprints, sensitive to edit distance.

A text's k-mers (k code points, each numbered by its occurrence so that repeats count) are hashed once and
dealt to `buckets` buckets by that hash.  Every bucket keeps its `order` minimal k-mers, retains their order
in the text, and hashes that tuple.  The likeness of two fingerprints is the share of equal tuples among
the buckets that either fills: moving or changing text changes the tuples, where plain MinHash sees a set.

Null and empty texts: an empty fingerprint, likeness 1 with another empty one and 0 with any other.
A text shorter than k is one k-mer.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import mix, parts_of

K, BUCKETS, ORDER = 6, 64, 2
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.array([pow(_BASE, i, 2**64) for i in range(64)], np.uint64)


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    n = max(1, len(points) - k + 1)
    total = np.zeros(n, np.uint64)
    wide = points.astype(np.uint64)
    for i in range(min(k, len(points))):
        total += wide[i : i + n] * _STEPS[i]
    return mix(total, k)


def _numbered(base: np.ndarray) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order."""
    n = len(base)
    if n <= 1 << 24:
        packed = np.sort((base & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64))
        at, key = (packed & np.uint64((1 << 24) - 1)).astype(np.int64), packed >> np.uint64(24)
    else:
        at = np.argsort(base >> np.uint64(24), kind="stable")
        key = (base >> np.uint64(24))[at]
    index = np.arange(n)
    first = np.where(np.concatenate(([True], key[1:] != key[:-1])), index, 0)
    nth = index - np.maximum.accumulate(first)
    out = np.empty(n, np.uint64)
    out[at] = mix(key ^ (nth.astype(np.uint64) << np.uint64(40)), 5)
    return out


def sketch(points: np.ndarray, k: int = K, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """One 64-bit tuple hash a bucket; 0 where no k-mer fell."""
    out = np.zeros(buckets, np.uint64)
    if not len(points):
        return out
    return _tuples(_numbered(_kmers(points, k)), buckets, order)


def _tuples(h: np.ndarray, buckets: int, order: int) -> np.ndarray:
    out = np.zeros(buckets, np.uint64)
    low = np.arange(len(h)) if len(h) <= 8192 else _minimal(h, buckets, order)
    own = h[low]
    bucket, rest = own % np.uint64(buckets), own >> np.uint64(30)
    if len(low) <= 1 << 22:  # bucket, hash and place in one word: one sort
        packed = np.sort((bucket << np.uint64(56)) | ((rest << np.uint64(22)) & np.uint64((1 << 56) - 1)) | np.arange(len(low), dtype=np.uint64))
        at, bucket = (packed & np.uint64((1 << 22) - 1)).astype(np.int64), (packed >> np.uint64(56)).astype(np.int64)
    else:
        at = np.lexsort((rest, bucket))
        bucket = bucket[at].astype(np.int64)
    first = np.searchsorted(bucket, np.arange(buckets + 1))
    none = len(low)
    at = np.append(at, none)
    picks = np.minimum(first[:-1, None] + np.arange(order), len(at) - 1)
    picks = np.where(picks < first[1:, None], at[picks], none)
    picks.sort(axis=1)  # the minimal ones in text order; a bucket with fewer has fewer
    own = np.append(own, np.uint64(0))
    for r in range(order):
        there = picks[:, r] < none
        out[there] = mix(out[there] + mix(own[picks[there, r]], r), 31) | np.uint64(1)
    return out


def _minimal(h: np.ndarray, buckets: int, order: int) -> np.ndarray:
    """Positions of enough smallest hashes to fill every bucket (all of them if that fails)."""
    share = min(1.0, 24.0 * buckets * order / len(h))
    low = np.flatnonzero(h <= np.uint64(int(share * (2**64 - 1))))
    if np.bincount((h[low] % np.uint64(buckets)).astype(np.int64), minlength=buckets).min(initial=0) < order:
        low = np.arange(len(h))
    return low


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != 0) | (b != 0)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """Rows in ranges of doc_id; the first row of a range also goes to the range before it, as its guest.

    Only ids are read to place the ranges; the first ids of the ranges (as many as shuffle partitions, not
    as many as documents) are joined back, so the texts are shuffled once.
    """
    ids = docs.select("doc_id").filter("doc_id is not null")
    edges = sorted(set(ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) if parts > 1 else []
    edges = [int(x) for x in edges]
    place = F.coalesce(F.array_size(F.filter(F.array(*[F.lit(x) for x in edges]) if edges else F.array().cast("array<bigint>"), lambda x: x <= F.col("doc_id"))), F.lit(0))
    firsts = [(r.part, r.first) for r in ids.groupBy(place.alias("part")).agg(F.min("doc_id").alias("first")).orderBy("part").collect()]
    dealt = docs.withColumn("part", place)
    if not firsts:
        return dealt.withColumn("guest", F.lit(False))
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    host = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    guests = dealt.filter(F.col("doc_id").isin(*before)).withColumn("part", host[F.col("doc_id")]).withColumn("guest", F.lit(True))
    return dealt.withColumn("guest", F.lit(False)).unionByName(guests)


def order_minhash(docs: DataFrame, k: int = K, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs(doc_id, text).

    The next document is the one with the next greater doc_id (the least after the greatest; a lone document
    follows itself); of rows with one doc_id, each has the first by text of the next doc_id as its next.
    Rows without a doc_id come first and take the first document with one as their next.
    """
    parts = parts_of(docs)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = _dealt(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), parts)

    def hexed(s: np.ndarray) -> str:
        return s.astype(">u8").tobytes().hex() if s.any() else ""

    def run(batches):
        waiting: list = []  # rows of the doc_id whose next is not yet known
        out: list = []
        was = None  # (part, doc_id) of those rows
        known: dict = {}

        def mark(text, points):
            if known.get("text") != text:
                known.update(text=text, mark=sketch(points, k, buckets, order))
            return known["mark"]

        def settle(nxt_points, nxt_mark):
            for doc_id, points, own in waiting:
                n = len(points)
                half = n // 2
                edited = np.concatenate([points[: n - half], nxt_points[:half]])
                e = sketch(edited, k, buckets, order) if half else own
                out.append((doc_id, n, hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest(), hexed(own), hexed(e), likeness(own, e), likeness(own, nxt_mark)))
            waiting.clear()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            out.clear()
            return made

        for b in batches:
            cols = [b.column(i) for i in range(4)]
            for i in range(b.num_rows):
                part, doc_id, guest, text = cols[0][i].as_py(), cols[1][i].as_py(), cols[2][i].as_py(), cols[3][i].as_py()
                if (part, doc_id, guest) != was or (guest and waiting):
                    points = _points(text)
                    own = mark(text, points)
                    if waiting:
                        settle(points, own)
                elif not guest:
                    points = _points(text)
                    own = mark(text, points)
                if not guest:
                    waiting.append((doc_id, points, own))
                was = (part, doc_id, guest)
            if out:
                yield batch()
        if waiting:  # a lone part without a guest: nothing but rows without doc_id
            settle(waiting[0][1], waiting[0][2])
        if out:
            yield batch()

    # the guest closes its part: it sorts last whatever its doc_id
    placed = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "text").select("part", "doc_id", "guest", "text")
    return placed.mapInArrow(run, schema)
