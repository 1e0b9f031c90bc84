"""Byte-level BPE encoding and decoding with a two-tier look-up.

First tier: a minimal perfect hash over the vocabulary resolves a pre-token that is a vocabulary entry as a
whole.  Second tier: other pre-tokens are merged by a heap of adjacent pairs over a doubly linked list of
bytes, lowest rank first and leftmost among equals.  A bounded memo keeps the ids of recent pre-tokens.

Null and empty texts have no ids.  Special tokens are never produced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import lean, numbered

MEMO = 1 << 18
_GOLDEN = 0x9E3779B97F4A7C15


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _bytes_hash(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x)


class PerfectHash:
    """Minimal perfect hash by hash and displace: each bucket of keys has a displacement that sends its keys to free slots."""

    def __init__(self, keys: list[bytes], load: int = 4):
        self.n = n = len(keys)
        self.buckets = max(1, n // load)
        base = np.array([_bytes_hash(k) for k in keys], np.uint64)
        bucket = (base % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        groups = np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if n else []
        self.displace = np.zeros(self.buckets, np.int64)
        self.slot_of = np.zeros(n, np.int64)
        free = np.ones(n, bool)
        groups.sort(key=len, reverse=True)
        alone = [g[0] for g in groups if len(g) == 1]
        tries = np.arange(1, 257, dtype=np.uint64)[:, None] * np.uint64(_GOLDEN)
        for g in groups[: len(groups) - len(alone)]:
            d, own = 0, base[g]
            while True:  # 256 displacements at a time
                slots = (_finish(own + np.uint64(_GOLDEN * d % 2**64) + tries) % np.uint64(n)).astype(np.int64)
                good = np.flatnonzero(free[slots].all(1) & (np.diff(np.sort(slots, 1), axis=1) > 0).all(1))
                if len(good):
                    break
                d += 256
            d, slots = d + int(good[0]), slots[good[0]]
            free[slots] = False
            self.displace[bucket[g[0]]] = d
            self.slot_of[g] = slots
        # a lone key's displacement names its slot
        self.slot_of[alone] = left = np.flatnonzero(free)[: len(alone)]
        self.displace[bucket[alone]] = -1 - left
        self.displace = self.displace.tolist()
        self.keys: list[bytes] = [b""] * n
        self.values: list[int] = [0] * n
        for k, s in zip(keys, self.slot_of.tolist()):
            self.keys[s] = k

    def fill(self, values: list[int]) -> PerfectHash:
        for s, v in zip(self.slot_of.tolist(), values):
            self.values[s] = v
        return self

    def get(self, key: bytes) -> int:
        """The value of key, or -1: one slot to compare."""
        if not self.n:
            return -1
        base = _bytes_hash(key)
        d = self.displace[base % self.buckets]
        slot = _finish_one(base + _GOLDEN * (d + 1)) % self.n if d >= 0 else -1 - d
        return self.values[slot] if self.keys[slot] == key else -1


def _finish_one(x: int) -> int:
    m = 2**64 - 1
    x &= m
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Codec:
    """Encoder and decoder of one rank table and pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        keys = list(ranks)
        self.whole = PerfectHash(keys).fill([ranks[k] for k in keys])
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for k, v in ranks.items():
            self.pieces[v] = k
        self.most = memo
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no vocabulary entry.

        A heap entry is rank * 2**32 + left place.  Places link to both neighbours; an entry is stale when its
        left place is gone or its pair no longer has that rank (a rank names its pair's bytes).
        """
        get, n = self.ranks.get, len(piece)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        token = [piece[i : i + 1] for i in range(n)]
        pair = [-1] * n  # rank of the pair that begins at a place
        heap = []
        for i in range(n - 1):
            r = get(piece[i : i + 2], -1)
            if r >= 0:
                pair[i] = r
                heap.append(r << 32 | i)
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            i = x & 0xFFFFFFFF
            if pair[i] != x >> 32:
                continue
            j = after[i]
            token[i] = own = token[i] + token[j]
            token[j] = b""
            pair[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = get(own + token[k], -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = get(token[h] + own, -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | h)
        ranks = self.ranks
        return [ranks[t] for t in token if t]

    def piece_ids(self, pretoken: str) -> bytes:
        raw = pretoken.encode("utf-8", "surrogatepass")
        one = self.whole.get(raw)
        if one >= 0:
            return one.to_bytes(4, "little")
        ids = self.merge(raw)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo = self.memo
        found = self.split.findall(text)
        try:
            return b"".join([memo[x] for x in found])
        except KeyError:
            pass
        out = []
        for x in found:
            own = memo.get(x)
            if own is None:
                # two generations: a full memo becomes the old one, whose entries come back when met again
                own = self.old.get(x)
                if own is None:
                    own = self.piece_ids(x)
                if len(x) <= 64:
                    if len(memo) >= self.most:
                        self.old, self.memo = memo, {}
                        memo = self.memo
                    memo[x] = own
            out.append(own)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with column `ids`: the text's ids as little-endian unsigned 32-bit integers (null: none)."""
    return _map(docs, path, pattern, text, [(ids, "binary")], lambda own, t: (own.encode(t),))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with column `decoded`: the bytes of column `ids`."""
    return _map(docs, path, pattern, ids, [(out, "binary")], lambda own, x: (own.decode(x),), empty=b"")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256: encoding and decoding in one pass over the texts."""

    def both(own: Codec, t: str):
        ids = own.encode(t)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    return _map(docs, path, pattern, text, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], both)


def _map(docs: DataFrame, path: str, pattern: str, source: str, added: list[tuple[str, str]], f, empty="") -> DataFrame:
    names = {x for x, _ in added}
    keep = [c for c in docs.columns if c not in names]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    given = numbered(docs.select(*[F.col(f"`{c}`") for c in keep]))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    for name, kind in added:
        schema = schema.add(name, kind)
    at = keep.index(source)

    def run(batches):
        own = codec(path, pattern)
        for b in lean(batches):
            rows = [f(own, empty if x is None else x) for x in b.column(at).to_pylist()]
            made = list(zip(*rows)) or [()] * len(added)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, types[k]) for c, (_, k) in zip(made, added))], schema.names)

    return given.mapInArrow(run, schema)
