"""Loudness, speech and packing from WAV bytes against direct loops over their samples."""

from __future__ import annotations

import io
import math
import random
import struct
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspan.operators import audio
from reelspan.sources import wav


def made(seconds, rate=8000, channels=1, width=2, seed=0, quiet=(0.3, 1.2)):
    r = np.random.default_rng(seed)
    n, at, x = int(seconds * rate), 0, []
    loud = True
    while at < n:
        k = int(rate * (r.uniform(0.2, 2.0) if loud else r.uniform(*quiet)))
        x.append(r.integers(-100, 101, (k, channels)) * (1.0 if loud else 0.02) / 100)
        loud, at = not loud, at + k
    x = np.clip(np.concatenate(x)[:n], -1, 1)
    top = 2 ** (8 * width - 1) - 1
    ints = (x * top).astype(np.int64)
    if width == 1:
        data = (ints + 128).astype(np.uint8).tobytes()
    elif width == 3:
        data = b"".join(int(v).to_bytes(3, "little", signed=True) for v in ints.ravel())
    else:
        data = ints.astype("<i2" if width == 2 else "<i4").tobytes()
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(data)
    return out.getvalue(), ints


def plain(ints, rate, width, min_ms, below, keep):
    """Stretches of speech by a loop over every window."""
    length, full = round(1000 * len(ints) / rate), 2 ** (8 * min(width, 3) - 1)
    ints = ints >> 8 if width == 4 else ints
    rms = lambda a, b: math.floor(math.sqrt(float((ints[a * rate // 1000 : b * rate // 1000] ** 2).sum()) / max(1, ints[a * rate // 1000 : b * rate // 1000].size)))
    whole = math.floor(math.sqrt(float((ints**2).sum()) / ints.size))
    limit = 10 ** ((20 * math.log10(whole / full) - below) / 20) * full if whole else 0
    merged: list[list[int]] = []
    for i in range(length - min_ms + 1):
        if rms(i, i + min_ms) <= limit:
            if merged and i <= merged[-1][1]:
                merged[-1][1] = i + min_ms
            else:
                merged.append([i, i + min_ms])
    parts, at = [], 0
    for a, b in merged:
        if a > at:
            parts.append([at, a])
        at = b
    if at < length:
        parts.append([at, length])
    out = [[a - keep, b + keep] for a, b in parts]
    for x, y in zip(out, out[1:]):
        if y[0] < x[1]:
            x[1] = y[0] = (x[1] + y[0]) // 2
    return whole, [(max(0, a), min(length, b)) for a, b in out]


CASES = {"a": dict(seconds=7.3), "b": dict(seconds=5, rate=11025, channels=2, seed=1), "c": dict(seconds=4, width=3, seed=2), "d": dict(seconds=4, width=1, seed=3), "e": dict(seconds=0.2, seed=4), "f": dict(seconds=4, width=4, seed=5), "g": dict(seconds=6, seed=6, quiet=(0.35, 0.5))}


@pytest.mark.parametrize("piece", [500, 1700, 60_000])
def test_speech_by_every_window(spark, tmp_path, piece):
    want = {}
    for name, how in CASES.items():
        data, ints = made(**how)
        (tmp_path / f"{name}.wav").write_bytes(data)
        want[name] = plain(ints, how.get("rate", 8000), how.get("width", 2), 300, 14, 100)
    for name, n in (("silent", 16000), ("none", 0)):
        (tmp_path / f"{name}.wav").write_bytes(wav.wav_header(8000, 1, 2, 2 * n) + bytes(2 * n))
    pieces = wav.pieces_of(wav.wav_files(spark, str(tmp_path)), piece)
    level = {r.media_id: r for r in wav.loudness(pieces).collect()}
    assert {k: level[k].rms for k in want} == {k: v[0] for k, v in want.items()} and level["silent"].dbfs is None and "none" not in level
    got: dict = {k: [] for k in want}
    for r in wav.speech(pieces, 300, 14, 100, block_ms=2000).orderBy("media_id", "seg_idx").collect():
        got[r.media_id].append((r.start_ms, r.end_ms))
        assert r.seg_idx == len(got[r.media_id])
    assert got == {k: v[1] for k, v in want.items()} and any(len(v[1]) > 2 for v in want.values())


def test_headers():
    fmt = struct.pack("<HHIIHH", 1, 2, 44100, 176400, 4, 16)
    odd = b"RIFF\0\0\0\0WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", 0xFFFFFFFF) + bytes(41)
    h = wav.header_of(io.BytesIO(odd), len(odd))
    assert (h.rate, h.channels, h.width, h.frames) == (44100, 2, 2, 10) and odd[h.data_at :] == bytes(41)
    for bad in (b"", b"RIFF0000WAVE", odd[:50], odd.replace(b"WAVE", b"AVI "), odd.replace(fmt[:2], b"\x03\0", 1)):
        with pytest.raises(ValueError):
            wav.header_of(io.BytesIO(bad), len(bad))


def test_samples_of_segments(spark, tmp_path):
    data, ints = made(3, channels=2)
    (tmp_path / "x.wav").write_bytes(data)
    segments = spark.createDataFrame([("x", 1, 0, 10), ("x", 2, 2995, 3000)], "media_id string, seg_idx int, start_ms long, end_ms long")
    got = {r.seg_idx: bytes(r.content) for r in wav.samples_of(segments, wav.wav_files(spark, str(tmp_path))).collect()}
    assert got == {1: ints[:80].astype("<i2").tobytes(), 2: ints[2995 * 8 :].astype("<i2").tobytes()}


def test_measures_of_segments_are_those_of_their_samples(spark, tmp_path):
    (tmp_path / "x.wav").write_bytes(made(3, channels=2)[0])
    files = wav.wav_files(spark, str(tmp_path))
    segments = spark.createDataFrame([("x", i, i * 300, i * 300 + 299) for i in range(10)], "media_id string, seg_idx int, start_ms long, end_ms long")
    names = ["media_id", "seg_idx", "start_ms", "end_ms", "size_bytes", "dur_ms", "dbfs"]
    assert sorted(wav.measures_of(segments, files).select(names).collect()) == sorted(wav.measured(wav.samples_of(segments, files)).select(names).collect())
    assert wav.pieces_of(files, 10).rdd.getNumPartitions() == wav.parts_of(files)  # small rows that stand for many samples stay dealt


def test_pack_by_encoded_size(spark):
    r = random.Random(3)
    rows = [(k, i, 10, r.choice([b"a", bytes(r.randrange(256) for _ in range(50))]) * r.randrange(0, 30)) for k in ("m", "n", None) for i in range(60)]
    df = spark.createDataFrame(rows, "media_id string, seg_idx int, dur_ms long, content binary").repartition(5)
    got = audio.pack_encoded(df, 900, lambda: lambda parts: b"".join(parts)).collect()
    additive = audio.pack(df.withColumn("size_bytes", F.length("content")), 900).groupBy("media_id", "chunk_no").agg(F.min("seg_idx").alias("a"), F.max("seg_idx").alias("b"), F.sum("size_bytes").alias("n")).collect()
    assert sorted((str(x.media_id), x.chunk_no, x.first, x.last, x.size_bytes) for x in got if x.media_id) == sorted((str(x.media_id), x.chunk_no, x.a, x.b, x.n) for x in additive)
    pack = lambda parts: zlib.compress(b"".join(parts))
    want = []
    for k in ("m", "n", None):
        held, chunk = [], []
        for _, i, _, c in sorted((x for x in rows if x[0] == k), key=lambda x: x[1]):
            if held and len(pack([*held, c])) > 900:
                want.append((k, len(chunk), pack(held)))
                chunk.append(held)
                held = []
            held.append(c)
        want.append((k, len(chunk), pack(held)))
    got = [(x.media_id, x.chunk_no, bytes(x.content)) for x in audio.pack_encoded(df, 900, lambda: pack).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
