"""Box walks over generated files: what is told, and how little is read."""

from __future__ import annotations

import io
import struct

import pytest

from reelspan.sources import containers


def box(kind, *parts, wide=False):
    body = b"".join(parts)
    return struct.pack(">I4sQ", 1, kind, 16 + len(body)) + body if wide else struct.pack(">I4s", 8 + len(body), kind) + body


def track(kind, scale, steps, size=(640, 360), version=0):
    length = sum(c * d for c, d in steps)
    times = struct.pack(">BxxxQQIQI", 1, 0, 0, scale, length, 0) if version else struct.pack(">BxxxIIIII", 0, 0, 0, scale, length, 0)
    stts = box(b"stts", struct.pack(">II", 0, len(steps)), *(struct.pack(">II", c, d) for c, d in steps))
    tkhd = box(b"tkhd", bytes(76), struct.pack(">II", size[0] << 16, size[1] << 16))
    return box(b"trak", tkhd, box(b"mdia", box(b"mdhd", times), box(b"hdlr", bytes(8), kind, bytes(12)), box(b"minf", box(b"vmhd", bytes(12)), box(b"stbl", box(b"stsd", bytes(8)), stts))))


def movie(*tracks, payload=10_000, first=False, wide=False):
    moov = box(b"moov", box(b"mvhd", bytes(100)), *tracks)
    data = box(b"mdat", bytes(payload), wide=wide)
    return box(b"ftyp", b"isom" + bytes(8)) + (moov + data if first else data + moov)


class Counting(io.BytesIO):
    n = 0

    def read(self, size=-1):
        out = super().read(size)
        self.n += len(out)
        return out


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("wide", [True, False])
@pytest.mark.parametrize("version", [0, 1])
def test_rate_and_length(first, wide, version):
    data = movie(track(b"soun", 48000, [(500, 1024)]), track(b"vide", 30000, [(299, 1001), (1, 2002)], version=version), payload=5_000_000, first=first, wide=wide)
    file = Counting(data)
    h = containers.header_of(file, len(data))
    units = 299 * 1001 + 2002
    assert h == {"fps": pytest.approx(300 * 30000 / units), "frames": 300, "seconds": pytest.approx(units / 30000), "width": 640, "height": 360}
    assert file.n < 1500  # of five million


def test_odd_files(spark, tmp_path):
    many = [(1, 40 + i % 3) for i in range(200_000)]
    files = {
        "ok": movie(track(b"vide", 1000, [(50, 40)])), "steps": movie(track(b"vide", 1000, many)), "none": movie(track(b"vide", 1000, [])), "sound": movie(track(b"soun", 1000, [(5, 5)])), "empty": b"", "text": b"no movie at all, but some words",
        "cut": movie(track(b"vide", 1000, [(50, 40)]))[:-30], "open": movie(track(b"vide", 1000, [(50, 40)]), first=True)[:-10_008] + struct.pack(">I4s", 0, b"mdat") + bytes(99),
    }
    for name, data in files.items():
        (tmp_path / f"{name}.mp4").write_bytes(data)
    got = {r.video_id: r for r in containers.video_headers(spark, str(tmp_path)).collect()}
    assert {k for k, r in got.items() if r.error is None} == {"ok", "open", "steps", "none"} and set(got) == set(files) - {"empty"}
    assert (got["ok"].fps, got["ok"].frames, got["ok"].seconds) == (got["open"].fps, 50, 2.0) == (25.0, 50, 2.0)
    assert got["steps"].frames == 200_000 and got["none"].fps == 0 and got["text"].fps == 0
