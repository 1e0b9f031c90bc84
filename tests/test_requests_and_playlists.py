"""Media types, request bodies, image parts, headerless key sheets and playlists, each from its written semantics."""

from __future__ import annotations

import base64
import json
import mimetypes
import re

from pyspark.sql import functions as F

from reelspan.functions import text as X
from reelspan.operators import messages
from reelspan.plans import requests as plans
from reelspan.sources import files, sinks


def test_media_types_of_all_known_endings(spark):
    known = mimetypes.MimeTypes()
    names = [f"x{e}" for e in known.types_map[True]] + [f"X{e.upper()}" for e in known.types_map[True]] + plans.NAMES + ["a/b.c/d", "x.mp3.Z", "x.mp3.z", "x.gz", "a.b.webm", " .mp3", "é.mp3"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", X.media_type(F.col("n")).alias("t")).collect()
    for r in rows:
        want = known.guess_type(r.n)[0]
        assert r.t == (want if want and want.split("/")[0] in ("image", "audio", "video") else None), r.n


def test_truth_of_stream(spark):
    def status(body):
        try:
            v = json.loads(body)
        except ValueError:
            return 400
        return 500 if not isinstance(v, dict) else 400 if v.get("stream") else 200

    bodies = [*plans.BODIES, '{"stream": 12345678901234567890}', '{"stream": 0.00}', '{"stream": [[]]}', '{"Stream": true}', "null", "3"]
    rows = spark.createDataFrame([(b,) for b in bodies], "b string").select("b", messages.chat_request_status(F.col("b")).alias("s")).collect()
    assert {r.b: r.s for r in rows} == {b: status(b) for b in bodies}


def test_image_parts_hold_the_files(spark):
    stored = spark.createDataFrame([("a.png", b"\x00\x01" * 100), ("b.doc", b"x"), ("d/c.JPG", b""), ("n.png", None)], "path string, content binary")
    asked = spark.createDataFrame([(1, ["a.png", "b.doc", "d/c.JPG", "gone.png", "a.png"]), (2, []), (3, None), (4, ["n.png"])], "id int, images array<string>")
    rows = messages.with_pictures(asked, stored, "id").withColumn("m", messages.assemble(F.lit("hi"), F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("pictures")))
    got = {r.id: r.m for r in rows.collect()}
    a = "data:image/png;base64," + base64.b64encode(b"\x00\x01" * 100).decode()
    text = "[Error processing image 4: Error processing image file gone.png: Image file not found at gone.png]\n[Error processing image 2: Error processing image file b.doc: Unsupported or unknown image format for file: b.doc]\nhi"
    assert [tuple(p) for p in got[1].parts] == [("text", text), ("image_url", a), ("image_url", "data:image/jpeg;base64,"), ("image_url", a)]
    assert [tuple(p) for p in got[2].parts] == [tuple(p) for p in got[3].parts] == [("text", "hi")] and got[4].parts[0].value.startswith("[Error processing image 1")


def test_headerless_keys(spark, tmp_path):
    (tmp_path / "k.csv").write_text('abcdefghij,x\n  \n"\tabcdefghij ",y\nNA\nnull\nshort\n\nzz-1234-zz,1\n" "\nshort\n')
    got = {r.token: (r["name"], r.place) for r in files.plain_keys(spark, str(tmp_path / "k.csv")).collect()}
    import io

    import pandas as pd

    want = {}
    for i, token in enumerate(pd.read_csv(io.StringIO((tmp_path / "k.csv").read_text()), header=None, dtype=str, usecols=[0], names=[0, 1])[0].dropna().str.strip().unique()):
        if token:
            want[token] = (f"mistral-{token[:4]}...{token[-4:]}-{i}", i)
    assert got == want and len(got) == 3


def held(spark, rows):
    return spark.createDataFrame([(p, c if isinstance(c, bytes) else c.encode()) for p, c in rows.items()], "path string, content binary")


MASTER = "#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\n{0}\n#EXT-X-STREAM-INF:BANDWIDTH=2\nother.m3u8\n"


def test_playlists(spark, tmp_path):
    stored = {
        "v/top.m3u8": MASTER.format("low/list.m3u8"), "v/low/list.m3u8": "#EXTM3U\r\n#EXTINF:9,\r\ns1.ts\r\n#EXTINF:9,\r\n../s2.ts\r\n#EXTINF:9,\r\nhttps://h/s3.ts\r\n", "v/s1.ts": b"\x00one", "v/low/s1.ts": b"low", "s2.ts": b"two", "v/s2.ts": b"TWO", "https://h/s3.ts": b"three",
        "flat.m3u8": "#EXTM3U\ns2.ts\n./s2.ts\nnone.ts\n", "deep.m3u8": MASTER.format("v/top.m3u8"), "empty.m3u8": "#EXTM3U\n", "long.m3u8": "\n".join(f"p/{i}.ts" for i in range(300)),
    } | {f"p/{i}.ts": bytes([i % 256]) * 50 for i in range(300)}
    lists = spark.createDataFrame([(p,) for p in ("v/top.m3u8", "flat.m3u8", "deep.m3u8", "empty.m3u8", "absent.m3u8", "long.m3u8")], "path string")
    rows = files.segments_of_playlists(lists, held(spark, stored))
    got: dict = {}
    for r in rows.orderBy("path", "pos").collect():
        got.setdefault(r.path, []).append((r.segment, r.content and bytes(r.content), r.error))
    assert got["v/top.m3u8"] == [("v/s1.ts", b"\x00one", None), ("s2.ts", b"two", None), ("https://h/s3.ts", b"three", None)]
    assert [x[1] for x in got["flat.m3u8"]] == [b"two", b"two", None] and got["flat.m3u8"][2][2] == "no segment none.ts"
    assert got["absent.m3u8"] == [(None, None, "no playlist absent.m3u8")] and "empty.m3u8" not in got and "deep.m3u8" not in got
    own = files.segments_of_playlists(lists, held(spark, stored), depth=2, beside_own=True).filter("path like '%e%p.m3u8' or path = 'v/top.m3u8'").orderBy("path", "pos").collect()
    assert [(r.path, bytes(r.content)) for r in own] == [("deep.m3u8", b"low"), ("deep.m3u8", b"TWO"), ("deep.m3u8", b"three"), ("v/top.m3u8", b"low"), ("v/top.m3u8", b"TWO"), ("v/top.m3u8", b"three")]
    sinks.write_joined(rows.filter("error is null").repartition(7), str(tmp_path / "j"))
    assert (tmp_path / "j" / "v" / "top.m3u8").read_bytes() == b"\x00onetwothree"
    assert (tmp_path / "j" / "long.m3u8").read_bytes() == b"".join(bytes([i % 256]) * 50 for i in range(300))


def test_contents_are_dealt_by_size(spark, monkeypatch):
    """40 segments of 1,000 bytes at 2,000 a task: 20 tasks and no fewer, whatever the session's number is; dealt once for all joins."""
    monkeypatch.setattr(files, "DEALT", 2000)
    stored = spark.createDataFrame([("p.m3u8", b"\n".join(b"%d.ts" % i for i in range(40)))] + [(f"{i}.ts", bytes([i]) * 1000) for i in range(40)], "path string, content binary")
    rows = files.segments_of_playlists(stored.filter("path = 'p.m3u8'").select("path"), stored)
    assert [(r.pos, r.segment, bytes(r.content), r.error) for r in rows.orderBy("pos").collect()] == [(i, f"{i}.ts", bytes([i]) * 1000, None) for i in range(40)]
    dealt = re.findall(r"hashpartitioning\(path#\d+, (\d+)\), REPARTITION_BY_NUM", rows._jdf.queryExecution().executedPlan().toString())
    assert dealt and min(map(int, dealt)) >= 20
