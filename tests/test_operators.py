"""Boundary cases of the operators, from their written semantics."""

from __future__ import annotations

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspan.functions import text as X
from reelspan.operators import audio, enrich, keys, metrics, shots, vectors
from reelspan.plans import registry
from reelspan.sources import files
from reelspan.streaming import metrics as streaming

SF = "/root/testdata/sf0.001"


def series(spark, rows):
    return spark.createDataFrame([(v, i, float(np.float32(p))) for v, bits in rows.items() for i, p in enumerate(bits)], "video_id string, frame_idx int, p_single float")


def plain_shots(bits):
    out, i, n = [], 0, len(bits)
    if n and all(bits):
        return [(0, n - 1)]
    while i < n:
        if bits[i]:
            i += 1
            continue
        j = i
        while j + 1 < n and not bits[j + 1]:
            j += 1
        out.append((i, min(j + 1, n - 1)))
        i = j + 1
    return out


def test_shots(spark):
    cases = {"".join(map(str, b)): b for n in range(1, 7) for b in itertools.product((0, 1), repeat=n)}
    rows = {k: [0.9 if x else 0.3 for x in b] for k, b in cases.items()}
    got: dict = {}
    for r in shots.shots_from_scores(series(spark, rows)).orderBy("video_id", "shot_id").collect():
        got.setdefault(r.video_id, []).append((r.start_idx, r.end_idx))
    assert got == {k: plain_shots(b) for k, b in cases.items()}
    assert shots.shots_from_scores(series(spark, {"a": []})).count() == 0


def test_range_join_has_no_nested_loop(spark):
    f = series(spark, {"a": [0.1] * 200})
    s = spark.createDataFrame([("a", 1, 0, 70), ("a", 2, 71, 199)], "video_id string, shot_id int, start_idx int, end_idx int")
    out = shots.frames_of_shots(f, s)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {(r.shot_id, r["count"]) for r in out.groupBy("shot_id").count().collect()} == {(1, 71), (2, 129)}


@pytest.mark.parametrize(("n", "kept"), [(55, 55), (56, 56), (109, 109), (110, 55), (111, 56), (165, 55)])
def test_decimation(spark, n, kept):
    assert shots.decimate(series(spark, {"a": [0.1] * n}), 55, ["video_id"]).count() == kept


@pytest.mark.parametrize(("n", "windows"), [(1, 1), (50, 1), (51, 2), (100, 2)])
def test_windows(spark, n, windows):
    w = shots.sliding_windows(series(spark, {"a": [0.1] * n}))
    assert w.select("window_id").distinct().count() == windows and w.count() == 100 * windows
    assert sorted(r.frame_idx for r in w.filter("kept").collect()) == list(range(n))


def test_dedup_keeps_a_and_c(spark):
    v = [[1.0, 0.0], [0.8, 0.6], [0.28, 0.96]]  # a-b 0.8, b-c 0.8, a-c 0.28
    rows = spark.createDataFrame([(0, i, x) for i, x in enumerate(v)], "shot_id int, frame_idx int, embedding array<float>")
    assert sorted(r.frame_idx for r in vectors.greedy_dedup(rows, 0.7, ["shot_id"]).collect()) == [0, 2]
    assert vectors.greedy_dedup(rows, 0.99, ["shot_id"]).count() == 3


def test_dedup_by_brute_force(spark):
    from reelspan.plans.proxies import small_shots

    rows = small_shots(spark, SF).collect()
    want = []
    for s in {r.shot_id for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r.shot_id == s), key=lambda r: r.frame_idx):
            if not any(np.dot(np.array(r.embedding), np.array(k.embedding)) > 0.2 for k in kept):
                kept.append(r)
        want += [(s, r.frame_idx) for r in kept]
    assert sorted(map(tuple, registry.QUERIES["greedy_dedup"](spark, SF).select("shot_id", "frame_idx").collect())) == sorted(want)


def test_keyframes(spark):
    x = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99], [0.05, 1]], float)
    rows = spark.createDataFrame([(0, i, v.tolist()) for i, v in enumerate(x)] + [(1, i, [1.0, 0.0]) for i in range(3)], "shot_id int, frame_idx int, embedding array<double>")
    got = vectors.keyframes_of_shots(rows, ["shot_id"]).collect()
    assert sorted(r.frame_idx for r in got if r.shot_id == 1) == [0, 1, 2]
    own = [r.frame_idx for r in got if r.shot_id == 0]
    assert len(own) == 2 and len({i < 2 for i in own}) == 2
    labels = np.array([0, 0, 1, 1, 1])
    assert vectors.silhouette(x, labels) > 0.8 > vectors.silhouette(x, np.array([0, 1, 0, 1, 0]))


def test_time_stamps_and_accents(spark):
    cases = [(0, 25.0, "00:00.000"), (75, 30000 / 1001, "00:02.502"), (3, 48.0, "00:00.062"), (8991, 30000 / 1001, "04:60.000")]
    rows = spark.createDataFrame([(i / f, w) for i, f, w in cases], "t double, want string")
    assert all(r.got == r.want for r in rows.select("want", X.time_stamp("t").alias("got")).collect())
    rows = spark.createDataFrame([("ấ", "a"), ("Å", "A"), ("đ", "đ"), ("ﬁ", "ﬁ"), (None, None)], "x string, want string")
    assert all(r.got == r.want for r in rows.select("want", X.fold_accents("x").alias("got")).collect())


def test_ocr_text(spark):
    cases = [('```json\n{"extracted_texts":[" a ","b"]}\n```', "a"), ('{"extracted_texts":[]}', ""), ('{"extracted_texts":[1]}', ""), ('{"other":1}', '{"other":1}'), ("plain text", "plain text"), ("{bad", "{bad")]
    rows = spark.createDataFrame(cases, "raw string, want string")
    assert [(r.want, r.got) for r in rows.select("want", X.ocr_text(F.col("raw")).alias("got")).collect() if r.want != r.got] == []


def test_numeric_order_and_repair(spark):
    names = spark.createDataFrame([("frame_1000",), ("frame_999",)], "name string")
    assert [r.name for r in names.orderBy(enrich.numeric_suffix(F.col("name"))).collect()] == ["frame_999", "frame_1000"]
    meta = spark.createDataFrame([("frame_001", 1), ("frame_003", 2)], "name string, shot int")
    info = spark.createDataFrame([("frame_001", 1), ("frame_002", 1), ("frame_003", 2)], "name string, shot int")
    saved = spark.createDataFrame([(f"frame_{i:03d}",) for i in (1, 2, 3, 99)], "name string")
    got = {r.name: r.shot for r in enrich.repair(meta, saved, info, ["name"], ["shot"]).collect()}
    assert got == {"frame_001": "1", "frame_002": "1", "frame_003": "2", "frame_099": "unknown"}


def test_packing(spark):
    def chunks(sizes):
        rows = spark.createDataFrame([("m", i, s) for i, s in enumerate(sizes)], "media_id string, seg_idx int, size_bytes long")
        return [r.chunk_no for r in audio.pack(rows, 100).orderBy("seg_idx").collect()]

    assert chunks([40, 60, 1]) == [0, 0, 1]
    assert chunks([150, 10]) == [0, 1]


def test_metadata(spark):
    lines = registry.QUERIES["metadata_documents"](spark, SF).orderBy("video_id", "line_no").collect()
    for video in sorted({r.video_id for r in lines})[:3]:
        made = "\n".join(r.line for r in lines if r.video_id == video)
        own = json.loads(made)
        frames = own[str(video)]
        assert list(frames) == sorted(frames) and list(next(iter(frames.values()))) == ["id", "time-stamp", "shot", "tags", "ocr", "caption"]
        assert json.dumps(own, indent=3, ensure_ascii=False) == made and "é" in made


def test_errors_routes_and_uris(spark):
    def same(cases, schema, made):
        rows = spark.createDataFrame(cases, schema)
        assert [(r.want, r.got) for r in rows.select("want", made.alias("got")).collect() if r.want != r.got] == []

    errors = [("429 RESOURCE_EXHAUSTED", "gemini", "retire"), ("API key expired, quota left", "gemini", "retire"), ("API Key Not Valid", "gemini", "remove"), ("Unauthorized", "gemini", "retire"), ("Unauthorized", "mistral", "retire"), ("suspended", "mistral", "other"), ("504", "mistral", "other"), ("PERMISSION_DENIED", "gemini", "remove"), ("strange", "gemini", "retire")]
    same(errors, "e string, p string, want string", X.error_class(F.col("e"), F.col("p")))
    same([("GPT-4o", "gemini"), ("gpt-4-vision-preview", "gemini"), ("gpt-4o-mini", "unsupported"), ("Pixtral-x", "mistral"), (" gemini-pro", "unsupported"), ("", "unsupported")], "m string, want string", X.model_route(F.col("m")))
    same([("data:image/png;base64,aGVsbG8=", True), ("data:image/png,aGVs", False), ("data:image/png;base64,aGVsbG8", False), ("data:image/png;base64,", True), ("data:image/png;base64,aG\nVs", False), ("data:text/plain;base64,aGVs", False), (None, False)], "u string, want boolean", X.is_image_uri(F.col("u")))
    same([('so {"a": 1} it', '{"a": 1}'), ("{bad}", None), ("none", None), ("} {", None)], "x string, want string", X.json_object(F.col("x")))
    same([("Connection refused by x", "Connection Failed. Is the AI Gateway server running at http://h?"), ("Timed out", "An unhandled error occurred: Timed out")], "e string, want string", X.user_message(F.col("e"), "http://h"))
    same([(0, "0:00:00"), (86_399, "23:59:59"), (90_061, "1 day, 1:01:01"), (200_000, "2 days, 7:33:20")], "s long, want string", X.uptime(F.col("s")))


def test_png(spark):
    import struct
    import zlib

    rgb = bytes(range(2 * 3 * 3))
    got = spark.createDataFrame([(2, 3, rgb), (2, 2, rgb), (2, 3, None)], "w int, h int, x binary").select(X.png("w", "h", "x").alias("p")).collect()
    data = bytes(got[0].p)
    at = data.index(b"IDAT")
    size = struct.unpack(">I", data[at - 4 : at])[0]
    rows = zlib.decompress(data[at + 4 : at + 4 + size])
    assert b"".join(rows[7 * i + 1 : 7 * i + 7] for i in range(3)) == rgb and data[16:24] == struct.pack(">II", 2, 3)
    assert got[1].p is None and got[2].p is None


def test_key_pool():
    p = keys.Pool(10)
    assert p.apply(0, "select", None) == (None, "no keys")
    for t in "abc":
        p.apply(0, "load", t)
    # the turn moves on over the keys that are free at each call
    assert [p.apply(0, "select", None)[0] for _ in range(4)] == ["a", "c", "b", None]
    p = keys.Pool(10)
    p.apply(0, "load", "a")
    assert p.apply(0, "select", None) == ("a", "in_use")
    assert p.apply(1, "retire", "b") == ("b", "ignored")
    assert p.apply(10, "release", "a") == ("a", "cooling")
    assert p.apply(16, "select", None)[1] == "none free"  # exactly 60 / rpm later is too early
    assert p.apply(16.01, "select", None) == ("a", "in_use")
    assert p.apply(20, "retire", "a") == ("a", "retired")
    assert p.apply(21, "release", "a") == ("a", "ignored")
    assert p.apply(109, "select", None)[1] == "none free"
    assert p.apply(110, "select", None) == ("a", "in_use")
    for i in range(4):
        p.apply(200 + i, "retire", "a")
    assert p.keys["a"].until == 203 + keys.PENALTY_S  # the fifth failure since the last success
    p.apply(300, "remove", "a")
    assert p.apply(301, "load", "a") == ("a", "known") and p.apply(302, "select", None)[1] == "none free"


def test_streams_equal_batches(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.select("ts", "event_id").repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, event_id long").parquet(str(tmp_path / "in"))
    q = streaming.per_minute(stream.withColumn("ts", F.col("ts").cast("timestamp"))).writeStream.outputMode("complete").format("memory").queryName("minutes").start()
    q.processAllAvailable()
    q.stop()
    batch = e.groupBy(F.window(F.col("ts").cast("timestamp"), "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start"), "n")
    assert sorted(map(tuple, spark.table("minutes").collect())) == sorted(map(tuple, batch.collect()))


def test_pool_stream_equals_replay(spark, tmp_path):
    from reelspan.plans.requests import _key_events

    ev = _key_events(spark, SF)
    middle = ev.approxQuantile("at_s", [0.5], 0.0)[0]
    for part in (ev.filter(F.col("at_s") <= middle), ev.filter(F.col("at_s") > middle)):  # two runs over one checkpoint
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "ev"))
        stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
        q = keys.pool_stream(stream, 10).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination(240)
        q.stop()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, keys.replay(ev, 10).collect())))


def test_sources(spark, tmp_path):
    (tmp_path / "keys.csv").write_text(" Token ,Name\nab,x\nab,y\n,z\ncd,\n")
    assert [(r.token, r.name) for r in keys.clean_sheet(files.key_sheet(spark, str(tmp_path / "keys.csv"))).collect()] == [("ab", "x")]
    (tmp_path / "plain.csv").write_text("k1 \nk2\n")
    assert sorted(r.token for r in files.plain_keys(spark, str(tmp_path / "plain.csv")).collect()) == ["k1", "k2"]
    (tmp_path / "v.mp4").write_bytes(bytes(range(10)))
    decoder = lambda: (lambda content: ((i, content[i : i + 1]) for i in range(len(content))))
    got = files.decode(files.videos(spark, str(tmp_path)), decoder, rate=5)
    assert sorted((r.video_id, r.frame_idx, bytes(r.pixels)) for r in got.collect()) == [("v", 0, b"\x00"), ("v", 5, b"\x05")]
    (tmp_path / "f.webp").write_bytes(b"x")
    assert [(r.name, r.mime) for r in files.images(spark, str(tmp_path)).collect()] == [("f.webp", "image/webp")]
    model = lambda: (lambda images: [[float(len(x)), 1.0] for x in images])
    assert vectors.embed(got, model).first().embedding == [1.0, 1.0]


def test_rates_without_requests(spark):
    none = spark.createDataFrame([], "model string, success boolean, has_images boolean")
    assert metrics.counters(none, []).first().success_rate == 0


def test_scored_frames(spark):
    frames = spark.createDataFrame([("v", i, bytes([i])) for i in range(60)], "video_id string, frame_idx int, pixels binary")
    model = lambda: (lambda pixels: [float(p[0]) for p in pixels])
    got = sorted(map(tuple, shots.score_frames(frames, model).collect()))
    assert got == [("v", i, float(i)) for i in range(60)]


def test_sinks(spark, tmp_path):
    from reelspan.sources import sinks

    rows = spark.createDataFrame([("v", 1, "b"), ("v", 0, "a"), ("w", 0, "é")], "video_id string, line_no int, line string")
    sinks.write_documents(rows, str(tmp_path / "out"), "video_id", "line", "line_no")
    assert "".join(p.read_text() for p in (tmp_path / "out" / "video_id=v").glob("part*")) == "a\nb\n"
    files_df = spark.createDataFrame([("a.webp", b"12")], "name string, content binary")
    assert sinks.write_files(files_df, str(tmp_path / "img")).collect()[0].n_bytes == 2
    assert (tmp_path / "img" / "a.webp").read_bytes() == b"12"

    class Client:
        def send(self, batch):
            return batch["batch_no"] < 1

        def fallback(self, key):
            return key == "w"

    batches = spark.createDataFrame([("v", 0), ("v", 1), ("w", 0)], "video_id string, batch_no long")
    got = {r.video_id: (r.sent, r.total, r.delivered) for r in sinks.upload(batches, Client).collect()}
    assert got == {"v": (1, 2, False), "w": (1, 1, True)}


def test_snapshots_and_correlation(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "m", True), ("r2", "m", False), ("r3", "n", True)], "request_id string, model string, success boolean")
    rows.write.parquet(str(tmp_path / "r"))
    seen: dict = {}
    q = streaming.snapshots(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "r")), lambda df, epoch: seen.update({r.model: (r.total, r.succeeded) for r in df.collect()}))
    q.processAllAvailable()
    q.stop()
    assert seen == {"m": (2, 1), "n": (1, 1)}
    t = "timestamp'2024-01-01 00:00:00'"
    spark.sql(f"select 'a' request_id, {t} start_ts union all select 'b', {t}").write.parquet(str(tmp_path / "s"))
    spark.sql(f"select 'a' request_id, {t} + interval 5 seconds end_ts union all select 'zz', {t}").write.parquet(str(tmp_path / "e"))
    starts = spark.readStream.schema("request_id string, start_ts timestamp").parquet(str(tmp_path / "s"))
    ends = spark.readStream.schema("request_id string, end_ts timestamp").parquet(str(tmp_path / "e"))
    q = streaming.correlate(starts, ends).writeStream.outputMode("append").format("memory").queryName("both").start()
    q.processAllAvailable()
    q.stop()
    assert [r.request_id for r in spark.table("both").collect()] == ["a"]


def test_model_slot(spark):
    rows = enrich.micro_batches(spark.createDataFrame([(0, i, f"img{i}") for i in range(8)], "video_id int, k int, image string"), 6, ["video_id"], ["k"])
    caption = lambda: (lambda frame: frame.assign(caption=[f"{x} of {len(frame)}" for x in frame["image"]])[["k", "caption"]])
    got = {r.k: r.caption for r in enrich.apply_model(rows, caption, "k int, caption string", ["video_id", "batch_no"]).collect()}
    assert (got[0], got[7]) == ("img0 of 6", "img7 of 2")


def test_model_is_built_once_a_worker(spark, tmp_path):
    log = str(tmp_path / "built")

    def model():
        import os

        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda frame: frame.assign(n=len(frame))[["video_id", "k", "n"]]

    rows = enrich.micro_batches(spark.range(900).selectExpr("cast(id % 7 as int) video_id", "cast(id as int) k"), 6, ["video_id"], ["k"]).repartition(16)
    got = enrich.apply_model(rows, model, "video_id int, k int, n long", ["video_id", "batch_no"]).collect()
    sizes = {}
    for r in rows.collect():
        sizes[r.video_id, r.batch_no] = sizes.get((r.video_id, r.batch_no), 0) + 1
    batch = {(r.video_id, r.k): r.batch_no for r in rows.collect()}
    assert len(got) == 900 and all(r.n == sizes[r.video_id, batch[r.video_id, r.k]] for r in got)
    built = open(log).read().split()
    assert len(built) == len(set(built))


def test_silhouette_and_k_by_brute_force():
    r = np.random.default_rng(8)
    x = np.concatenate([r.normal(c, 0.3, (9, 3)) for c in (0, 4, 8)])
    labels = r.integers(0, 4, len(x))
    total = []
    for i in range(len(x)):
        d = [float(np.linalg.norm(x[i] - y)) for y in x]
        own = [d[j] for j in range(len(x)) if labels[j] == labels[i] and j != i]
        others = [np.mean([d[j] for j in range(len(x)) if labels[j] == k]) for k in set(labels.tolist()) - {int(labels[i])}]
        total.append(0.0 if not own else (min(others) - np.mean(own)) / max(min(others), np.mean(own)))
    assert vectors.silhouette(x, labels) == pytest.approx(np.mean(total))
    best = vectors.best_clusters(x)
    scores = {k: vectors.silhouette(x, vectors.kmeans(x, k)) for k in range(2, 6)}
    assert len(np.unique(best)) == max(scores, key=lambda k: (scores[k], -k)) == 3
    assert all(len(np.unique(best[i : i + 9])) == 1 for i in (0, 9, 18))
