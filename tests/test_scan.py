"""Two-level scans against plain windows and plain loops, whatever the width of a block."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelspan.operators import audio, metrics, scan, shots


@pytest.fixture(scope="module")
def series(spark):
    r = random.Random(4)
    rows = [(k, i, r.random() < 0.5 if r.random() < 0.3 else None if r.random() < 0.02 else i // 9 % 2 == 0, r.randrange(10)) for k, n in (("a", 400), ("b", 37), (None, 25), ("c", 1)) for i in sorted(r.sample(range(500), n))]
    return spark.createDataFrame(rows, "k string, i int, f boolean, v int").cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [1, 3, 50, 10_000])
def test_running_sum_previous_and_numbers(series, width):
    w = Window.partitionBy("k").orderBy("i")
    plain = series.select("k", "i", F.sum("v").over(w).alias("s"), F.lag("f").over(w).alias("p"), F.row_number().over(w).alias("n"))
    mine = scan.row_numbers(scan.previous(scan.running_sum(series, ["k"], "i", F.col("v"), "s", width), ["k"], "i", "f", "p", width), ["k"], "i", "n", width)
    assert rows(mine.select("k", "i", "s", "p", "n")) == rows(plain)


@pytest.mark.parametrize("width", [1, 2, 7, 64, 10_000])
def test_runs(series, width):
    want, was = [], None
    for k, i, f, _ in sorted(series.collect(), key=lambda r: (str(r.k), r.i)):
        f = bool(f)
        if was == (k, f):
            want[-1] = (*want[-1][:3], i)
        else:
            want.append((k, f, i, i))
        was = (k, f)
    got = scan.runs(series, ["k"], "i", F.col("f"), width)
    assert rows(got.select("k", "flag", "lo", "hi")) == sorted(want, key=repr)
    ends = {k: (min(w[2] for w in want if w[0] == k), max(w[3] for w in want if w[0] == k)) for k in ("a", "b", None, "c")}
    assert all((r.begins, r.ends) == (r.lo == ends[r.k][0], r.hi == ends[r.k][1]) for r in got.collect())


@pytest.mark.parametrize("width", [1, 20, 10_000])
@pytest.mark.parametrize("last", [1, 5, 60])
def test_last_rows(series, width, last):
    w = Window.partitionBy("k").orderBy("i").rowsBetween(-(last - 1), 0)
    mine = scan.last_rows(series, ["k"], "i", F.sum("v"), "m", last, width, most=16)
    assert rows(mine.select("k", "i", "m")) == rows(series.select("k", "i", F.sum("v").over(w).alias("m")))


@pytest.mark.parametrize("block", [1, 4, 1 << 16])
def test_shots_do_not_depend_on_blocks(spark, block):
    r = random.Random(5)
    data = {f"v{n}": [r.random() < 0.4 for _ in range(n)] for n in range(1, 30)} | {"ones": [True] * 20, "zeros": [False] * 20}
    df = spark.createDataFrame([(k, i, 0.9 if b else 0.1) for k, bits in data.items() for i, b in enumerate(bits)], "video_id string, frame_idx int, p_single float")
    want = []
    for k, bits in data.items():
        if all(bits):
            want.append((k, 1, 0, len(bits) - 1))
            continue
        n = i = 0
        while i < len(bits):
            j = i
            while j < len(bits) and not bits[j]:
                j += 1
            if j > i:
                n += 1
                want.append((k, n, i, min(j, len(bits) - 1)))
            i = max(j, i + 1)
    assert rows(shots.shots_from_scores(df, block=block)) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [1.0, 30.0, 1e9])
def test_peak(spark, block):
    r = random.Random(6)
    data = [(k, s, s + r.choice([0, 1, 5, 300])) for k in "ab" for s in (r.randrange(500) for _ in range(200))]
    want = []
    for k in "ab":
        events = sorted([(s, 1) for x, s, _ in data if x == k] + [(e, -1) for x, _, e in data if x == k])
        now, best = 0, 0
        for _, d in events:
            now += d
            best = max(best, now) if d == 1 else best
        want.append((k, best))
    df = spark.createDataFrame([(k, float(s), float(e)) for k, s, e in data], "model string, start_s double, end_s double")
    assert rows(metrics.peak_concurrency(df, "model", block)) == want


@pytest.mark.parametrize("block", [100, 700, 3_600_000])
def test_speech(spark, block):
    r = random.Random(7)
    data = {f"m{n}": [r.random() < 0.5 if r.random() < 0.2 else i // r.choice([5, 11, 30]) % 2 == 0 for i in range(n)] for n in (1, 2, 5, 40, 200, 333)} | {"silent": [True] * 30, "loud": [False] * 30}
    want = []
    for k, quiet in data.items():
        level = [-60.0 if q else -20.0 for q in quiet]
        bar = sum(level) / len(level) - 14
        q, n, parts = [x < bar for x in level], len(level), []
        silent, i = [False] * n, 0
        while i < n:
            j = i
            while j < n and q[j] == q[i]:
                j += 1
            if q[i] and (j - i) * 100 >= 700:
                silent[i:j] = [True] * (j - i)
            i = j
        i = 0
        while i < n:
            j = i
            while j < n and silent[j] == silent[i]:
                j += 1
            if not silent[i] and not all(q[i:j]):
                parts.append((max(0, i * 100 - 300), min(n * 100, j * 100 + 300)))
            i = j
        want += [(k, s + 1, a, b) for s, (a, b) in enumerate(parts)]
    df = spark.createDataFrame([(k, i * 100, -60.0 if q else -20.0) for k, quiet in data.items() for i, q in enumerate(quiet)], "media_id string, ms long, dbfs double")
    assert rows(audio.speech(df, block_ms=block)) == sorted(want, key=repr)


def test_one_long_series_is_in_no_single_task(spark):
    """Ten million frames of one video: the largest share of a window's rows in one task stays near a block."""
    n, block = 10_000_000, 1 << 16
    frames = spark.range(n, numPartitions=8).select(F.lit("v").alias("video_id"), F.col("id").alias("frame_idx"), F.when(F.col("id") % 1000 == 999, 0.9).otherwise(0.1).cast("float").alias("p_single"))
    out = shots.shots_from_scores(frames, block=block)
    plan = out._jdf.queryExecution().executedPlan().toString()
    widest = [x for x in plan.splitlines() if "Window [" in x and scan.BLOCK not in x.split("], [")[1]]
    assert len(widest) <= 4  # windows by key alone: over one or two rows a block
    dealt = spark.range(n).select(F.lit("v").alias("k"), F.floor(F.col("id") / block).alias("b")).repartition(64, "k", "b").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert dealt <= 10 * block
    assert out.count() == n // 1000 and out.agg(F.max("shot_id")).first()[0] == n // 1000
    one = out.filter("shot_id = 66").first()
    assert (one.start_idx, one.end_idx) == (65000, 65999)
