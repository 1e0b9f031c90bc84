"""The throttle over a stream against the batch form, over restarts, and against a plain bucket."""

from __future__ import annotations

import random
import time

import pandas as pd
from pyspark.sql import functions as F

from reelspan.operators import keys
from reelspan.streaming import throttle

SCHEMA = "provider string, id long, ts timestamp"


def arrivals(seed=1, n=120):
    r = random.Random(seed)
    return [(p, i, 1_700_000_000 + r.choice([i, i // 10 * 10, i * 3]) + r.random()) for i in range(n) for p in r.sample(["x", "y", None], r.randrange(1, 4))]


def write(spark, rows, path, n):
    df = spark.createDataFrame(rows, "provider string, id long, s double")
    df.select("provider", "id", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("ts")).coalesce(1).write.parquet(f"{path}/{n}")


def run(spark, path, check, rpm, capacity):
    """All that is there, then the query ends."""
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    rows = throttle.throttled(source, rpm, capacity, "provider", "id", late="40 seconds")
    q = rows.writeStream.format("parquet").option("path", check + "-out").option("checkpointLocation", check).outputMode("append").trigger(availableNow=True).start()
    try:
        q.awaitTermination(240)
    finally:
        q.stop()


def test_equals_batch_over_restarts(spark, tmp_path):
    rows = sorted(arrivals(), key=lambda x: x[2])
    parts = [rows[i : i + 40] for i in range(0, len(rows), 40)]
    for p in parts:  # out of order inside the allowed lateness
        random.Random(2).shuffle(p)
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    half = len(parts) // 2
    for n, p in enumerate(parts[:half]):
        write(spark, p, path, n)
    run(spark, path, check, 30, 3)
    first = spark.read.parquet(check + "-out").count()
    for n, p in enumerate(parts[half:], half):
        write(spark, p, path, n)
    write(spark, [("clock", 0, rows[-1][2] + 100_000)], path, "z")
    run(spark, path, check, 30, 3)
    write(spark, [("clock", 1, rows[-1][2] + 200_000)], path, "zz")
    run(spark, path, check, 30, 3)
    got = spark.read.parquet(check + "-out").filter("provider is null or provider <> 'clock'").collect()
    want = keys.token_bucket(spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path).withColumn("at_s", F.unix_micros("ts") / 1_000_000), 30, 3, "provider", "at_s", "id").collect()
    want = {(r.provider, r.id): (r.start_s, r.wait_s) for r in want if r.provider != "clock"}
    assert 0 < first < len(got) == len(want) == len(rows)
    assert {(r.provider, r.id): (r.start_s, r.wait_s) for r in got} == want
    assert any(w > 1 for _, w in want.values())


def test_by_the_clock(spark, tmp_path):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    write(spark, [("x", i, 1.0) for i in range(5)], path, 0)
    source = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    rows = throttle.throttled(source, 60, 2, "provider", "id", by_event=False)
    q = rows.writeStream.format("memory").queryName("clocked").option("checkpointLocation", check).outputMode("append").trigger(processingTime="300 milliseconds").start()
    try:
        until = time.time() + 90
        while time.time() < until and spark.table("clocked").count() < 5:
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.table("clocked").orderBy("id").collect()
    assert [round(r.wait_s) for r in got] == [0, 0, 1, 2, 3]


class Kept:
    """A state in memory that counts the rows it is sent."""

    sent = 0

    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows if self.many else self.rows[0]

    def clear(self):
        self.rows = []

    def put(self, rows):
        self.rows = list(rows)
        Kept.sent += len(rows)

    def update(self, row):
        self.put([row])

    def appendList(self, rows):
        self.rows += rows
        Kept.sent += len(rows)

    def appendValue(self, row):
        self.appendList([row])


class Handle:
    def __init__(self):
        self.timers = set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def state(self, name, schema, many):
        made = Kept()
        made.many = many
        return made

    def getValueState(self, name, schema):
        return self.state(name, schema, False)

    def getListState(self, name, schema):
        return self.state(name, schema, True)


class Clock:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_a_batch_and_a_queue_are_a_state_row_each():
    """500 requests in two batches at a bucket of one that gains one a second: a few rows of state, not one or more a request."""
    handle, bucket, before = Handle(), throttle.Bucket(60, 1, "k", "id", "long", True), Kept.sent
    bucket.init(handle)
    for ids in (range(250), range(250, 500)):
        list(bucket.handleInputRows(("x",), iter([pd.DataFrame({"at_s_": [10.0] * 250, "id": list(ids)})]), None))
    out = [f for ms in (10_000, 100_000, 1_000_000) for f in bucket.handleExpiredTimer(("x",), Clock(ms), None)]
    assert [tuple(r) for f in out for r in f[["id", "start_s"]].itertuples(index=False)] == [(i, 10.0 + i) for i in range(500)]
    assert Kept.sent - before < 20 and not bucket.waiting.exists() and not bucket.arrived.exists()
