"""The live dashboard against the batch one at each trigger."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from reelspan.operators import metrics
from reelspan.streaming import dashboard

SCHEMA = "gateway string, ts timestamp, kind string, request_id string, model string, has_images boolean, success boolean, error_type string"


def traffic(seed=1, n=400):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        g, a = r.choice("xy"), 1_700_000_000_000_000 + i * 900_000 + r.randrange(800_000)
        ok = r.random() < 0.8
        rows.append((g, a, "start", f"r{i}", r.choice(["m1", "m2", None]), r.random() < 0.3, None, None))
        if r.random() < 0.9:
            rows.append((g, a + r.randrange(1, 90_000_000), "end", f"r{i}", None, None, ok, None if ok else r.choice(["quota", "timeout", ""])))
    rows += [("x", 1_700_000_000_500_000, "end", "nobody", None, None, True, None), ("x", None, "start", "z", None, None, None, None), ("y", 1_700_000_001_000_000, "start", None, None, None, None, None), (None, 1_700_000_001_000_000, "start", "q", None, None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "gateway string, us long, kind string, request_id string, model string, has_images boolean, success boolean, error_type string").select("gateway", F.timestamp_micros("us").alias("ts"), "kind", "request_id", "model", "has_images", "success", "error_type")


def near(a, b, at=""):
    if isinstance(a, dict):
        assert set(a) == set(b), at
        for k in a:
            near(a[k], b[k], f"{at}.{k}")
    elif isinstance(a, list):
        assert len(a) == len(b), at
        for i, (x, y) in enumerate(zip(a, b)):
            near(x, y, f"{at}[{i}]")
    else:
        assert a == (pytest.approx(b) if isinstance(b, float) else b), at


def test_equals_batch_at_each_trigger(spark, tmp_path):
    rows = sorted(traffic(), key=lambda e: (e[1] or 0, e[2] == "start", e[3] or ""))
    parts = [rows[:1], rows[1:200], rows[200:260], rows[260:]]
    source = str(tmp_path / "in")
    seen = []
    for n, p in enumerate(parts):
        frame(spark, p).coalesce(1).write.mode("append").parquet(source)
        out = str(tmp_path / "out")
        q = dashboard.snapshots(spark.readStream.schema(SCHEMA).parquet(source)).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
        q.stop()
        if n == 0:  # a single odd row
            continue
        want = {r.gateway: json.loads(r.j) for r in metrics.dashboard(spark.read.schema(SCHEMA).parquet(source), block_s=60).select("gateway", F.to_json(F.struct("stats", "active_requests", "recent_performance", "error_breakdown", "model_usage", "timestamp")).alias("j")).collect()}
        got = {}
        for r in spark.read.parquet(out).orderBy("at_us").collect():
            got[r.gateway] = json.loads(r.snapshot)
        assert set(got) == set(want) == {"x", "y"}
        for g in got:
            near(got[g], want[g], g)
        seen.append(got)
    assert len(seen[-1]["x"]["recent_performance"]) == 50 and seen[-1]["x"]["error_breakdown"] and seen[-1]["x"]["stats"]["active_count"] > 3


def test_last_rows_are_limited_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = metrics.latest(rows, ["k"], [F.desc("id")], 50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below[0] and "WindowGroupLimit" in below[1]
    assert out.groupBy("k").count().select("count").distinct().collect()[0][0] == 50
