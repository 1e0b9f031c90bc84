"""The live dashboard: one bounded state a gateway, a snapshot whenever its events come."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from reelspan.streaming.throttle import use_rocksdb

#: Response times that the mean takes in, rows that a snapshot shows, minutes that the rate takes in.
TIMES, SHOWN, MINUTES = 100, 50, 5


class Dashboard(StatefulProcessor):
    """State: totals; requests under way, errors and models by name; the last TIMES response times, the last SHOWN rows, the last minutes' counts."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "since_us long, total long, ok long, multimodal long, peak long, active long")
        self.active = handle.getMapState("active", "id string", "start_us long, model string, has_images boolean")
        self.errors = handle.getMapState("errors", "kind string", "n long")
        self.usage = handle.getMapState("usage", "model string", "n long")
        self.times = handle.getListState("times", "us long")
        self.rows = handle.getListState("rows", "at_us long, us long, success boolean, has_images boolean")
        self.minutes = handle.getMapState("minutes", "minute long", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = sorted((tuple(r) for f in rows for r in f[["at_us", "rank", "request_id", "model", "has_images", "success", "error_type"]].itertuples(index=False)), key=lambda e: e[:3])
        since, total, ok, multimodal, peak, active = self.totals.get() if self.totals.exists() else (events[0][0], 0, 0, 0, 0, 0)
        times = deque((x[0] for x in self.times.get()), TIMES)
        shown = deque((tuple(x) for x in self.rows.get()), SHOWN)
        counts = {"errors": {}, "usage": {}, "minutes": {}}
        now = events[-1][0]
        for at, start, request, model, images, success, error in events:
            if start:
                if not self.active.containsKey((request,)):
                    active += 1
                self.active.updateValue((request,), (at, model, bool(images)))
                peak = max(peak, active)
                counts["usage"][model] = counts["usage"].get(model, 0) + 1
                multimodal += bool(images)
            elif self.active.containsKey((request,)):
                begun, _, had_images = self.active.getValue((request,))
                self.active.removeKey((request,))
                active -= 1
                total, ok = total + 1, ok + bool(success)
                if isinstance(error, str) and error:
                    counts["errors"][error] = counts["errors"].get(error, 0) + 1
                times.append(at - begun)
                shown.append((at, at - begun, bool(success), had_images))
                minute = at // 60_000_000
                counts["minutes"][minute] = counts["minutes"].get(minute, 0) + 1
        for name, own in counts.items():
            state = getattr(self, name)
            for k, n in own.items():
                state.updateValue((k,), ((state.getValue((k,))[0] if state.containsKey((k,)) else 0) + n,))
        self.totals.update((since, total, ok, multimodal, peak, active))
        for state, kept in ((self.times, [(x,) for x in times]), (self.rows, list(shown))):
            if kept:
                state.put(kept)
        recent = range(now // 60_000_000 - MINUTES + 1, now // 60_000_000 + 1)
        for (minute,) in [k for k in self.minutes.keys() if k[0] < recent[0]]:
            self.minutes.removeKey((minute,))
        per_minute = sum(n for (m,), (n,) in self.minutes.iterator() if m in recent) / MINUTES
        made = snapshot(
            now, since, total, ok, multimodal, peak, list(times), list(shown), per_minute,
            {k[0]: v for k, v in self.active.iterator()}, {k[0]: v[0] for k, v in self.errors.iterator()}, {k[0]: v[0] for k, v in self.usage.iterator()},
        )
        yield pd.DataFrame({self.key: [key[0]], "at_us": [now], "snapshot": [json.dumps(made, sort_keys=True)]})

    def close(self) -> None:
        pass


def snapshot(now, since, total, ok, multimodal, peak, times, shown, per_minute, active, errors, usage) -> dict:
    """Field names are fixed: they are what a dashboard reads."""
    n = max(total, 1)
    return {
        "stats": {
            "total_requests": total, "successful_requests": ok, "failed_requests": total - ok, "multimodal_requests": multimodal, "active_count": len(active), "peak_concurrent": peak, "current_load": 0.0,
            "avg_response_time": sum(times) / 1e6 / len(times) if times else 0.0, "requests_per_minute": per_minute, "uptime": since / 1e6, "uptime_formatted": str(timedelta(seconds=(now - since) // 1_000_000)),
            "success_rate": ok / n * 100, "error_rate": (total - ok) / n * 100, "multimodal_percentage": multimodal / n * 100,
        },
        "active_requests": [{"id": i, "start_time": s / 1e6, "duration": (now - s) / 1e6, "model": m, "has_images": h} for i, (s, m, h) in sorted(active.items())],
        "recent_performance": [{"timestamp": at / 1e3, "response_time": us / 1e3, "success": s, "has_images": h} for at, us, s, h in shown],
        "error_breakdown": errors, "model_usage": usage, "timestamp": now / 1e3,
    }


def snapshots(events: DataFrame, key: str = "gateway", at: str = "ts") -> DataFrame:
    """(key, at_us, snapshot): a JSON snapshot of a gateway each time a trigger brings events of it.

    events(key, at, kind, request_id, model, has_images, success, error_type), kind `start` or `end`.  A trigger's events are taken in order
    of (at, ends before starts, request_id); an end without a start is ignored, and so is an event without a gateway, a time or an id.  The clock is the last event's.  A gateway's state is
    bounded but for its requests under way and its names of models and errors.
    """
    use_rocksdb(events.sparkSession)
    kind = events.schema[key].dataType.simpleString()
    rows = events.filter(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col("request_id").isNotNull()).select(
        key, F.unix_micros(at).alias("at_us"), (F.col("kind") == "start").cast("int").alias("rank"), F.col("request_id").cast("string").alias("request_id"), F.coalesce(F.col("model").cast("string"), F.lit("")).alias("model"),
        F.coalesce("has_images", F.lit(False)).alias("has_images"), F.coalesce("success", F.lit(False)).alias("success"), "error_type",
    )
    return rows.groupBy(key).transformWithStateInPandas(Dashboard(key), f"{key} {kind}, at_us long, snapshot string", "append", "none")
