"""The token bucket as a stateful stream: requests are released in order, as tokens come, by timers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def use_rocksdb(spark: SparkSession) -> None:
    """State with timers needs a store that keeps several columns; set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _columns(rows: list[tuple]) -> tuple:
    return tuple(map(list, zip(*rows)))


class Bucket(StatefulProcessor):
    """One key's bucket, full at first, which gains rpm / 60 tokens a second up to its capacity.

    State: how many requests have been taken and the greatest of a_k - k T (see `keys.token_bucket`), the requests that have
    arrived but are not yet due, and those that wait for a token, each with its start.  One timer a key, at the next
    arrival or start that the clock has not passed; all that is due by then is settled at once.
    """

    def __init__(self, rpm: float, capacity: int, key: str, order: str, order_kind: str, by_event: bool):
        self.step, self.credit, self.names = 60.0 / rpm, (capacity - 1) * (60.0 / rpm), [key, order, "at_s", "start_s", "wait_s"]
        self.order_kind, self.by_event = order_kind, by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.taken = handle.getValueState("taken", "n long, most double")
        self.alarm = handle.getValueState("alarm", "ms long")
        # a row a batch of arrivals, and one for the queue: each row of a state is a message of its own between Spark and Python
        self.arrived = handle.getListState("arrived", f"at_s array<double>, id array<{self.order_kind}>")
        self.waiting = handle.getValueState("waiting", f"at_s array<double>, id array<{self.order_kind}>, start_s array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [x for frame in rows for x in zip(frame["at_s_"].tolist(), frame[self.names[1]].tolist())]
        if self.by_event:  # others may come before them
            self.arrived.appendValue(_columns(came))
            self._wake(math.ceil(min(at for at, _ in came) * 1000))
            return iter(())
        now = timerValues.getCurrentProcessingTimeInMs()
        return self._settled(key, [(now / 1000, i) for _, i in sorted(came)], now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        now = timerValues.getCurrentWatermarkInMs() if self.by_event else timerValues.getCurrentProcessingTimeInMs()
        here = [x for chunk in self.arrived.get() for x in zip(*chunk)] if self.by_event else []
        due, later = sorted(x for x in here if x[0] * 1000 <= now), [x for x in here if x[0] * 1000 > now]
        if due and later:
            self.arrived.put([_columns(later)])
        elif due:
            self.arrived.clear()
        return self._settled(key, due, now, later)

    def _settled(self, key, due: list[tuple], now: int, later: list[tuple] = ()) -> Iterator[pd.DataFrame]:
        """Gives starts to what is due, releases what may start by now, and sets the alarm for what is left and what comes later."""
        n, most = self.taken.get() if self.taken.exists() else (0, -math.inf)
        held = self.waiting.exists()
        queue = list(zip(*self.waiting.get())) if held else []
        for at, i in due:
            n += 1
            start = max(at, most + n * self.step - self.credit)
            most = max(most, at - n * self.step)
            queue.append((at, i, start))
        if due:
            self.taken.update((n, most))
        free = [x for x in queue if x[2] * 1000 <= now]
        left = queue[len(free) :]  # starts never fall along the queue
        if left:
            self.waiting.update(_columns(left))
        elif held:
            self.waiting.clear()
        if times := [x[2] for x in left[:1]] + [x[0] for x in later]:
            self._wake(math.ceil(min(times) * 1000))
        if free:
            yield pd.DataFrame([(key[0], i, at, start, start - at) for at, i, start in free], columns=self.names)

    def _wake(self, ms: int) -> None:
        """The key's only timer, moved forward if it was set for later."""
        if self.alarm.exists():
            (was,) = self.alarm.get()
            if was <= ms:
                return
            self.handle.deleteTimer(was)
        self.alarm.update((ms,))
        self.handle.registerTimer(ms)

    def close(self) -> None:
        pass


def throttled(requests: DataFrame, rpm: float, capacity: int, key: str, order: str, at: str = "ts", late: str = "10 minutes", by_event: bool = True) -> DataFrame:
    """(key, order, at_s, start_s, wait_s) of a stream of requests, each released once it may start.

    By event time, requests are taken in order of (at, order) whatever the order in which they come, up to `late`, and the
    rows equal those of `keys.token_bucket`; a request is released when the watermark passes its start.  Otherwise arrivals are
    taken as they come and timers follow the clock.  A bucket's queue is in one task: keys are the unit of scale, and a
    queue is as long as the backlog of its key.
    """
    use_rocksdb(requests.sparkSession)
    kind = requests.schema[key].dataType.simpleString()
    order_kind = requests.schema[order].dataType.simpleString()
    rows = requests.withColumn("at_s_", F.unix_micros(at) / 1_000_000)
    rows = (rows.withWatermark(at, late) if by_event else rows).select(key, order, at, "at_s_")
    out = f"{key} {kind}, {order} {order_kind}, at_s double, start_s double, wait_s double"
    return rows.groupBy(key).transformWithStateInPandas(Bucket(rpm, capacity, key, order, order_kind, by_event), out, "append", "eventTime" if by_event else "processingTime")
