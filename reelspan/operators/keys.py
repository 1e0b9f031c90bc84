"""Key sheets, and the key pool and token bucket as folds over ordered events (batch) or keyed state (streams)."""

from __future__ import annotations

from collections.abc import Iterator, MutableMapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RETIRED_S, PENALTY_S, PENALTY_AT, RESET_S = 90.0, 600.0, 5, 1800.0


def clean_sheet(sheet: DataFrame, at: str = "pos") -> DataFrame:
    """(token, name, pos): header names trimmed, rows without token or name dropped, the first row of a token kept."""
    sheet = sheet.toDF(*[c.strip() for c in sheet.columns])
    rows = sheet.select(F.col("Token").alias("token"), F.col("Name").alias("name"), at).dropna(subset=["token", "name"])
    w = Window.partitionBy("token").orderBy(at)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def unseen(sheet: DataFrame, known: DataFrame) -> DataFrame:
    """Keys of a reloaded sheet that are neither known nor removed."""
    return sheet.join(known.select("token"), "token", "left_anti")


class Key(NamedTuple):
    """A key's state; place is its turn of loading."""

    place: int
    state: str = "active"
    used: float | None = None
    failures: int = 0
    until: float = 0.0


KEY_STATE = "place int, state string, used double, failures int, until double"


class Pool:
    """The rules of one provider's keys over a map from token to Key: a dict, or the keyed state of a stream.

    load, select, release, retire, remove, success, reset events move keys between active, in use, cooling,
    retired and removed.  Time is the events' own, so a replay gives the same states.  A retired key keeps its
    failures until a success; a removed key never comes back; a reset leaves keys in use alone.
    """

    def __init__(self, rpm: float, keys: MutableMapping[str, Key] | None = None, turn: int = -1, loaded: int = 0):
        self.cooldown, self.keys, self.turn, self.loaded = 60.0 / rpm, {} if keys is None else keys, turn, loaded

    def _free(self, now: float) -> list[str]:
        free = []
        for token, k in list(self.keys.items()):
            if k.state == "retired" and now >= k.until:
                k = self.keys[token] = k._replace(state="active")
            if k.state == "active" and (k.used is None or now - k.used > self.cooldown):
                free.append((k.place, token))
        return [token for _, token in sorted(free)]

    def apply(self, now: float, event: str, token: str | None) -> tuple[str | None, str]:
        """(token, outcome) of one event."""
        if event == "load":
            if token in self.keys:
                return token, "known"
            self.keys[token] = Key(self.loaded)
            self.loaded += 1
            return token, "active"
        if event == "reset":
            for t, k in list(self.keys.items()):
                if k.state in ("retired", "active"):
                    self.keys[t] = k._replace(state="active", used=None, failures=0)
            return None, "reset"
        if event == "select":
            free = self._free(now)
            if not free:
                return None, "none free" if self.loaded else "no keys"
            self.turn = (self.turn + 1) % len(free)
            chosen = free[self.turn]
            self.keys[chosen] = self.keys[chosen]._replace(state="in_use")
            return chosen, "in_use"
        if token is None or token not in self.keys or (k := self.keys[token]).state == "removed":
            return token, "ignored"
        if event == "release" and k.state == "in_use":
            self.keys[token] = k._replace(state="active", used=now)
            return token, "cooling"
        if event == "success":
            self.keys[token] = k._replace(failures=0)
            return token, k.state
        if event == "retire":
            failures = k.failures + 1
            self.keys[token] = k._replace(state="retired", failures=failures, until=now + (PENALTY_S if failures >= PENALTY_AT else RETIRED_S))
            return token, "retired"
        if event == "remove":
            self.keys[token] = k._replace(state="removed")
            return token, "removed"
        return token, "ignored"


OUTCOMES = "provider string, at_s double, event string, token string, outcome string"


def replay(events: DataFrame, rpm: float) -> DataFrame:
    """Outcome of every key event (provider, at_s, seq, event, token), in order of at_s and seq; a provider's pool is one state machine.

    A task reads its providers' events in order, batch by batch, and holds one pool: no provider's log is in memory.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool, provider = Pool(rpm), None
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                if r.provider != provider:
                    pool, provider = Pool(rpm), r.provider
                token, outcome = pool.apply(r.at_s, r.event, r.token)
                rows.append((r.provider, r.at_s, r.event, token, outcome))
            yield pd.DataFrame(rows, columns=["provider", "at_s", "event", "token", "outcome"])

    dealt = events.filter("provider is not null").repartition("provider").sortWithinPartitions("provider", "at_s", "seq")
    return dealt.select("provider", "at_s", "seq", "event", "token").mapInPandas(run, OUTCOMES)


def token_bucket(requests: DataFrame, rpm: float, capacity: int, key: str, at: str, order: str) -> DataFrame:
    """(key, order, at, start_s, wait_s): first-come first-served waits at a bucket that starts full and gains rpm / 60 a second.

    A request that finds no token waits for the next one, behind those that wait already; `at` is in seconds.
    With T = 60 / rpm and arrivals a, the bucket is owed up to max over k < n of (a_k + (n - k) T) when the
    n-th request comes; that request starts then, less capacity - 1 tokens of credit, or at once.  The
    maximum is a running window, so no fold is needed.
    """
    step = 60.0 / rpm
    w = Window.partitionBy(key).orderBy(at, order)
    rows = requests.select(key, order, at, F.col(at).alias("a")).withColumn("n", F.row_number().over(w))
    # theoretical arrival time: max over earlier k of a_k + (n - k + 1) T; a request waits for that less the credit
    rows = rows.withColumn("m", F.max(F.col("a") - F.col("n") * step).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    due = F.coalesce(F.greatest(F.col("a"), F.col("m") + F.col("n") * step - (capacity - 1) * step), F.col("a"))
    return rows.select(key, order, at, due.alias("start_s"), (due - F.col("a")).alias("wait_s"))


class _Held(MutableMapping):
    """A stream's map state as a map from token to Key: each key is read and written by itself."""

    def __init__(self, state):
        self.state = state

    def __contains__(self, token) -> bool:
        return self.state.containsKey((token,))

    def __getitem__(self, token) -> Key:
        return Key(*self.state.getValue((token,)))

    def __setitem__(self, token, key: Key) -> None:
        self.state.updateValue((token,), tuple(key))

    def __delitem__(self, token) -> None:
        self.state.removeKey((token,))

    def __iter__(self):
        return iter([k[0] for k in self.state.keys()])

    def __len__(self) -> int:
        return sum(1 for _ in self.state.keys())

    def items(self):
        return [(k[0], Key(*v)) for k, v in self.state.iterator()]


class PoolState(StatefulProcessor):
    """A provider's pool in keyed state: a row a key, the turn and the number of keys loaded."""

    def __init__(self, rpm: float):
        self.rpm = rpm

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("keys", "token string", KEY_STATE)
        self.turn = handle.getValueState("turn", "turn int, loaded int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pool = Pool(self.rpm, _Held(self.held), *(self.turn.get() if self.turn.exists() else ()))
        events = sorted((e for f in rows for e in zip(f["at_s"].tolist(), f["seq"].tolist(), f["event"].tolist(), f["token"].tolist())), key=lambda e: e[:2])
        out = [(key[0], at, event, *pool.apply(at, event, token if isinstance(token, str) else None)) for at, _, event, token in events]
        self.turn.update((pool.turn, pool.loaded))
        yield pd.DataFrame(out, columns=["provider", "at_s", "event", "token", "outcome"])

    def close(self) -> None:
        pass


def pool_stream(events: DataFrame, rpm: float) -> DataFrame:
    """The same pool over a stream of key events (provider, at_s, seq, event, token); a trigger's events are taken in order of at_s and seq."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = events.filter("provider is not null").select("provider", "at_s", "seq", "event", "token")
    return rows.groupBy("provider").transformWithStateInPandas(PoolState(rpm), OUTCOMES, "append", "none")
