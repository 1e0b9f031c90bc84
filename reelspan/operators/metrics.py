"""Request metrics: counters, rates, concurrency, rolling and per-minute figures.  Times are seconds since 1970."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reelspan.functions.text import uptime
from reelspan.operators import scan


def correlate(starts: DataFrame, ends: DataFrame, on: str = "request_id") -> DataFrame:
    """Requests with both a start and an end; an end without a start is ignored."""
    return starts.join(ends, on, "inner").withColumn("took_s", F.col("end_s") - F.col("start_s"))


def counters(requests: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and rates in percent; the rates of no request are 0."""
    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    return requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.count_if("has_images").alias("multimodal"),
        F.round(F.count_if("success") * 100.0 / n, 6).alias("success_rate"), F.round(F.count_if(~F.col("success")) * 100.0 / n, 6).alias("error_rate"), F.round(F.count_if("has_images") * 100.0 / n, 6).alias("multimodal_rate"),
    )


def started(starts: DataFrame, keys: list[str]) -> DataFrame:
    """Requests begun and those with images, counted at their start, ended or not."""
    return starts.groupBy(*keys).agg(F.count(F.lit(1)).alias("started"), F.count_if("has_images").alias("multimodal"))


def error_types(ends: DataFrame, keys: list[str]) -> DataFrame:
    """Ended requests by error type; those without one are not counted."""
    return ends.filter("error_type is not null").groupBy(*keys, "error_type").agg(F.count(F.lit(1)).alias("n"))


def peak_concurrency(requests: DataFrame, key: str, block_s: float = 3600) -> DataFrame:
    """Most requests of a key under way at once, sampled at starts; an end at the same moment comes first.  Scanned in blocks of block_s seconds."""
    events = requests.select(key, F.col("start_s").alias("t"), F.lit(1).alias("d")).unionByName(requests.select(key, F.col("end_s").alias("t"), F.lit(-1).alias("d")))
    return scan.peak_of_sum(events, [key], "t", F.col("d"), F.col("d") == 1, "peak", block_s, ["d"])


def rolling_mean(requests: DataFrame, key: str, order: list[str], value: str, last: int = 100, block: float = 3600) -> DataFrame:
    """Mean over a row and the up to last - 1 rows before it, within a key; the first of `order` is a number, scanned in blocks of `block`."""
    return scan.last_rows(requests, [key], order[0], F.avg(value), "rolling_mean", last, block, order[1:])


def per_minute(requests: DataFrame, at: str, minutes: int = 5, keys: list[str] | None = None) -> DataFrame:
    """(minute, n, rpm): requests of each minute that has any, and their mean over it and the minutes before, empty ones included.

    Minutes are aggregated first; the window over them is partitioned by day, each day taking in the
    last minutes of the day before, so no task holds the whole history.
    """
    keys = keys or []
    n = requests.groupBy(*keys, F.floor(F.col(at) / 60).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    day = F.floor(F.col("minute") / 1440)
    # the last minutes of a day also go to the next day, marked as guests
    last = F.pmod(F.col("minute"), F.lit(1440)) >= 1440 - (minutes - 1)
    spread = n.withColumn("day", F.explode(F.when(last, F.array(day, day + 1)).otherwise(F.array(day))))
    w = Window.partitionBy(*keys, "day").orderBy("minute").rangeBetween(-(minutes - 1), 0)
    return spread.withColumn("rpm", F.sum("n").over(w) / F.lit(float(minutes))).filter(F.col("day") == day).select(*keys, "minute", "n", "rpm")


def latest(requests: DataFrame, keys: list[str], order: list, most: int = 50) -> DataFrame:
    """The last `most` rows of each key, rank 1 the latest."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return requests.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def dashboard(events: DataFrame, key: str = "gateway", at: str = "ts", block_s: float = 3600) -> DataFrame:
    """A row a gateway as of its last event: the fields of `streaming.dashboard.snapshots`, over the whole history.

    Counters are aggregated before they are shuffled; the last 100 and 50 rows are ranked with a limit inside each task; the
    peak is scanned in blocks.  Events without a gateway, a time or an id are left out.  Requests under way and names of models and errors are gathered in one row, as a snapshot is.
    """
    rows = events.filter(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col("request_id").isNotNull()).withColumn("us", F.unix_micros(at))
    starts = rows.filter("kind = 'start'").select(key, "request_id", F.col("us").alias("start_us"), F.coalesce("model", F.lit("")).alias("model"), F.coalesce("has_images", F.lit(False)).alias("has_images"))
    ends = rows.filter("kind = 'end'").select(key, "request_id", F.col("us").alias("end_us"), F.coalesce("success", F.lit(False)).alias("success"), F.nullif("error_type", F.lit("")).alias("error_type"))
    # an end that is no later than its start comes before it and is ignored, as one without a start is
    both = starts.join(ends, [key, "request_id"], "left").withColumn("took_us", F.when(F.col("end_us") > F.col("start_us"), F.col("end_us") - F.col("start_us")))
    both = both.withColumns({c: F.when(F.col("took_us").isNotNull(), F.col(c)) for c in ("end_us", "success", "error_type")})
    done = both.filter("end_us is not null")
    clock = rows.groupBy(key).agg(F.max("us").alias("now"), F.min("us").alias("since"))
    counts = both.groupBy(key).agg(F.count("end_us").alias("total"), F.count_if("success").alias("ok"), F.count_if("has_images").alias("multimodal"), F.count_if(F.col("end_us").isNull()).alias("active_count"))
    moves = both.select(key, (F.col("start_us") / 1e6).alias("t"), F.lit(1).alias("d")).unionByName(done.select(key, (F.col("end_us") / 1e6).alias("t"), F.lit(-1).alias("d")))
    peak = scan.peak_of_sum(moves, [key], "t", F.col("d"), F.col("d") == 1, "peak", block_s, ["d"])
    last = latest(done, [key], [F.desc("end_us"), F.desc("request_id")], 100)
    recent = last.groupBy(key).agg(
        F.avg(F.col("took_us") / 1e6).alias("avg_s"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("rank") <= 50, F.struct((-F.col("rank")).alias("r"), (F.col("end_us") / 1e3).alias("timestamp"), (F.col("took_us") / 1e3).alias("response_time"), "success", "has_images")))), lambda x: x.dropFields("r")).alias("recent_performance"),
    )
    by_minute = done.groupBy(key, F.floor(F.col("end_us") / 60_000_000).alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    rate = by_minute.join(clock, key).filter(F.col("minute") > F.floor(F.col("now") / 60_000_000) - 5).groupBy(key).agg((F.sum("n") / 5.0).alias("rpm"))
    named = lambda rows, name, made: rows.groupBy(key, F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "n")))).alias(made))
    errors, usage = named(done.filter("error_type is not null"), "error_type", "error_breakdown"), named(starts, "model", "model_usage")
    busy = both.filter("end_us is null").join(clock, key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("request_id").alias("id"), (F.col("start_us") / 1e6).alias("start_time"), ((F.col("now") - F.col("start_us")) / 1e6).alias("duration"), "model", "has_images"))).alias("active_requests"))
    out = clock
    for part in (counts, peak, recent, rate, errors, usage, busy):
        out = out.join(part, key, "left")
    n = F.greatest(F.col("total"), F.lit(1))
    up = F.floor((F.col("now") - F.col("since")) / 1_000_000)
    zero = lambda c, kind="long": F.coalesce(c, F.lit(0).cast(kind))
    stats = F.struct(
        zero("total").alias("total_requests"), zero("ok").alias("successful_requests"), zero(F.col("total") - F.col("ok")).alias("failed_requests"), zero("multimodal").alias("multimodal_requests"), zero("active_count").alias("active_count"), zero("peak").alias("peak_concurrent"), F.lit(0.0).alias("current_load"),
        zero("avg_s", "double").alias("avg_response_time"), zero("rpm", "double").alias("requests_per_minute"), (F.col("since") / 1e6).alias("uptime"), uptime(up).alias("uptime_formatted"),
        zero(F.col("ok") / n * 100, "double").alias("success_rate"), zero((F.col("total") - F.col("ok")) / n * 100, "double").alias("error_rate"), zero(F.col("multimodal") / n * 100, "double").alias("multimodal_percentage"),
    )
    none = lambda c, like: F.coalesce(c, F.expr(like))
    return out.select(key, stats.alias("stats"), none(F.col("active_requests"), "array()").alias("active_requests"), none(F.col("recent_performance"), "array()").alias("recent_performance"), none(F.col("error_breakdown"), "map()").alias("error_breakdown"), none(F.col("model_usage"), "map()").alias("model_usage"), (F.col("now") / 1e3).alias("timestamp"))


def health(keys: DataFrame, providers: tuple[str, ...] = ("mistral", "gemini")) -> DataFrame:
    """One row: status, the number of active keys of each provider, vision_support."""
    active = [F.count_if((F.col("provider") == p) & (F.col("state") == "active")).alias(f"{p}_keys_in_pool") for p in providers]
    return keys.agg(*active).select(F.lit("healthy").alias("status"), "*", F.lit(True).alias("vision_support"))


@F.pandas_udf(StringType())
def status_text(total: pd.Series, success_rate: pd.Series, active: pd.Series, mistral_keys: pd.Series, gemini_keys: pd.Series, response_s: pd.Series, rpm: pd.Series, up: pd.Series) -> pd.Series:
    """The lines of a status report; keys that are not known are N/A."""
    known = lambda n: "N/A" if pd.isna(n) else int(n)
    return pd.Series(
        [
            f"Total Requests: {n:,}\nSuccess Rate: {ok:.1f}%\nActive Requests: {busy}\nActive Keys - Mistral: {known(m)} | Gemini: {known(g)}\nAvg Response: {s * 1000:.0f} ms\nThroughput: {r:.1f} req/min\nUptime: {u}"
            for n, ok, busy, m, g, s, r, u in zip(total, success_rate, active, mistral_keys, gemini_keys, response_s, rpm, up)
        ]
    )
