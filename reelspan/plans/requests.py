"""Queries over requests, keys and chat messages."""

from __future__ import annotations

import json
import mimetypes

from pyspark.sql import functions as F

from reelspan.functions import text as T
from reelspan.operators import keys, messages, metrics
from reelspan.plans.proxies import epoch_micros, requests, table
from reelspan.plans.registry import query
from reelspan.session import new_folder
from reelspan.streaming import throttle

REQ = "rq as (select event_id::varchar request_id, user_id model, ts start_ts, ts + to_microseconds(floor(value * 60000000)::bigint) end_ts, event_type <> 'error' success, event_type = 'view' has_images, value response_s, event_id from events)"


@query(f"with {REQ} select model, count(*) total, count(*) filter (success) succeeded, count(*) filter (not success) failed, count(*) filter (has_images) multimodal, round(count(*) filter (success) * 100.0::double / count(*), 6) success_rate, round(count(*) filter (not success) * 100.0::double / count(*), 6) error_rate, round(count(*) filter (has_images) * 100.0::double / count(*), 6) multimodal_rate from rq group by 1")
def request_counters(spark, sf_dir):
    return metrics.counters(requests(spark, sf_dir), ["model"])


@query(f"with {REQ}, e as (select model, start_ts t, 1 d from rq union all select model, end_ts, -1 from rq), a as (select *, sum(d) over (partition by model order by t, d rows unbounded preceding) n from e) select model, max(n)::bigint peak from a where d = 1 group by 1")
def peak_concurrency(spark, sf_dir):
    return metrics.peak_concurrency(requests(spark, sf_dir), "model")


@query(f"with {REQ} select model, event_id, avg(round(response_s * 100)::bigint) over (partition by model order by start_ts, event_id rows between 99 preceding and current row) rolling_mean from rq")
def rolling_response(spark, sf_dir):
    """Mean of the last 100 response times of a model, in hundredths: sums of integers are the same in any order."""
    r = requests(spark, sf_dir).withColumn("hundredths", F.round(F.col("response_s") * 100).cast("long"))
    return metrics.rolling_mean(r, "model", ["start_s", "event_id"], "hundredths").select("model", "event_id", "rolling_mean")


@query("with m as (select floor(epoch_us(ts) / 60000000.0)::bigint as minute, count(*) n from events group by 1) select minute, n, sum(n) over (order by minute range between 4 preceding and current row) / 5.0::double rpm from m")
def requests_per_minute(spark, sf_dir):
    return metrics.per_minute(requests(spark, sf_dir), "start_s")


@query(f"with {REQ}, r as (select model, event_id, round(response_s * 1000, 3) ms, row_number() over (partition by model order by start_ts desc, event_id desc)::int rank from rq) select * from r where rank <= 50")
def latest_requests(spark, sf_dir):
    out = metrics.latest(requests(spark, sf_dir), ["model"], [F.desc("start_s"), F.desc("event_id")])
    return out.select("model", "event_id", F.round(F.col("response_s") * 1000, 3).alias("ms"), "rank")


@query(f"with {REQ} select model, count(*) n, round(sum(floor(response_s * 60000000) / 60000000), 2) total_minutes from rq where event_id in (select event_id from events where event_type <> 'signup') group by 1")
def correlated_requests(spark, sf_dir):
    """Starts of all requests but the sign-ups, whose ends are ignored."""
    r = requests(spark, sf_dir)
    starts = r.join(table(spark, sf_dir, "events").filter("event_type <> 'signup'").select("event_id"), "event_id", "left_semi").drop("end_s")
    both = metrics.correlate(starts, r.select("request_id", "end_s"))
    return both.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("took_s") / 60, 2).alias("total_minutes"))


@query(f"with {REQ} select model, count(*) started, count(*) filter (has_images) multimodal from rq group by 1")
def model_usage(spark, sf_dir):
    return metrics.started(requests(spark, sf_dir), ["model"])


@query("select user_id model, 'over ' || floor(value / 50)::int * 50 error_type, count(*) n from events where event_type = 'error' group by 1, 2")
def error_types(spark, sf_dir):
    """Errors by the fifties of their value."""
    kind = F.when(F.col("event_type") == "error", F.concat(F.lit("over "), (F.floor(F.col("value") / 50) * 50).cast("string")))
    return metrics.error_types(table(spark, sf_dir, "events").select(F.col("user_id").alias("model"), kind.alias("error_type")), ["model"])


@query("select time_bucket(interval '1 minute', ts) as minute, event_type, count(*) n from events group by 1, 2")
def tumbling_minutes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "1 minute").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("minute"), "event_type", "n")


@query("with w as (select time_bucket(interval '1 minute', ts) + to_minutes(unnest(range(1, 6))::int) as until from events) select until, count(*) / 5.0::double rpm from w group by 1")
def hopping_minutes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "5 minutes", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.end").alias("until"), (F.col("n") / F.lit(5.0)).alias("rpm"))


@query("with k as (select user_id token, count(*) n from events group by 1) select 'healthy' status, count(*) filter (token % 2 = 0 and n % 4 = 0) mistral_keys_in_pool, count(*) filter (token % 2 = 1 and n % 4 = 0) gemini_keys_in_pool, true vision_support from k")
def pool_health(spark, sf_dir):
    k = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    state = F.element_at(F.array(*[F.lit(s) for s in ("active", "in_use", "cooling", "retired")]), (F.col("n") % 4 + 1).cast("int"))
    return metrics.health(k.select(F.when(F.col("user_id") % 2 == 0, "mistral").otherwise("gemini").alias("provider"), F.col("user_id").alias("token"), state.alias("state")))


@query(f"""with {REQ}, l as (select model, min(start_ts) a, max(start_ts) b from rq group by 1),
c as (select model, count(*) total, count(*) filter (success) * 100.0::double / count(*) rate, count(*) filter (end_ts > b) active, count(*) filter (start_ts >= date_trunc('minute', b) - interval 4 minute) / 5.0::double rpm, (epoch_us(any_value(b)) - epoch_us(any_value(a))) // 1000000 up from rq join l using (model) group by 1),
o as (select model, round(response_s * 100)::bigint h, row_number() over (partition by model order by start_ts desc, event_id desc) k from rq),
h as (select model, avg(h) / 100 s from o where k <= 100 group by 1)
select model, format('Total Requests: {{:,}}', total) || printf(e'\nSuccess Rate: %.1f%%', rate) || e'\nActive Requests: ' || active || e'\nActive Keys - Mistral: N/A | Gemini: N/A' || printf(e'\nAvg Response: %.0f ms', s * 1000) || printf(e'\nThroughput: %.1f req/min', rpm) || e'\nUptime: ' || case up // 86400 when 0 then '' when 1 then '1 day, ' else (up // 86400) || ' days, ' end || (up % 86400 // 3600) || ':' || lpad((up % 3600 // 60)::varchar, 2, '0') || ':' || lpad((up % 60)::varchar, 2, '0') report from c join h using (model)""")
def status_report(spark, sf_dir):
    """A report a model as of its last request: requests still under way then, the mean of the last 100 responses, the last five minutes."""
    r = requests(spark, sf_dir).withColumn("hundredths", F.round(F.col("response_s") * 100).cast("long"))
    last = metrics.latest(r, ["model"], [F.desc("start_s"), F.desc("event_id")], 100).groupBy("model").agg((F.avg("hundredths") / 100).alias("response_s"))
    rpm = metrics.per_minute(r, "start_s", keys=["model"]).groupBy("model").agg(F.max_by("rpm", "minute").alias("rpm"))
    span = r.groupBy("model").agg(F.min("start_s").alias("a"), F.max("start_s").alias("b"))
    counts = r.join(span, "model").groupBy("model").agg(F.count(F.lit(1)).alias("total"), (F.count_if("success") * 100.0 / F.count(F.lit(1))).alias("rate"), F.count_if(F.col("end_s") > F.col("b")).alias("active"), F.first("a").alias("a"), F.first("b").alias("b"))
    micros = F.round((F.col("b") * 1_000_000).cast("decimal(20,3)") - (F.col("a") * 1_000_000).cast("decimal(20,3)")).cast("long")
    out = counts.join(last, "model").join(rpm, "model").withColumn("up", F.floor(micros / 1_000_000))
    none = F.lit(None).cast("long")
    return out.select("model", metrics.status_text("total", "rate", "active", none, none, "response_s", "rpm", T.uptime(F.col("up"))).alias("report"))


# ---------------------------------------------------------------- keys

SHEET = "ks as (select nullif(c_name, case when c_custkey % 11 = 0 then c_name else '' end) as \"Token\", case when c_custkey % 13 = 0 then null else c_mktsegment end as \"Name\", c_custkey pos from customer union all select c_name, c_mktsegment, c_custkey + 1000000000 from customer where c_nationkey < 5)"


def _sheet(spark, sf_dir):
    """Customers as a key sheet with stray spaces in the header, nulls and repeated tokens."""
    c = table(spark, sf_dir, "customer")
    i = F.col("c_custkey")
    a = c.select(F.when(i % 11 != 0, F.col("c_name")).alias(" Token"), F.when(i % 13 != 0, F.col("c_mktsegment")).alias("Name "), i.alias("pos"))
    return a.unionByName(c.filter("c_nationkey < 5").select(F.col("c_name").alias(" Token"), F.col("c_mktsegment").alias("Name "), (i + 1_000_000_000).alias("pos")))


@query(f'with {SHEET} select "Token" token, arg_min("Name", pos) name, min(pos) pos from ks where "Token" is not null and "Name" is not null group by 1')
def clean_key_sheet(spark, sf_dir):
    return keys.clean_sheet(_sheet(spark, sf_dir))


@query(f'with {SHEET}, k as (select "Token" token, min(pos) pos from ks where "Token" is not null and "Name" is not null group by 1) select token from k anti join (select c_name token from customer where c_acctbal > 0) using (token)')
def unseen_keys(spark, sf_dir):
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_name").alias("token"))
    return keys.unseen(keys.clean_sheet(_sheet(spark, sf_dir)), known).select("token")


@query("select c_custkey, left(c_name, 4) || '...' || right(c_name, 4) masked from customer")
def masked_tokens(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.mask_token(F.col("c_name")).alias("masked"))


@query("select 'segment:' || c_mktsegment name from customer union select 'nation:' || n_name from nation")
def model_names(spark, sf_dir):
    """Union of two sets of names."""
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("segment:"), "c_mktsegment").alias("name")).union(table(spark, sf_dir, "nation").select(F.concat(F.lit("nation:"), "n_name"))).distinct()


def _key_events(spark, sf_dir):
    """Events as a pool's log: sign-ups load, clicks select, views release, errors retire, purchases confirm; a user is a provider."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "signup", "load").when(F.col("event_type") == "click", "select").when(F.col("event_type") == "view", "release").when(F.col("event_type") == "error", "retire").otherwise("success")
    return e.select(F.col("user_id").cast("string").alias("provider"), (epoch_micros(F.col("ts")) / 1_000_000).alias("at_s"), F.col("event_id").alias("seq"), kind.alias("event"), F.when(kind != "select", F.concat(F.lit("k"), (F.col("event_id") % 5).cast("string"))).alias("token"))


@query()
def key_pool_replay(spark, sf_dir):
    """Outcome of each key event; the tests hold it against the rules case by case."""
    return keys.replay(_key_events(spark, sf_dir), 10)


BUCKET_SQL = """with recursive o as (select user_id, event_id, epoch_us(ts) / 1e6 a, row_number() over (partition by user_id order by ts, event_id) n from events),
r as (select user_id, event_id, n, a start_s, a + 3600.0 tat, 0.0::double wait from o where n = 1
      union all select o.user_id, o.event_id, o.n, greatest(o.a, r.tat - 3600.0), greatest(o.a, r.tat) + 3600.0, greatest(o.a, r.tat - 3600.0) - o.a from r join o on o.user_id = r.user_id and o.n = r.n + 1)
select user_id, event_id, round(wait, 2) wait_s from r"""


@query(BUCKET_SQL)
def token_bucket_waits(spark, sf_dir):
    """Waits at a bucket of two that gains one an hour."""
    out = keys.token_bucket(table(spark, sf_dir, "events").withColumn("at_s", epoch_micros(F.col("ts")) / 1_000_000), 60.0 / 3600.0, 2, "user_id", "at_s", "event_id")
    return out.select("user_id", "event_id", F.round("wait_s", 2).alias("wait_s"))


@query(BUCKET_SQL)
def throttled_stream(spark, sf_dir):
    """The same bucket over a stream: one run takes the requests, a later one from its checkpoint moves the clock and releases what waits."""
    folder = new_folder(spark, "throttle")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.timestamp_micros(epoch_micros(F.col("ts"))).alias("ts"))
    late = e.agg(F.lit(None).cast(e.schema["user_id"].dataType).alias("user_id"), F.lit(-1).cast(e.schema["event_id"].dataType).alias("event_id"), (F.max("ts") + F.expr("interval 1000 days")).alias("ts"))

    def run():
        source = spark.readStream.schema(e.schema).parquet(f"{folder}/in")
        rows = throttle.throttled(source, 60.0 / 3600.0, 2, "user_id", "event_id", late="1 second")
        q = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()

    for rows in (e, late):
        rows.write.mode("append").parquet(f"{folder}/in")
        run()
    return spark.read.parquet(f"{folder}/out").filter("event_id >= 0").select("user_id", "event_id", F.round("wait_s", 2).alias("wait_s"))


def gateway_events(spark, sf_dir):
    """Starts of all events as requests of four gateways, ends of nine in ten."""
    e = table(spark, sf_dir, "events")
    start = epoch_micros(F.col("ts"))
    r = e.select(
        (F.col("user_id") % 4).alias("gateway"), F.col("event_id").cast("string").alias("request_id"), F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string")).alias("model"), (F.col("event_type") == "view").alias("has_images"),
        (F.col("event_type") != "error").alias("success"), F.when(F.col("event_type") == "error", F.concat(F.lit("over "), (F.floor(F.col("value") / 50) * 50).cast("string"))).alias("error_type"), start.alias("a"), (start + F.floor(F.col("value") * 60_000_000)).alias("b"), "event_id",
    )
    shape = lambda rows, at, kind: rows.select("gateway", F.timestamp_micros(at).alias("ts"), F.lit(kind).alias("kind"), "request_id", "model", "has_images", "success", "error_type")
    return shape(r, "a", "start").unionByName(shape(r.filter("event_id % 10 <> 0"), "b", "end"))


@query("""with r as (select user_id % 4 gateway, event_id::varchar id, 'm' || (user_id % 7) model, event_type = 'view' img, event_type <> 'error' ok, case when event_type = 'error' then 'over ' || (floor(value / 50)::int * 50) end err, epoch_us(ts) a, epoch_us(ts) + floor(value * 60000000)::bigint b0, event_id from events),
q as (select *, case when event_id % 10 <> 0 and b0 > a then b0 end b from r),
c as (select gateway, greatest(max(a), max(case when event_id % 10 <> 0 then b0 end)) now, min(a) since from r group by 1),
n as (select gateway, count(b) total_requests, count(*) filter (ok and b is not null) successful_requests, count(*) filter (img) multimodal_requests, count(*) filter (b is null) active_count from q group by 1),
v as (select gateway, a t, 1 d from q union all select gateway, b, -1 from q where b is not null),
p as (select gateway, max(x)::bigint peak_concurrent from (select gateway, d, sum(d) over (partition by gateway order by t, d rows unbounded preceding) x from v) where d = 1 group by 1),
l as (select *, b - a took, row_number() over (partition by gateway order by b desc, id desc) k from q where b is not null),
t as (select gateway, round(avg(took / 1e6), 3) avg_response_time, string_agg((took // 1000)::varchar, ',' order by k desc) filter (k <= 50) recent from l where k <= 100 group by 1),
u as (select q.gateway, count(*) filter (b // 60000000 > now // 60000000 - 5) / 5.0::double requests_per_minute from q join c using (gateway) group by 1),
e as (select gateway, string_agg(err || '=' || n, ';' order by err) errors from (select gateway, err, count(*) n from q where err is not null and b is not null group by 1, 2) group by 1),
m as (select gateway, string_agg(model || '=' || n, ';' order by model) models from (select gateway, model, count(*) n from q group by 1, 2) group by 1),
s as (select gateway, string_agg(id, ';' order by id) busy from q where b is null group by 1)
select gateway, total_requests, successful_requests, multimodal_requests, active_count, peak_concurrent, avg_response_time, recent, requests_per_minute, errors, models, busy, round(successful_requests * 100.0::double / total_requests, 6) success_rate, now / 1000 "timestamp",
case when (now - since) // 1000000 >= 172800 then ((now - since) // 86400000000) || ' days, ' when (now - since) // 1000000 >= 86400 then '1 day, ' else '' end || ((now - since) // 1000000 % 86400 // 3600) || ':' || lpad(((now - since) // 1000000 % 3600 // 60)::varchar, 2, '0') || ':' || lpad(((now - since) // 1000000 % 60)::varchar, 2, '0') uptime_formatted
from n join c using (gateway) join p using (gateway) join t using (gateway) join u using (gateway) left join e using (gateway) join m using (gateway) left join s using (gateway)""")
def dashboard_snapshot(spark, sf_dir):
    """The dashboard of four gateways as of their last event, its lists as text."""
    d = metrics.dashboard(gateway_events(spark, sf_dir))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ";")
    s = F.col("stats")
    return d.select(
        "gateway", *[s[c].alias(c) for c in ("total_requests", "successful_requests", "multimodal_requests", "active_count", "peak_concurrent", "requests_per_minute", "uptime_formatted")],
        F.round(s["avg_response_time"], 3).alias("avg_response_time"), F.round(s["success_rate"], 6).alias("success_rate"), F.array_join(F.transform("recent_performance", lambda x: F.floor(x["response_time"] + 0.0001).cast("string")), ",").alias("recent"),
        text("error_breakdown").alias("errors"), text("model_usage").alias("models"), F.array_join(F.transform("active_requests", lambda x: x["id"]), ";").alias("busy"), "timestamp",
    )


# ---------------------------------------------------------------- messages

def _model():
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    return F.when(kind == "click", F.concat(F.lit("Gemini-"), user)).when(kind == "view", F.concat(F.lit("MISTRAL-"), user)).when(kind == "signup", F.concat(F.lit("pixtral-"), user)).when(kind == "purchase", "GPT-4o").otherwise(F.concat(F.lit("gpt-"), user))


@query("with m as (select event_id, lower(case event_type when 'click' then 'Gemini-' || user_id when 'view' then 'MISTRAL-' || user_id when 'signup' then 'pixtral-' || user_id when 'purchase' then 'GPT-4o' else 'gpt-' || user_id end) m from events) select event_id, case when m like 'gemini-%' or m in ('gpt-4o', 'gpt-4-vision-preview') then 'gemini' when m like 'mistral-%' or m like 'pixtral-%' or m like 'codestral-%' then 'mistral' else 'unsupported' end route from m")
def model_routes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.model_route(_model()).alias("route"))


@query("select event_id, case when event_type in ('click', 'view') and user_id % 2 = 0 then 'pixtral-12b' else case when user_id % 2 = 0 then 'mistral-small' else 'Pixtral-large-latest' end end model from events")
def vision_fallback(spark, sf_dir):
    model = F.when(F.col("user_id") % 2 == 0, "mistral-small").otherwise("Pixtral-large-latest")
    parts = F.when(F.col("event_type").isin("click", "view"), F.array(F.lit("part")))
    return table(spark, sf_dir, "events").select("event_id", T.vision_model(model, parts, ["pixtral-12b", "pixtral-large-latest"], "pixtral-12b").alias("model"))


@query("""with e as (select event_id, user_id % 2 = 0 mistral, case event_type when 'click' then 'Deadline Exceeded by ' || user_id when 'view' then 'API key not valid: ' || event_id when 'signup' then 'Permission_Denied: consumer suspended' when 'purchase' then 'Mistral request failed after ' || user_id || ' tries: Unauthorized' else 'HTTP ' || event_id || ': Connection refused' end e from events), l as (select *, lower(e) l from e)
select event_id, case when mistral and (l like '%quota%' or l like '%rate limit%' or l like '%exceeded%' or l like '%permission_denied%' or l like '%unauthorized%' or l like '%invalid api key%') then 'retire' when mistral then 'other'
when l like '%quota%' or l like '%rate limit%' or l like '%exceeded%' or l like '%invalid argument%' or l like '%internal error%' or regexp_matches(l, '504|503|500|429') then 'retire' when l like '%api key not valid%' or l like '%suspended%' or l like '%expired%' or l like '%permission_denied%' then 'remove' else 'retire' end class,
case when e like '%Connection refused%' then 'Connection Failed. Is the AI Gateway server running at http://h?' when e like '%All Gemini API keys have been exhausted%' then 'Server reported that all Gemini keys are exhausted or have failed. Please check the server logs.' when e like '%Mistral request failed after%' then 'Server reported that all retries for Mistral failed. The Mistral API might be down or all keys are invalid.' else 'An unhandled error occurred: ' || e end message from l""")
def error_classes(spark, sf_dir):
    """Errors with ids in them, some of which read like a status."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    e = F.when(kind == "click", F.concat(F.lit("Deadline Exceeded by "), user)).when(kind == "view", F.concat(F.lit("API key not valid: "), F.col("event_id").cast("string"))).when(kind == "signup", "Permission_Denied: consumer suspended")
    e = e.when(kind == "purchase", F.concat(F.lit("Mistral request failed after "), user, F.lit(" tries: Unauthorized"))).otherwise(F.concat(F.lit("HTTP "), F.col("event_id").cast("string"), F.lit(": Connection refused")))
    provider = F.when(F.col("user_id") % 2 == 0, "mistral").otherwise("gemini")
    return table(spark, sf_dir, "events").select("event_id", T.error_class(e, provider).alias("class"), T.user_message(e, "http://h").alias("message"))


@query("with c as (select *, row_number() over (partition by conv_id order by turn desc) = 1 is_last from conversations) select conv_id, turn, case when role = 'assistant' then 'model' else 'user' end provider_role, is_last from c where is_last or turn % 4 <> 1")
def chat_history(spark, sf_dir):
    """Every fourth turn has list content, which history drops."""
    m = table(spark, sf_dir, "conversations").withColumn("content_text", F.when(F.col("turn") % 4 != 1, F.col("text")))
    return messages.split_history(m).select("conv_id", "turn", "provider_role", "is_last")


@query("select conv_id, turn, case when turn % 3 = 0 then text else text || ' ' || role end as text, turn % 3 = 2 sends_images from conversations")
def message_contents(spark, sf_dir):
    """String contents; lists of two text parts; and such lists with an image, decodable in every third turn only."""
    t = F.col("turn")

    def part(kind, text, url):
        return F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), url.cast("string").alias("image_url"))

    none = F.lit(None)
    url = F.when(t % 3 == 2, "data:image/png;base64,aGVsbG8=").otherwise("data:image/png;base64,###")
    parts = F.array(part("text", F.col("text"), none), part("image_url", none, url), part("text", F.col("role"), none))
    m = table(spark, sf_dir, "conversations").withColumn("content_text", F.when(t % 3 == 0, F.col("text"))).withColumn("parts", F.when(t % 3 != 0, parts)).drop("text")
    return messages.content_of(m).select("conv_id", "turn", "text", "sends_images")


@query("""with q as (select *, conv_id || '-' || turn id, 'img/' || conv_id || '-' || turn own from conversations),
p as (select *, own || '.png' p1, own || '.doc' p2, 'img/none-' || turn || '.webp' p3, own || '.TIF' p4 from q),
e as (select *, case when turn % 5 = 0 then 'Either ''prompt'' or ''messages'' must be provided.' when turn % 5 in (1, 3) and role <> 'user' then 'Images can only be added to the most recent ''user'' message in the history.' when turn % 5 = 3 then 'The last message content must be a string when providing new images.' end error from p)
select conv_id, turn, error, case when error is null then case when turn % 5 = 1 then
'text=[Error processing image 3: Error processing image file ' || p3 || ': Image file not found at ' || p3 || e']\n[Error processing image 2: Error processing image file ' || p2 || ': Unsupported or unknown image format for file: ' || conv_id || '-' || turn || e'.doc]\n' || text || '|image_url=data:image/png;base64,' || to_base64(encode(text || '1')) || '|image_url=data:image/tiff;base64,' || to_base64(encode(text || '4'))
when turn % 5 = 2 then 'text=' || role else 'text=' || text end end parts from e""")
def assembled_requests(spark, sf_dir):
    """By turn: neither prompt nor messages; images on a text, one missing and one of no image type; a prompt only; images on list content; a message beside a prompt."""
    c = table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    own, t = F.concat(F.lit("img/"), F.col("id")), F.col("turn") % 5
    named = lambda *ends: F.array(*[F.concat(own, F.lit(e)) for e in ends])
    missing = F.concat(F.lit("img/none-"), F.col("turn").cast("string"), F.lit(".webp"))
    stored = c.select(F.explode(F.arrays_zip(named(".png", ".doc", ".TIF").alias("path"), F.array(*[F.encode(F.concat("text", F.lit(x)), "UTF-8") for x in "124"]).alias("content"))).alias("f")).select("f.*")
    asked = c.withColumn("images", F.when(t.isin(1, 3), F.array(F.concat(own, F.lit(".png")), F.concat(own, F.lit(".doc")), missing, F.concat(own, F.lit(".TIF")))).otherwise(F.array().cast("array<string>")))
    rows = messages.with_pictures(asked, stored, "id")
    made = messages.assemble(F.when(t == 0, "").when(t == 2, F.col("role")).otherwise("a prompt"), F.when(t.isin(0, 2), 0).otherwise(1), F.col("role"), F.when(t != 3, F.col("text")), F.col("pictures"))
    out = rows.select("conv_id", "turn", made.alias("m"))
    return out.select("conv_id", "turn", "m.error", F.array_join(F.transform("m.parts", lambda x: F.concat_ws("=", x["type"], x["value"])), "|").alias("parts"))


#: Request bodies and whether their `stream` counts; names of files, whose types the standard table tells.
STREAMS = ["true", "false", "null", "1", "0", "0.0", "-1.5", '""', '"false"', '"on"', "[]", "[0]", "{}", '{"a": null}', "1e3"]
BODIES = [f'{{"model": "m", "stream": {x}}}' for x in STREAMS] + ['{"model": "m"}', "{bad", "", "[1]", '"text"', '{"a": {"stream": true}}']
NAMES = [f"{x}.{e}" for x, e in zip("abcdefghijklmnopqrstuvwxyz0123456789", ["mp3", "MP3", "wav", "m4a", "mp4", "mkv", "webm", "mpeg", "mpg", "mov", "avi", "ogg", "flac", "aac", "opus", "3gp", "aiff", "au", "txt", "png", "mp3.gz", "mp4.bak", "tar.gz", "svgz", "tif", "tiff", "bmp", "gif", "ico", "jpe", "JPEG", "webp", "heic", "avif", "svg", "pdf"])] + ["noending", ".mp3", "..mp4", "dir.mp3/file", "dots...wav", "end."]


def _status(body):
    try:
        v = json.loads(body)
    except ValueError:
        return 400
    return 500 if not isinstance(v, dict) else 400 if v.get("stream") else 200


def _told(name, *kinds):
    kind = mimetypes.MimeTypes().guess_type(name)[0]
    return kind if kind and kind.split("/")[0] in kinds else None


def _values(pairs):
    quoted = lambda x: "null" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({', '.join(quoted(x) for x in p)})" for p in pairs)


def _nth(items, i):
    return F.element_at(F.array(*[F.lit(x) for x in items]), (i % len(items) + 1).cast("int"))


@query(f"with v(body, status) as (values {_values([(b, _status(b)) for b in BODIES])}), n as (select *, row_number() over () - 1 i from v) select event_id, body, status from events join n on i = event_id % {len(BODIES)}")
def chat_request_checks(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", _nth(BODIES, F.col("event_id")).alias("body"))
    return rows.withColumn("status", messages.chat_request_status(F.col("body")))


@query(f"""with v(name, kind, image) as (values {_values([(n, _told(n, "audio", "video"), _told(n, "image")) for n in NAMES])}), n as (select *, row_number() over () - 1 i from v)
select event_id, user_id || name as name, case when event_id % 7 = 0 then 'audio/x-' || event_type when event_id % 7 <> 1 then kind end media_type, image image_type, case when event_id % 3 = 0 then 200 else 400 end upload_status from events join n on i = event_id % {len(NAMES)}""")
def upload_checks(spark, sf_dir):
    """Stated types of two rows in seven, one of them no audio or video; else by the name's ending."""
    i = F.col("event_id")
    explicit = F.when(i % 7 == 0, F.concat(F.lit("audio/x-"), "event_type")).when(i % 7 == 1, "text/plain").otherwise("")
    parts = F.when(i % 3 == 0, F.array(F.lit("file"), F.lit("purpose"))).when(i % 3 == 1, F.array(F.lit("purpose"), F.lit("file"))).otherwise(F.array(F.lit("file")))
    named = table(spark, sf_dir, "events").withColumn("name", F.concat(F.col("user_id").cast("string"), _nth(NAMES, i)))
    bare = _nth(NAMES, i)  # the user in front would hide dots that begin a name
    return named.select("event_id", "name", messages.upload_media_type(explicit, bare).alias("media_type"), T.image_mime(bare).alias("image_type"), messages.file_upload_status(parts).alias("upload_status"))


@query("""select conv_id, turn, '{"id":"' || conv_id || '-' || turn || '","object":"chat.completion","created":0,"model":"m","choices":[{"index":0,"message":{"role":"assistant","content":"' || role || '"},"finish_reason":"stop"}],"usage":{"prompt_tokens":0,"completion_tokens":0,"total_tokens":0}}' response from conversations""")
def chat_completions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", messages.completion(F.lit("m"), F.col("role"), F.lit(0), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("response"))


@query("""with g as (select c, r, c * r area, row_number() over (order by c * r, c, r) o from (select unnest(range(1, 13)) c) cross join (select unnest(range(1, 13)) r) where c * r <= 12),
i as (select event_id, (200 + event_id * 37 % 1800)::int width, (150 + event_id * 53 % 1200)::int height from events),
d as (select i.*, c, r, area, o, abs(width::double / height - c::double / r) d from i cross join g),
m as (select event_id, min(d) m from d group by 1),
b as (select d.* from d join m using (event_id) where d.d = m.m),
f as (select event_id, coalesce(max(o) filter (width * height > 0.5 * 448 * 448 * area), 0) o1, min(o) o0 from b group by 1)
select i.event_id, i.width, i.height, g.c::int as cols, g.r::int as "rows" from i join f using (event_id) join g on g.o = greatest(f.o0, f.o1)""")
def tile_grids(spark, sf_dir):
    return messages.tile_grid(_images(spark, sf_dir))


def _images(spark, sf_dir):
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", (200 + i * 37 % 1800).cast("int").alias("width"), (150 + i * 53 % 1200).cast("int").alias("height"))


@query("select event_id, t.tile::int tile, (t.tile % 3 * 448)::int x0, (t.tile // 3 * 448)::int y0, ((t.tile % 3 + 1) * 448)::int x1, ((t.tile // 3 + 1) * 448)::int y1 from events cross join (select unnest(range(0, 6)) tile) t union all select event_id, -1, 0, 0, 448, 448 from events")
def tile_boxes(spark, sf_dir):
    return messages.tile_boxes(table(spark, sf_dir, "events").select("event_id", F.lit(3).alias("cols"), F.lit(2).alias("rows"))).select("event_id", "tile", "x0", "y0", "x1", "y1")
