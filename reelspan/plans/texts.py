"""Queries over texts, JSON responses and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelspan.functions import text as T
from reelspan.operators.shots import over_threshold
from reelspan.plans.proxies import table
from reelspan.plans.registry import query
from reelspan.sources import files


@query("select doc_id, strip_accents(text) folded from documents")
def folded_accents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fold_accents("text").alias("folded"))


@query("select event_id, printf('%02.0f', floor(event_id / 25.0 / 60)) || ':' || printf('%06.3f', (event_id / 25.0::double) % 60) time_stamp from events")
def time_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.time_stamp(F.col("event_id") / F.lit(25.0)).alias("time_stamp"))


RAW = """case doc_id % 6 when 0 then e'```json\n{"a": ' || doc_id || e'}\n```' when 1 then 'so {"a": [' || doc_id || ']} it is' when 2 then '{' || doc_id || '}' when 3 then '{"other": "' || source || '"}' when 4 then '  plain text ' || doc_id else '{bad' end"""


def _raw():
    i = F.col("doc_id")
    n = i.cast("string")
    return F.when(i % 6 == 0, F.concat(F.lit('```json\n{"a": '), n, F.lit("}\n```"))).when(i % 6 == 1, F.concat(F.lit('so {"a": ['), n, F.lit("]} it is"))).when(i % 6 == 2, F.concat(F.lit("{"), n, F.lit("}"))).when(i % 6 == 3, F.concat(F.lit('{"other": "'), "source", F.lit('"}'))).when(i % 6 == 4, F.concat(F.lit("  plain text "), n)).otherwise("{bad")


@query(r"""select doc_id, case when doc_id % 6 in (1, 2) then '' else trim(text, e' \t\n\r\x0b\x0c') end ocr from documents""")
def ocr_texts(spark, sf_dir):
    """Whole texts as answers: plain, and as the first, a later or no item of a JSON answer in a fence."""
    i = F.col("doc_id") % 6
    items = F.when(i == 0, F.array("text", F.lit("b"))).when(i == 1, F.array().cast("array<string>"))
    made = F.concat(F.lit("```json\n"), F.to_json(F.struct(items.alias("extracted_texts"))), F.lit("\n```"))
    raw = F.when(i < 2, made).when(i == 2, '{"extracted_texts": [1]}').otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", T.ocr_text(raw).alias("ocr"))


@query(f"with o as (select doc_id, {RAW} raw, nullif(regexp_extract({RAW}, '(?s)\\{{.*\\}}', 0), '') object from documents) select doc_id, case when json_valid(object) then object end object, trim(regexp_replace(raw, '```(json)?', '', 'g'), ' ') like '%```%' fenced from o")
def json_objects(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.json_object(_raw()).alias("object"), T.strip_fences(_raw()).contains("```").alias("fenced"))


@query("select doc_id, case when doc_id % 3 = 0 then source else '' end channel_name, case when doc_id % 3 = 0 then lang else '' end main_news_text, '' thumbnail_text, '' as \"time\" from documents")
def structured_ocr(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(F.col("source").alias("channel_name"), F.col("lang").alias("main_news_text")))).when(F.col("doc_id") % 3 == 1, "no object").otherwise("{bad}")
    return table(spark, sf_dir, "documents").select("doc_id", T.structured_ocr(raw).alias("s")).select("doc_id", "s.*")


@query("select doc_id, string_split(text || ' | ' || lang || '| ' || source || ' | ', ' | ') tags from documents")
def tag_lists(spark, sf_dir):
    raw = F.concat("text", F.lit(" | "), "lang", F.lit("| "), "source", F.lit(" | "))
    return table(spark, sf_dir, "documents").select("doc_id", T.split_tags(raw).alias("tags"))


@query("select page_id, regexp_extract(url, '([^/]*)$', 1) base, regexp_matches(url, '^https?://') remote, case when len(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+)\\.[^.]*$', 1)) > 0 then regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+)\\.[^.]*$', 1) else regexp_extract(url, '([^/]*)$', 1) end stem from pages")
def url_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.base_name(F.col("url")).alias("base"), T.is_url(F.col("url")).alias("remote"), T.stem(F.col("url")).alias("stem"))


@query("""select doc_id, 'data:image/png;base64,' || to_base64(encode(text)) uri, true valid, false invalid, false unmarked from documents""")
def image_uris(spark, sf_dir):
    """Whole texts as the bytes of a file; also the same with a stray prefix, and without the base64 marker."""
    uri = T.data_uri(T.image_mime(F.lit("x.PNG")), F.col("text").cast("binary"))
    d = table(spark, sf_dir, "documents").select("doc_id", uri.alias("uri"))
    return d.select("doc_id", "uri", T.is_image_uri(F.col("uri")).alias("valid"), T.is_image_uri(F.concat(F.lit("x"), "uri")).alias("invalid"), T.is_image_uri(F.replace(F.col("uri"), F.lit(";base64"))).alias("unmarked"))


@query("select event_id, case event_id * 7 // 86400 when 0 then '' when 1 then '1 day, ' else (event_id * 7 // 86400) || ' days, ' end || (event_id * 7 % 86400 // 3600) || ':' || lpad((event_id * 7 % 3600 // 60)::varchar, 2, '0') || ':' || lpad((event_id * 7 % 60)::varchar, 2, '0') up, greatest(1, (event_id + 7) // 8)::bigint n_batches, case when event_id % 4 = 0 then false else event_id % 4 = 1 end passes from events")
def uptime_and_batches(spark, sf_dir):
    """Also the strict 32-bit threshold: 0.3 as a float does not pass, 0.31 does."""
    i = F.col("event_id")
    score = F.when(i % 4 == 0, F.lit(0.3)).when(i % 4 == 1, F.lit(0.31)).otherwise(F.lit(0.1))
    return table(spark, sf_dir, "events").select("event_id", T.uptime(i * 7).alias("up"), T.batch_count(i, 8).alias("n_batches"), over_threshold(score).alias("passes"))


@query("""with p as (select doc_id playlist_id, source, lang from documents), v as (select playlist_id, 0 pos, lang || '/low.m3u8' uri, true is_variant, false remote from p where playlist_id % 2 = 0)
select * from v union all select playlist_id, 0, 'https://h/' || source || '.ts', false, true from p where playlist_id % 2 = 1 union all select playlist_id, 1, source || '-2.ts', false, false from p where playlist_id % 2 = 1""")
def playlist_entries(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    variant = F.concat(F.lit("#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\n"), "lang", F.lit("/low.m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=2\n"), "lang", F.lit("/high.m3u8\n"))
    media = F.concat(F.lit("#EXTM3U\r\n#EXTINF:4,\r\nhttps://h/"), "source", F.lit(".ts\r\n#EXTINF:4,\r\n"), "source", F.lit("-2.ts\r\n#EXT-X-ENDLIST"))
    return files.playlist(d.select(F.col("doc_id").alias("playlist_id"), F.when(F.col("doc_id") % 2 == 0, variant).otherwise(media).alias("text")))


@query("""with s as (select doc_id, 'p/' || doc_id || '.m3u8' path, text from documents),
e as (select path, 0::int pos, case when doc_id % 2 = 0 then doc_id else doc_id - 1 end own from s union all select path, 1, doc_id from s where doc_id % 2 = 1)
select e.path, e.pos, 's/' || e.own || '.ts' segment, sha256(coalesce(d.text, '')) sha256, case when d.doc_id is null then 'no segment s/' || e.own || '.ts' end error from e left join documents d on d.doc_id = e.own where d.doc_id is not null
union all select e.path, e.pos, 's/' || e.own || '.ts', null, 'no segment s/' || e.own || '.ts' from e anti join documents d on d.doc_id = e.own""")
def resolved_playlists(spark, sf_dir):
    """Playlists of documents as segments: every second one by way of a variant list, with a list of its own."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    before = (F.col("doc_id") - 1).cast("string")
    file = lambda folder, end, content: d.select(F.concat(F.lit(folder), i, F.lit(end)).alias("path"), content.cast("binary").alias("content"))
    media = F.concat(F.lit("#EXTM3U\n../s/"), before, F.lit(".ts\n#EXTINF:4,\n../q/../s/"), i, F.lit(".ts\n"))
    variant = F.concat(F.lit("#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1\nlow/"), i, F.lit(".m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=2\nhigh.m3u8\n"))
    lists = file("p/", ".m3u8", F.when(F.col("doc_id") % 2 == 1, media).otherwise(variant))
    low = file("p/low/", ".m3u8", F.concat(F.lit("../s/"), i, F.lit(".ts"))).filter("path is not null")
    stored = lists.unionByName(low).unionByName(file("s/", ".ts", F.coalesce("text", F.lit(""))))
    out = files.segments_of_playlists(lists.select("path"), stored)
    return out.select("path", "pos", "segment", F.sha2("content", 256).alias("sha256"), "error")


@query("""with c as (select c_custkey pos, case when c_acctbal < 0 then null else e' \\t' || c_mktsegment || '-' || (c_custkey % 40) || ' ' end t from customer),
f as (select trim(t, e' \\t') token, min(pos) pos from c where t is not null group by 1), p as (select token, row_number() over (order by pos) - 1 place from f)
select token, 'mistral-' || token[1:4] || '...' || token[-4:] || '-' || place as name, place::int place from p""")
def named_plain_keys(spark, sf_dir):
    """The cells of a headerless sheet, with repeats and empty ones, as keys with names by place."""
    c = table(spark, sf_dir, "customer")
    cell = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" \t"), "c_mktsegment", F.lit("-"), (F.col("c_custkey") % 40).cast("string"), F.lit(" ")))
    return files.named_keys(c.select(F.col("c_custkey").alias("pos"), cell.alias("token")), "mistral")
