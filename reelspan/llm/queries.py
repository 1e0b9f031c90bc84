"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.llm import bpe, decontam, fim, fingerprint, html, jaccard, langid, lm, pii, quality, secrets, variants, warc
from reelspan.llm.common import bucket_of, shared_dir, table

RANKS = "byte_bpe_50k.tiktoken"


def _of_kind(spans: str, field: str, value) -> Column:
    """How many spans have that value."""
    return F.size(F.filter(spans, lambda s: s[field] == F.lit(value))).cast("long")


def _sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.train(docs))
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [_of_kind("base", "rank", i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, _sha(joined(F.col("base"))).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.RULES if r.base]
    counts = [_of_kind("spans", "kind", k).alias(f"n_{k}") for k in base]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *counts, _sha(secrets.joined(own)).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def _op2_sql() -> str:
    kinds = []
    for at, r in enumerate(secrets.RULES):
        p = r.pattern.replace("'", "''")
        kinds.append(f"""select doc_id, '{r.kind}' kind, {at} rank, text, regexp_extract_all(text, '{p}', 0) m, regexp_extract_all(text, '{p}', {r.group}) g, string_split_regex(text, '{p}') gap, {r.least} least from d where regexp_matches(text, '{p}')""")
    base = ", ".join(f"'{r.kind}'" for r in secrets.RULES if r.base)
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') n_{r.kind}" for r in secrets.RULES if r.base)
    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
f as ({" union all ".join(kinds)}),
e as (select doc_id, kind, rank, least, unnest(range(1, len(m) + 1)) i, m, g, gap from f),
s as (select doc_id, kind, rank, i, len(g[i]) as glen, least, (list_sum(list_transform(gap[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: len(x))), 0))::bigint as a, len(m[i]) as l from e),
k as (select doc_id, kind, rank, a, a + l as b from s where glen >= least),
j as (select doc_id, {counts}, coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, rank) filter (kind in ({base})), '') base, string_agg(kind || ':' || a || ':' || b, ',' order by a, rank) spans from k group by doc_id)
select d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from d left join j using (doc_id)"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(bucket_of("doc_id", 4) != 2)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (bucket_of("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.ngram_jaccard_join(table(spark, sf_dir, "documents"), k=3, percent=90)


OP4_SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')] else list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))) end sh from w),
o as (select doc_id, list_sort(sh) sh, len(sh) n from s),
c as (select sh, min(doc_id) cls, min(n) n from o group by sh),
e as (select cls, n, unnest(sh) t from c where n > 0),
f as (select t from e group by t having count(*) > 1),
x as (select e.* from e join f using (t)),
p as (select a.cls a, b.cls b, a.n an, b.n bn, count(*) m from x a join x b on a.t = b.t and a.cls < b.cls and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n group by 1, 2, 3, 4),
l as (select a, b from p where 100 * m >= 90 * (an + bn - m)),
b as (select a, b from l union all select b, a from l),
r as (select cls root, cls node from c where n > 0 union select r.root, b.b from r join b on r.node = b.a),
k as (select node, min(root) least from r group by node)
select o.doc_id, o.n n_shingles, case when o.n = 0 then o.doc_id else k.least end component_id
from o left join c on o.sh = c.sh left join k on k.node = c.cls"""


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.winning_paths(pages)).withColumn("n_chars", F.char_length("text").cast("long"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.order_minhash(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text").withColumn("held_out", bucket_of("doc_id", 5) == 0)
    return langid.identify(docs.select("doc_id", "held_out", "text"), docs.filter(~F.col("held_out")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", bucket_of("doc_id", 7) == 2)
    return lm.score(docs.select("doc_id", "held_out", "text"), docs.filter(~F.col("held_out")), public_tokenizers.path(RANKS))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return warc.pages_of(spark, path)


OP11_SQL = """
with p as (select page_id, coalesce(html, '') h, octet_length(encode(coalesce(html, '')))::bigint n from pages),
m as (select *, case when n >= 1000 then max(page_id) over (partition by h) end o from p)
select page_id, n payload_bytes, sha1(h) payload_digest, case when page_id < o then 'revisit' else 'response' end record_type, case when page_id < o then o end refers_to from m"""


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restored(fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return rows.select("doc_id", "n", "form", F.col("prefix_n").alias("prefix_chars"), F.col("middle_n").alias("middle_chars"), _sha(F.col("output")).alias("output_sha256"), _sha(F.col("restored")).alias("restored_sha256"))


OP12_SQL = """
with d as (select doc_id, coalesce(text, '') t, length(coalesce(text, ''))::bigint n, sha256('1:' || doc_id) h from documents),
u as (select doc_id, t, n, ('0x' || h[1:8])::bigint % (n + 1) a, ('0x' || h[9:16])::bigint % (n + 1) b, ('0x' || h[17:24])::bigint % 100 c, ('0x' || h[25:32])::bigint % 100 e from d),
f as (select doc_id, t, n, least(a, b) i, greatest(a, b) j, case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or c >= 90 then 'plain' when e < 20 then 'spm' else 'psm' end form from u),
p as (select doc_id, t, n, form, i, j, substring(t, 1, i) x, substring(t, i + 1, j - i) y, substring(t, j + 1) z from f)
select doc_id, n, form, case when form <> 'plain' then i end prefix_chars, case when form <> 'plain' then j - i end middle_chars,
sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y else '<S>' || z || '<P>' || x || '<M>' || y end) output_sha256, sha256(t) restored_sha256 from p"""


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.vocabulary(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_pii, op2_secrets, op3_quality, op4_ngram_jaccard, op5_html, op6_order_minhash, op7_language, op8_bpe, op9_lm, op10_decontaminate, op11_warc, op12_fim, op13_variants, pipeline)}
SQL = {"op2_secrets": _op2_sql(), "op4_ngram_jaccard": OP4_SQL, "op11_warc": OP11_SQL, "op12_fim": OP12_SQL}
