"""run() against the stages done plainly on a small table."""

import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from reelspan.llm import bpe, common, jaccard, pii, quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "quality label").filter(common.bucket_of("doc_id", 4) != 2)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = quality.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scores = model.score(*quality.features(pa.array([t for _, t in rows])))
    rows = [r for r, s in zip(rows, scores) if s >= corpus_pipeline.QUALITY]
    assert 0 < len(rows) < docs.count()
    first = {d for d, _, c in brute.components(rows, 5, 80) if d == c}
    assert len(first) < len(rows)
    rows = [(d, t) for d, t in rows if d in first]
    clean = [(d, t) for d, t in rows if not any(i in t for i in items)]
    assert len(clean) < len(rows)
    kept = docs.filter(docs.doc_id.isin([d for d, _ in clean]))
    finder = pii.train(kept)
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(got) == {d for d, _ in clean}
    changed = 0
    for d, t in clean:
        out = pii.redact(t, sum(finder.find(t), []))
        changed += out != t
        assert not any(t[a:b] in out for a, _, b in brute.pii(t))
        ids = np.array(enc.encode_ordinary(out), "<u4").tobytes()
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(out.encode()).hexdigest())
    assert changed


def test_stages_keep_odd_rows(spark):
    from tests.llm.test_operators import ODD

    rows = [(i, t, None, None, None) for i, t in enumerate([*ODD, *ODD[:7]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one = corpus_pipeline.one_of_each(spark, docs, SF)
    assert one.columns == docs.columns
    assert {r.doc_id for r in one.collect()} == {d for d, _, c in brute.components([r[:2] for r in rows], 5, 80) if d == c}
    assert corpus_pipeline.no_leaks(spark, docs, SF).count() == len(rows)
    assert corpus_pipeline.no_personal_data(spark, docs, SF).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_of_each_with_null_and_clashing_ids(spark):
    from tests.llm.test_operators import sample

    a, b, c, d, e, f = sample(18)[::3]
    long = " ".join(f"word{i}" for i in range(40))
    texts = [(None, a), (None, b), (7, c), (7, d), (8, e), (None, e), (9, f), (9, f), (9, f), (None, long), (None, long.replace("word39", "end")), (None, None), (None, ""), (3, None), (3, None)]
    rows = [(i, t, None, None, None) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    seen = []
    for n in (1, 5):
        got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, schema).repartition(n), SF).collect()
        known = sorted(((r.doc_id, r.text) for r in got if r.text != long and not (r.text or "").endswith("end")), key=repr)
        assert known == sorted([(None, a), (None, b), (7, c), (7, d), (8, e), (9, f), (None, None), (None, ""), (3, None), (3, None)], key=repr)
        assert len(got) == len(known) + 1
        seen.append(set(got))
    assert seen[0] == seen[1]


def test_stages_keep_columns_of_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).selectExpr("*", "doc_id + 1 as row", "'s' as score", "lang as `a.b`", "source as hash", "1 as component_id", "2 as ROW_", "text as item_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert all(r["row"] == r.doc_id + 1 and r["score"] == "s" and r["a.b"] == r.lang for r in got.collect())
        without = docs.select("doc_id", "lang", "source", "text")
        assert stage(spark, without, SF).columns == without.columns
    assert corpus_pipeline.token_ids(spark, docs, SF).count() == 60


def test_quality_keeps_what_op3_predicts():
    assert corpus_pipeline.QUALITY == 0.7


def shuffled(spark):
    """Bytes of shuffles written so far in this session."""
    all_of_them = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(all_of_them.apply(i).totalShuffleWrite() for i in range(all_of_them.size()))


def test_texts_are_not_shuffled_where_no_table_is_small(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 16, 8200)) for _ in range(300)]
    texts = [" ".join(t[i : i + 40] for i in range(0, 8200, 41)) for t in texts]
    for i in range(3):
        texts[10 + i] = texts[200 + i].rsplit(" ", 1)[0] + " other"
    spark.createDataFrame([(i, " ".join(texts[50 + i].split()[20:32])) for i in range(3)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([*enumerate(texts), (None, None), (None, None)], "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, gone in ((corpus_pipeline.one_of_each, {200, 201, 202}), (corpus_pipeline.no_leaks, {50, 51, 52})):
            before = shuffled(spark)
            got = [r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()]
            assert sorted(got, key=repr) == sorted([*({*range(300)} - gone), None, None], key=repr)
            assert shuffled(spark) - before < sum(map(len, texts)) / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_by_a_broadcast_bit_for_each_hash(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("if(id % 100 = 7, null, id * 7919 - 5000000) as k", "id as `a.b`", "id as slot", "id as may")
    keys = rows.filter("slot % 400 = 3").select("k").union(spark.createDataFrame([(1,), (None,)], "k long"))
    wanted = {r.k for r in keys.collect()} - {None}
    may = common.sifted(rows, keys, "k")
    assert may.columns == rows.columns
    assert {r.k for r in may.collect()} >= wanted - {1} and may.filter("k is not null").count() < len(wanted) + 10
    for most in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        got = common.without(rows.union(rows), keys, "k")
        assert got.columns == rows.columns
        assert sorted(r.slot for r in got.collect()) == sorted(2 * [r.slot for r in rows.collect() if r.k not in wanted])
    for most in (common.SLOTS, 0):
        monkeypatch.setattr(common, "SLOTS", most)
        got = common.marked(rows, keys, F.col("k") + 2**40, "is_key")
        assert {r.k for r in got.filter("is_key").collect()} == wanted - {1} and got.count() == 20_000


def test_shuffle_files_of_a_cut_go_with_its_end(spark):
    import time

    def files():
        return {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before, set_before = files(), spark.conf.get(common.CLEANUP, None)
    made = common.cut(spark.range(50_000).selectExpr("xxhash64(id) as k").repartition(4, "k"))
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert made.distinct().count() == 50_000
    assert spark.conf.get(common.CLEANUP, None) == set_before


def test_a_tasks_share_of_the_sketch_is_small():
    rng = np.random.default_rng(3)
    for counts, most in ((rng.poisson(1, jaccard.BLOCK), 0.5), (rng.integers(0, 2**40, jaccard.BLOCK), 9), (np.zeros(jaccard.BLOCK, np.int64), 0.1)):
        data = jaccard.packed(counts)
        assert (jaccard.unpacked(data) == counts).all() and len(data) < most * jaccard.BLOCK
