"""Fill-in-middle against plain slicing of strings, and the rank index against its offsets."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from reelspan.llm import fim, queries
from tests.llm.test_operators import ODD, SF, empty, frame

TEXTS = [*ODD, "has <P> in it", "ends in <", "<", "<S", "\U0001f600" * 700 + "a" * 5000 + "é" * 3000, "word " * 70_000, "a\x00b", "\n\n x\ny\n"]


def plain(doc_id, text):
    t, h = text or "", hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(t)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    x, y, z = t[:i], t[i:j], t[j:]
    if h[3] % 100 < 20:
        return n, "spm", i, j - i, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", i, j - i, f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("epsilon", [0, 3, 100])
def test_rank_index_is_exact(epsilon):
    r = np.random.default_rng(1)
    for gaps in (np.ones(5000), r.integers(1, 5, 9000), r.integers(1, 400, 3000), np.concatenate([np.ones(4000), np.full(4000, 4)]), [7]):
        y = np.concatenate(([0], np.cumsum(gaps))).astype(np.int64)
        index = fim.RankIndex(lambda: iter(np.array_split(y, 7)), epsilon)
        assert index.size == len(y)
        assert [index.offset(i) for i in range(len(y))] == y.tolist()
        assert max(abs(index.predicted(i) - int(v)) for i, v in enumerate(y)) <= epsilon + 1
    assert len(fim.RankIndex(lambda: iter([np.arange(10**6)])).first) == 1


@pytest.mark.parametrize("unit,split", [("char", lambda t: list(t)), ("line", lambda t: t.splitlines(keepends=True))])
def test_boundaries(unit, split):
    for t in ("a\nb\n\nc", "é\U0001f600x", "abc\n"):
        own, at = [], 0
        for x in split(t):
            own.append(at)
            at += len(x.encode())
        for piece in (1, 2, 1 << 16):
            got = np.concatenate(list(fim.boundaries(np.frombuffer(t.encode(), np.uint8), unit, piece)))
            assert got.tolist() == [*own, at]
    words = np.concatenate(list(fim.boundaries(np.frombuffer(b"  ab c  d ", np.uint8), "word", 3)))
    assert words.tolist() == [0, 2, 5, 8, 10]


def test_equals_plain_slicing(spark):
    texts = TEXTS * 12
    got = {r.doc_id: r for r in fim.restored(fim.fill_in_middle(frame(spark, texts))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n, r.form, r.prefix_n, r.middle_n, r.output) == plain(i, t)
        assert r.restored == (t or "")
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_odd_tables(spark):
    assert fim.fill_in_middle(empty(spark)).collect() == []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "text", "a.b", "x y", "draws", "n", "output")])
    df = spark.createDataFrame([(None, "some text", "k", None, "d", "n", "o"), ("1", "some text", "k", "y", "d", "n", "o"), ("1", "some text", "k", "y", "d", "n", "o")], schema)
    rows = fim.fill_in_middle(df, unit="word").collect()
    assert len(rows) == 3 and rows[1] == rows[2] and {r.n for r in rows} == {2} and {r.draws for r in rows} == {"d"} and {r["a.b"] for r in rows} == {"k"}
    assert fim.fill_in_middle(df).columns == ["doc_id", "text", "a.b", "x y", "draws", "n", "form", "prefix_n", "middle_n", "output"]


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op12_fim(spark, SF).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert len(got) == len(docs)
    for d in docs:
        n, form, a, b, out = plain(d.doc_id, d.text)
        assert got[d.doc_id][1:] == (n, form, a, b, sha(out), sha(d.text or ""))
