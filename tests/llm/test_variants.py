"""Spelling variants against plain edit distance over whole vocabularies."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelspan.llm import queries, variants
from tests.llm.test_operators import ODD, SF, empty, frame


def counts(rows, least_length=5, least_n=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_n}


def near(words):
    """Words at distance one, by what is left when one code point is taken out of either or both."""
    gaps = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i] + w[i + 1 :]].add((w, i))
    out = defaultdict(set)
    for gap, own in gaps.items():
        for w, i in own:
            if gap in words:
                out[w].add(gap)
                out[gap].add(w)
            out[w] |= {v for v, j in own if i == j and v != w}
    return out


def brute(n):
    pairs, form = near(n), {}
    for w in n:
        best = min(pairs[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(pairs[w]), n.get(form[w])))
    return sorted(rows)


def made(seed, size=400):
    r = random.Random(seed)
    words = {"".join(r.choice("abc") for _ in range(r.randrange(5, 9))) for _ in range(size)}
    words |= {"prefix" + "".join(r.choice("abéÿ") for _ in range(r.randrange(0, 6))) for _ in range(size)} | {"".join(r.choice("ab") for _ in range(r.randrange(0, 6))) + "suffix" for _ in range(size)}
    return {w: r.choice([3, 3, 4, 7, 20, 90, 1000]) for w in words} | {"a" * k: 10 * k for k in range(5, 40)} | {"x" * 3000: 3, "x" * 2999: 9}


def test_suffix_array():
    r = np.random.default_rng(3)
    for n, s in ((1, 2), (5, 2), (300, 2), (300, 90), (64, 70_000)):
        t = np.concatenate((r.integers(1, s, n), [0]))
        assert variants.suffix_array(t).tolist() == sorted(range(n + 1), key=lambda i: t[i:].tolist())
    t = np.array([1] * 500 + [0])
    assert variants.suffix_array(t).tolist() == list(range(500, -1, -1))


def test_intervals_stay_in_step():
    words = ["banana", "bandana", "ananas", "nabana", "ab"]
    index = variants.WordIndex([np.array([ord(c) - 95 for c in w], np.int32) for w in words], 30)
    text = "$" + "$".join(words) + "$"
    for p in ("a", "na", "ana", "$ban", "a$", "$ab$", "zz", "anana"):
        low, high, mirror = np.array([0]), np.array([index.size]), np.array([0])
        for c in p[::-1]:
            low, high, mirror = index.extended_left(np.array([1 if c == "$" else ord(c) - 95]), low, high, mirror)
        back = text[::-1]
        hits = [i for i in range(len(back)) if back.startswith(p[::-1], i)]
        assert high[0] - low[0] == len(hits)
        if hits:
            assert sorted(index.order[mirror[0] : mirror[0] + len(hits)]) == hits


@pytest.mark.parametrize("group,symbols", [(variants.GROUP, variants.SYMBOLS), (7, variants.SYMBOLS), (50, 200)])
def test_near_words_by_brute_force(spark, group, symbols):
    n = made(1)
    got = variants.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), group, symbols).collect()
    want = near(n)
    assert len(got) == len({(r.word, r.near) for r in got})
    assert {(r.word, r.near, r.near_n) for r in got} == {(w, v, n[v]) for w in want for v in want[w]}


def test_forms_and_roots(spark):
    n = made(2)
    chain = {"word" + "z" * i: 3 * 2**i for i in range(1, 20)}
    n |= chain
    got = sorted(tuple(r) for r in variants.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect())
    assert got == brute(n)
    assert {r[2] for r in got if r[0] in chain} == {"word" + "z" * 19}


def test_odd_texts(spark):
    texts = [*ODD, "Élan élan ÉLAN elan" * 3, "naïve naïve×naïve nave naive", "colour Colour COLOUR color color color colour's", None, "colour " * 200_000, "a" * 2_000_000] * 3
    docs = frame(spark, texts).unionByName(frame(spark, ["colour colour", "colour colour"], 1)).selectExpr("nullif(doc_id, 0) doc_id", "text", "lang", "path as `a.b`", "score n")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.word: r.n for r in variants.vocabulary(docs).collect()}
    assert got == counts(rows)
    assert variants.spelling_variants(variants.vocabulary(empty(spark))).collect() == []


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op13_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == brute(counts(rows)) and any(r[1] for r in got)
