"""Operators of the llm subpackage against plain versions, on small tables with every odd case."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from reelspan.llm import bpe, common, decontam, fingerprint, html, jaccard, langid, lm, pii, quality, secrets
from tests.llm import brute

import public_tokenizers as P

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("path", T.StringType()), T.StructField("score", T.IntegerType())])
ODD = [
    None, "", " \t\n ", "a", "one two", "Ünï çødé — 漢字仮名 \U0001f600", "x" * 3000, "the quick brown fox jumps over the lazy dog " * 60,
    "mail a.b@c.de, x@y..z@w.com and @nobody 10.0.0.1 999.1.1.1 4111 1111 1111 1111 +1 (555) 555-0199", "Password=abc123 token: token: abcdefgh api_key='Zz9+/=' AKIA" + "A1" * 9 + " " + "0a" * 15,
    "a b c\x1cd\x85e", "line\r\nline\n\nline",
]


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "p", 1) for i, t in enumerate(texts)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def sample(n=60, seed=1):
    r = random.Random(seed)
    base = [" ".join(f"w{r.randrange(400)}" for _ in range(r.choice([3, 12, 40, 120]))) for _ in range(n // 3)]
    out = []
    for t in base:
        w = t.split()
        for edits in (0, 1, 4):
            v = list(w)
            for _ in range(edits):
                v[r.randrange(len(v))] = f"z{r.randrange(9999)}"
            out.append(" ".join(v))
    return out


def test_word_hashes_follow_words(spark):
    import pyarrow as pa

    texts = [*ODD, "B a\x0bA b", "b A\x0ca B"]
    data, offsets = common.utf8(pa.array(texts))
    for most in (1 << 20, 7):
        got = []
        for a, b, h, at in common.word_hashes(data, offsets, most):
            got += [h[at[i] : at[i + 1]].tolist() for i in range(b - a)]
        assert [len(g) for g in got] == [len(brute.words(t)) for t in texts]
        seen = {}
        for g, t in zip(got, texts):
            for h, w in zip(g, brute.words(t)):
                assert seen.setdefault(h, w) == w
        assert len(seen) == len({w for t in texts for w in brute.words(t)})


def test_pii_base_spans():
    for t in [*ODD, "a@b@c.d e", "a@b.c_x@d.e", "1-2-3", "+12 345 678 9012345 6 7", "1.2.3.4.5.6.7.8", "٣٤ 4-111111111111111"]:
        assert pii.base_spans(t or "") == brute.pii(t)


def test_pii_query(spark):
    docs = frame(spark, ODD)
    finder = pii.train(docs)
    rows = {r.doc_id: r for r in pii.detect(docs, finder).collect()}
    assert len(rows) == len(ODD)
    for i, t in enumerate(ODD):
        assert [tuple(s) for s in rows[i].base] == brute.pii(t)
    assert pii.detect(empty(spark), pii.train(empty(spark))).count() == 0
    assert pii.redacted(docs, finder).filter("doc_id = 8").first().text.startswith("mail [EMAIL], x@[EMAIL] and")
    assert pii.redacted(docs, finder).filter("text is null").count() == 1


def test_pii_adds_forms_beyond_the_base_rules(spark):
    r = random.Random(6)
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    texts = [f"{words(6)} +1 ({n(3)}) 555-{n(4)} {words(5)} {words(1)}.{n(2)}@mail{n(1)}.example.com {words(4)} {n(16)} {words(3)} {n(20)}" for _ in range(150)]
    probes = ["please call (555) 123-4567 today", "write to a (at) b (dot) com now", "we meet (at) noon. Then we go", f"{words(4)} {'9' * 16} {words(3)}"]
    docs = frame(spark, texts)
    finder = pii.train(docs)
    assert [t[a:b] for t in probes for a, _, b in finder.find(t)[1]] == ["(555) 123-4567", "a (at) b (dot) com"]
    got = pii.redacted(frame(spark, probes), finder).orderBy("doc_id").collect()
    assert [x.text for x in got] == ["please call [PHONE] today", "write to [EMAIL] now", *probes[2:]]
    assert pii.train(docs.repartition(3)).thresholds == finder.thresholds


def test_pii_overlaps_and_long_runs():
    r = random.Random(3)
    for _ in range(60):
        spans = sorted((a := r.randrange(60), r.randrange(4), a + r.randrange(1, 9)) for _ in range(r.randrange(12)))
        taken = pii.Taken(spans)
        for _ in range(20):
            a = r.randrange(60)
            p = (a, 0, a + r.randrange(1, 9))
            assert taken.meets(p) == any(p[0] < s[2] and s[0] < p[2] for s in spans)
    run = " ".join(["555 123 4567"] * 8)
    found = pii.proposals(run)
    assert {(12 * i + i, 3, 13 * i + 12) for i in range(8)} <= set(found) and (0, 3, 12) in found


def test_boosting_separates():
    r = np.random.default_rng(0)
    x = r.normal(size=(400, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    s = pii.Boosted(x[:300], y[:300]).score(x[300:])
    assert ((s > 0.5) == (y[300:] > 0)).mean() > 0.93


def test_secrets(spark):
    texts = [*ODD, "Secret: " + "k" * 6, "passwd=short", "-----BEGIN RSA PRIVATE KEY-----", "é token=abcdef é token=ghijkl"]
    rows = {r.doc_id: r.spans for r in secrets.scan(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert [(s.start, s.rank, s.end) for s in rows[i] if s.rank < 3] == brute.secrets(t)
    assert [s.kind for s in rows[len(ODD) + 2]] == ["pem"]
    assert secrets.scan(empty(spark)).count() == 0


def test_trigram_queries_follow_from_the_patterns():
    tri = lambda x: sorted({x[i : i + 3] for i in range(len(x) - 2)})
    want = {"assign": ("password", "passwd", "secret", "token", "api_key", "apikey"), "access": ("akia",), "hex": (), "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "slack": ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), "google": ("aiza",), "jwt": (".eyj",), "pem": ("private key-----",)}
    for r in secrets.RULES:
        assert sorted(secrets.trigram_query(r.pattern)) == sorted(map(tri, want[r.kind]))
    cases = {"abcd+e": ["abcd"], "ab(?:cd|ef)?g": ["abcdg", "abefg", "abg"], "a.bc": None, "[^a]bcd": ["bcd"], r"x\dabc": ["abc"], "abc|de": None, "abc|def": ["abc", "def"], "(ab)+c": ["abc"], "ab{3}cde": ["bcde"], r"\x41bc": ["abc"]}
    for pattern, words in cases.items():
        assert sorted(secrets.trigram_query(pattern)) == sorted(map(tri, words or [])), pattern


def test_trigram_index_equals_a_full_scan(spark):
    import re

    r = random.Random(12)
    rules = tuple(secrets.Rule(f"k{i}", p) for i, p in enumerate(["ab(?:ca|b)[ab]+", "[abc]{4}", "(?i:caba)[:=]?c", "bbb|cac", "aab?c"]))
    texts = [*ODD, *["".join(r.choice("abcABC:") for _ in range(r.randrange(0, 40))) for _ in range(150)]]
    texts += texts[20:40]
    rows = secrets.scan(frame(spark, texts), rules).collect()
    assert len(rows) == len(texts)
    for x in rows:
        want = [(m.start(), i, m.end()) for i, rule in enumerate(rules) for m in re.finditer(rule.pattern, texts[x.doc_id] or "")]
        assert [(s.start, s.rank, s.end) for s in x.spans] == sorted(want)
    index = secrets.postings(frame(spark, ["abcab", "xbca", None]).selectExpr("doc_id row", "coalesce(text, '') text"), ["abc", "bca", "zzz"])
    assert sorted(map(tuple, index.collect())) == [("abc", 0), ("bca", 0), ("bca", 1)]
    assert {tuple(x) for x in secrets.candidates(index, {7: [["abc", "bca"]], 8: [["zzz"], ["bca"]]}).selectExpr("row", "explode(rules)").collect()} == {(0, 7), (0, 8), (1, 8)}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, k, percent):
    texts = [*ODD, *sample(90), *ODD[:5], *["same old text of some ten words in a row here"] * 7]
    got = sorted(map(tuple, jaccard.ngram_jaccard_join(frame(spark, texts), k, percent).collect()))
    assert got == sorted(brute.components(list(enumerate(texts)), k, percent))


def test_jaccard_large_group_and_empty(spark):
    r = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(150):  # near copies, linked by chains too
        v = list(base)
        v[r.randrange(60)] = f"q{r.randrange(10**6)}"
        texts.append(" ".join(v))
    got = sorted(map(tuple, jaccard.ngram_jaccard_join(frame(spark, texts), 3, 90).collect()))
    assert got == sorted(brute.components(list(enumerate(texts)), 3, 90))
    assert jaccard.ngram_jaccard_join(empty(spark), 3, 90).count() == 0


def test_jaccard_group_without_a_common_middle(spark):
    r = random.Random(8)
    base, pool, texts = [f"w{i}" for i in range(80)], [(r.randrange(80), f"p{i}") for i in range(8)], []
    for _ in range(260):  # own edits, edits that several share, and cut beginnings: some link by chains only
        v = list(base)
        for _ in range(r.choice([0, 1, 2, 3])):
            v[r.randrange(80)] = f"q{r.randrange(10**6)}"
        for _ in range(r.choice([0, 1, 2, 3])):
            at, word = r.choice(pool)
            v[at] = word
        texts.append(" ".join(v[r.choice([0, 0, 0, 3, 6]) :]))
    want = sorted(brute.components(list(enumerate(texts)), 3, 90))
    assert 5 < len({c for _, _, c in want}) < 200
    assert sorted(map(tuple, jaccard.ngram_jaccard_join(frame(spark, texts), 3, 90).collect())) == want


def test_bpe_equals_library(spark):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Codec(ranks, P.PATTERN, memo=50)
    r = random.Random(5)
    texts = [*[t or "" for t in ODD], *["".join(r.choice("abc AB'1.é漢\n\t \U0001f600<|endoftext|>") for _ in range(200)) for _ in range(40)]]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t)
        assert own.decode(ids) == t.encode()
    assert all(own.whole.get(k) == v for k, v in list(ranks.items())[::97])
    assert own.whole.get(b"no such entry") == -1
    docs = frame(spark, ODD)
    for x in bpe.round_trip(docs, path, P.PATTERN).collect():
        t = x.text or ""
        ids = np.array(enc.encode_ordinary(t), "<u4").tobytes()
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    back = bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN)
    assert all(bytes(x.decoded).decode() == (x.text or "") for x in back.collect())
    assert bpe.round_trip(empty(spark), path, P.PATTERN).count() == 0


def test_order_minhash(spark):
    texts = [*ODD, *sample(30)]
    out = {r.doc_id: r for r in fingerprint.order_minhash(frame(spark, texts)).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        a, b = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        mine = fingerprint.sketch(fingerprint._points(a))
        other = fingerprint.sketch(fingerprint._points(edited))
        assert out[i].n_chars == len(a)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i].fingerprint == (mine.astype(">u8").tobytes().hex() if a else "")
        assert out[i].near_edited == pytest.approx(fingerprint.likeness(mine, other))
        assert out[i].near_next == pytest.approx(fingerprint.likeness(mine, fingerprint.sketch(fingerprint._points(b))))
    assert fingerprint.order_minhash(empty(spark)).count() == 0
    lone = fingerprint.order_minhash(frame(spark, ["alone in here"])).collect()
    assert lone[0].near_next == 1.0


def test_order_minhash_sees_order():
    r = random.Random(2)
    w = [f"word{r.randrange(99)}" for _ in range(200)]
    one, moved = " ".join(w), " ".join(w[100:] + w[:100])
    edited = " ".join(w[:50] + ["new"] + w[51:])
    s = lambda t: fingerprint.sketch(fingerprint._points(t))
    assert fingerprint.likeness(s(one), s(edited)) > 0.8
    assert fingerprint.likeness(s(one), s(moved)) < fingerprint.likeness(s(one), s(edited))
    long = "abcdefgh " * 4000
    assert fingerprint.likeness(s(long), s(long)) == 1.0


def test_parse_counts_phrases():
    r = random.Random(4)
    texts = {"x": "".join(r.choice("ab ") for _ in range(300)), "y": "".join(r.choice("bcdefgh ") for _ in range(300))}
    model = langid.Model(texts, symbols=7)  # y has more letters than symbols
    looks = [model.lookup(k) for k in range(2)]
    for probe in ("abcabc", "aaaaabbbb", "zzz", "b", "a!?b  cB", "hgfedcb" * 9, "zazbz"):
        points = langid._points(probe)
        got, size = model.phrases(looks, points, np.array([0, len(points)]), lane=1000)
        for k, name in enumerate(model.names):
            codes = langid.squeeze(looks[k][points])[0]
            own = langid.squeeze(looks[k][langid._points(texts[name])])[0].tobytes()
            # a phrase is the longest match from where the one before ended; a symbol that no phrase can begin with ends one, too
            n, at, left = 1, 0, codes.tobytes()
            while at < len(left):
                m = 0
                while at + m < len(left) and left[at : at + m + 1] in own:
                    m += 1
                at += m
                if at < len(left):
                    n += 1
                    at += left[at : at + 1] not in own
            assert (got[0, k], size[0]) == (n, len(codes))


def test_language_by_script():
    texts = {"el": "αβγδε ζηθ " * 60, "ja": "".join(chr(0x3040 + i % 80) + chr(0x4E00 + i * 7 % 900) for i in range(1500)), "zh": "".join(chr(0x4E00 + i * 11 % 2000) for i in range(3000)), "ru": "абвгде жзи " * 60}
    model = langid.Model(texts)
    looks = [model.lookup(k) for k in range(4)]
    for want, probe in (("el", "δεζη αβγ"), ("ru", "ЖЗИ абв"), ("ja", texts["ja"][300:340]), ("zh", texts["zh"][500:560])):
        points = langid._points(probe)
        cost, _ = model.phrases(looks, points, np.array([0, len(points)]))
        assert model.names[int((cost[0] * model.bits).argmin())] == want


def test_language_sample_takes_pieces_of_many_texts(spark):
    rows = [(i, "a" * 50_000 if i == 3 else f"text{i} " * 30, "xx") for i in range(400)] + [(1000, "only one " * 4000, "yy"), (1001, None, "yy"), (1002, "no language", None)]
    got = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(got) == {"xx", "yy"} and all(len(t) >= langid.TRAIN_CHARS for t in got.values())
    assert got["xx"].count("a" * 100) <= langid.PIECE / 100 and len(set(got["xx"].split())) > 50


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "lang", "text").withColumn("held_out", common.bucket_of("doc_id", 5) == 0)
    got = {r.doc_id: r for r in langid.identify(rows.select("doc_id", "held_out", "text"), rows.filter("not held_out")).collect()}
    truth = [r for r in rows.collect() if r.held_out]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in truth]) > 0.9
    odd = langid.identify(frame(spark, ODD).select("doc_id", "text"), rows).collect()
    assert [r.lang_pred for r in sorted(odd, key=lambda r: r.doc_id)][:3] == ["und"] * 3
    assert {r.lang_pred for r in langid.identify(frame(spark, ODD).select("doc_id", "text"), empty(spark)).collect()} == {"und"}


def test_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality label")
    train = labels.filter(common.bucket_of("doc_id", 4) != 2)
    got = {r.doc_id: r.score for r in quality.score(docs.select("doc_id", "text"), quality.train(docs, train)).collect()}
    held = [r for r in labels.collect() if brute.fold(r.doc_id, 4) == 2 and r.doc_id in got]
    assert np.mean([(got[r.doc_id] >= 0.7) == (r.label == 1) for r in held]) > 0.9
    odd = quality.score(frame(spark, ODD).drop("score"), quality.train(docs, train)).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.score(frame(spark, ODD), quality.train(empty(spark), empty(spark).selectExpr("doc_id", "score label"))).collect()} == {0.5}


def test_quality_features_are_of_one_text():
    texts = [t for t in ODD if t] + sample(12)
    x, first = quality.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert (quality.features(pa.array([t]))[0] == x[first[i] : first[i + 1]]).all()


def test_quality_learns_once_from_a_repeated_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").selectExpr("doc_id", "quality label")
    one = labels.orderBy("doc_id").first().doc_id
    hot = docs.union(docs).union(docs.filter(docs.doc_id == one).crossJoin(spark.range(300)).select("doc_id", "text"))
    a, b = quality.train(docs, labels), quality.train(hot.repartition(7), labels)
    assert a.fitted and all((a.p[k] == b.p[k]).all() for k in a.p)


def test_quality_gradients():
    r = np.random.default_rng(1)
    x, first, y = r.normal(size=(7, quality.FEATURES)).astype(np.float32), np.array([0, 3, 7]), np.array([1.0, 0.0], np.float32)
    m = quality.GatedAttention(x, first, y, epochs=1)
    loss = lambda: float(-np.mean(np.log(np.where(y > 0, (s := m._forward(x, first)[-1]), 1 - s))))
    g = m._gradients(x, first, y)
    for name in "WVUwo":
        at = tuple(0 for _ in m.p[name].shape)
        m.p[name] = m.p[name].astype(np.float64)
        m.p[name][at] += 1e-4
        up = loss()
        m.p[name][at] -= 2e-4
        down = loss()
        m.p[name][at] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(g[name][at], abs=2e-3)


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).union(frame(spark, ODD, 10**6).select("doc_id", "text"))
    rows = docs.withColumn("held_out", common.bucket_of("doc_id", 7) == 2)
    path = P.path("byte_bpe_50k.tiktoken")
    got = {r.doc_id: r for r in lm.score(rows.select("doc_id", "held_out", "text"), rows.filter("not held_out"), path, head=50).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts: dict = {}
    for d, t in texts.items():
        if brute.fold(d, 7) != 2:
            for w in [*brute.words(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert set(got) == set(texts)
    for d, t in texts.items():
        w = [*brute.words(t), None]
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.fold(d, 7) == 2, len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w))
        assert r.score < 0


def test_language_model_scores_each_id_once():
    pieces = lm.Pieces(P.path("byte_bpe_50k.tiktoken"))
    data = np.frombuffer("Hello  world\nthere".encode(), np.uint8)
    ids, at = pieces.ids(data, np.array([0, len(data)]))
    names = {i: k for size, (keys, own) in pieces.tables.items() for k, i in ((int(k).to_bytes(size, "little"), int(i)) for k, i in zip(keys, own))}
    assert b"".join(names[i] for i in ids[:-1].tolist()) == b" hello world there"
    r = np.random.default_rng(0)
    train = r.integers(0, 20, 3000).astype(np.int32)
    m = lm.Attention(train, np.array([0, 1000, 3000]), 21, dim=4, classes=6, steps=5, batch=8)
    # probabilities of one more id sum to one
    head = train[:11]
    scores = [m.score(np.append(head, np.int32(i)), np.array([0, 12]))[0] for i in range(21)]
    assert sum(10**s for s in scores) == pytest.approx(10 ** m.score(head, np.array([0, 11]))[0], rel=1e-3)


def test_language_model_gradients():
    r = np.random.default_rng(2)
    ids = r.integers(0, 9, 400).astype(np.int32)
    m = lm.Attention(ids, np.array([0, 150, 400]), 9, dim=4, classes=4, steps=300, batch=32, rate=0.02)
    cold = lm.Attention(ids, np.array([0, 150, 400]), 9, dim=4, classes=4, steps=0)
    at = np.array([0, 150, 400])
    assert m.score(ids, at).sum() > cold.score(ids, at).sum()


def test_language_model_learns_from_every_text(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    pieces = lm.Pieces(path)
    huge, small = "ab " * 450_000, "zebra quiz jumps"
    for texts in ([huge, small, None], [small, huge, None]):  # whichever comes first in hash order
        ids = np.concatenate([pieces.ids(*common.utf8(pa.array([t], pa.string())))[0] for t in texts])
        share = np.bincount(ids, minlength=pieces.n) / len(ids)
        _, model = lm.train_model(frame(spark, texts), path, steps=0)
        seen = np.flatnonzero(share)
        got = model.prior()[seen]
        assert got == pytest.approx(np.log(share[seen]), abs=0.15)
        counts, (x, y) = lm.gather(frame(spark, texts), pieces, rate=1, least=0, few=4)
        assert counts.tolist() == np.bincount(ids, minlength=pieces.n).tolist()
        assert (y[:, 0] >= 0).all() and len(x) == 4 + 1 + -(-len(pieces.ids(*common.utf8(pa.array([small], pa.string())))[0]) // lm.STRIDE)


def test_language_model_gradients_by_differences():
    r = np.random.default_rng(4)
    ids, at = r.integers(0, 9, 900).astype(np.int32), np.array([0, 1, 150, 900])
    m = lm.Attention(ids, at, 9, dim=4, classes=4, steps=30, batch=32)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    m.freeze()
    for long in (1, 6, 8):  # windows of a segment: alone, none and whole tiles
        g, n = m._gradients(m.segments(ids, at, long)[0])
        assert n == len(ids)
        for k, a in m.p.items():
            where = np.unravel_index(np.argmax(np.abs(g[k])), a.shape)
            loss = []
            for by in (1e-3, -2e-3):
                a[where] += by
                m.freeze()
                loss.append(-m.score(ids, at).sum() * np.log(10) / len(ids))
            a[where] += 1e-3
            m.freeze()
            assert (loss[0] - loss[1]) / 2e-3 == pytest.approx(g[k][where], rel=1e-3, abs=1e-6)


def test_language_model_work_of_an_id(monkeypatch):
    r = np.random.default_rng(6)
    ids, at = r.integers(0, 200, 4000).astype(np.int32), np.array([0, 4000])
    m = lm.Attention(ids, at, 201, dim=4, classes=40, steps=3, batch=8)
    m.score(ids, at)
    taken, exp = [0], np.exp

    def counted(x, *args, **kwargs):
        taken[0] += np.size(x)
        return exp(x, *args, **kwargs)

    monkeypatch.setattr(np, "exp", counted)
    m.score(ids, at)
    # of an id: its hidden layer and classes, and no attention, whose exponentials are made once for all pairs of ids
    assert taken[0] <= len(ids) * (2 * 4 + m.p["b"].size + m.wide) + m.bias.size


def test_language_model_sums_by_id():
    r = np.random.default_rng(7)
    for columns, kind in ((4, np.float32), (3, np.float32), (4, np.float64)):
        ids, rows = r.integers(0, 9, 50).astype(np.int16), r.normal(size=(50, columns)).astype(kind)
        want = [rows[ids == i].sum(0) for i in range(11)]
        assert lm._sums(ids, rows, 11) == pytest.approx(np.array(want), abs=1e-5)
    assert (lm._sums(ids[:0], rows[:0], 2) == 0).all()


def test_language_model_ids_by_longest_match():
    pieces = lm.Pieces(P.path("byte_bpe_50k.tiktoken"))
    names = {int(k).to_bytes(size, "little"): int(i) for size, (keys, own) in pieces.tables.items() for k, i in zip(keys, own)}
    r = np.random.default_rng(8)
    texts = [None, "", " \n", "x", "\0\0a\0", "  The caf\u00e9 \u6f22\u5b57\tand THE end "] + ["".join(r.choice(list("theand\u00e9\0 \n.1"), 40)) for _ in range(200)]
    ids, at = pieces.ids(*common.utf8(pa.array(texts, pa.string())))
    for k, text in enumerate(texts):
        want = []
        for word in brute.words(text):
            left = b" " + word.encode()
            while left:
                size = next(n for n in range(lm.LONGEST, 0, -1) if len(left) >= n and left[:n] in names)
                want.append(names[left[:size]])
                left = left[size:]
        assert ids[at[k] : at[k + 1]].tolist() == [*want, pieces.end]


def test_language_model_is_fitted_to_every_window(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    pieces = lm.Pieces(path)
    # what is said only far inside one of the texts, beyond the windows that a draw takes of each
    texts = ["the wind and the sea " * 40] * 20 + ["the wind and the sea " * 20_000 + "zebra quiz jumps over " * 8000, None, ""]
    train = frame(spark, texts)
    ids, at = pieces.ids(*common.utf8(pa.array(texts, pa.string())))
    counts, windows = lm.gather(train, pieces, least=100)
    assert len(windows[0]) < 400
    model = lm.Attention(ids[:0], np.zeros(1, np.int64), pieces.n, steps=50, counts=counts, windows=windows)
    far = pieces.ids(*common.utf8(pa.array(["zebra quiz jumps over " * 50], pa.string())))
    before = model.score(*far)[0]
    assert lm.fit(model, train, pieces, int(counts.sum())) == len(ids) == counts.sum()
    assert model.score(*far)[0] > before / 2
    # the order in which sums arrive doesn't matter
    again = [lm.train_model(frame(spark, sample(60)).repartition(3, "doc_id"), path, steps=5)[1].flat() for _ in range(2)]
    assert (again[0] == again[1]).all()


def test_language_model_windows_grow(spark):
    pieces = lm.Pieces(P.path("byte_bpe_50k.tiktoken"))
    sizes = [len(lm.gather(frame(spark, sample(n)), pieces, rate=4, least=0)[1][0]) for n in (300, 3000)]
    assert 5 * sizes[0] < sizes[1] < 20 * sizes[0]
    one, other = (lm.gather(frame(spark, sample(90)).repartition(n), pieces)[1] for n in (1, 3))
    assert one[0].tolist() == other[0].tolist() and one[1].tolist() == other[1].tolist()


def test_html(spark):
    rows = [(1, "http://h.example/a/1", "<html><body><nav><a href=/>Home</a></nav><div class='post-1'><h1>A &amp; B</h1><p>One  two,\n three, and more words to be sure.<p>Next <b>bold</b> text, long enough to count.<script>x('</p>')</script></div><div id=comments><p>Nice post</p></div><footer>(c)</footer>"),
            (2, "http://h.example/a/2", "<html><body><div class='post-2'><p>Some other article, with commas, and a fine length.</p><aside>side</aside><form>f</form></div><div class='cookie notice'>We use cookies</div></body></html>"),
            (3, None, None), (4, "x", ""), (5, "http://k.example", "no markup &lt;at all&gt;"), (6, "http://k.example", "<div")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(pages, html.winning_paths(pages)).collect()}
    assert got[1] == "A & B\nOne two, three, and more words to be sure.\nNext bold text, long enough to count."
    assert got[2] == "Some other article, with commas, and a fine length."
    assert (got[3], got[4], got[5]) == ("", "", "no markup <at all>")
    assert len(got) == 6


def test_html_host_votes_beat_a_page(spark):
    article = lambda i: f"<article class='post-{i}'><p>A fine article number {i}, with commas, and enough words to count.</p></article>"
    page = lambda i, more="": f"<html><body><div class='wrap'>{article(i)}</div><div class='teasers'>{more}</div></body></html>"
    teasers = "".join(f"<p>Teaser {k}, much longer than the article, with commas, and more, and more, and more.</p>" for k in range(9))
    rows = [(i, "http://h.example/x", page(i)) for i in range(6)] + [(9, "http://h.example/y", page(9, teasers)), (10, "http://lone.example", page(10, teasers))]
    pages = spark.createDataFrame([*rows, *rows[:2]], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(pages, html.winning_paths(pages)).collect()}
    assert got[9] == "A fine article number 9, with commas, and enough words to count."
    assert "Teaser" in got[10]  # nobody outvotes a lone page
    assert html.extract(pages, html.winning_paths(pages)).count() == 10
    assert html.extract(pages.limit(0), html.winning_paths(pages.limit(0))).count() == 0


def test_html_stray_quotes_and_depth():
    assert html.Page("""<body><p title="5" tall">Hello</p><p data-x=don't>World</p><p a = 'x>y' b="<i>">and <b c=d/>more</p></body>""").text(None) == "Hello\nWorld\nand more"
    deep = html.Page("<div>" * 5000 + "deep text" + "</div>" * 5000)
    assert deep.text(None) == "deep text" and len(deep.steps) == 5001


def test_decontamination(spark):
    item = "The train to Paris leaves with 120 people and travels 300 km in 4 hours before it meets the other one near the old bridge"
    other = item.replace("120", "75").replace("300 km", "210 km").replace("Paris", "Lyon")
    mixed = "Once upon a time " + item + " they said"
    far = "Some quite unrelated text that shares no run of words with any benchmark item whatsoever in this table"
    docs = frame(spark, [item, other, mixed, far, item[:60], None, "", "x y"])
    items = spark.createDataFrame([(1, item), (2, None), (3, "totally different question about the colour of the sky at night in winter")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()}
    assert got == {(0, 1), (1, 1), (2, 1)}
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.leaks(empty(spark), items).count() == 0


def test_decontamination_of_short_items_and_longer_slots(spark):
    item = "the train to Paris leaves with 120 people and travels 300 km in 4 hours today"
    docs = frame(spark, [f"so {item} they said", item.replace("Paris", "New York"), item.replace("300 km", "300"), item.replace("120 people", "120 kg people"), "we ask what is photosynthesis here", "we ask what is here", "it is 7 and 12 there", "what is photosynthesis"])
    items = spark.createDataFrame([(1, item), (2, "what is photosynthesis"), (3, "12"), (4, ""), (5, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (7, 2), (6, 3)}


def test_leaks_under_a_shared_or_missing_doc_id(spark):
    item = "Which of the following planets takes the longest time to turn once around its own axis in our system"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(7, f"before {item} after"), (7, "quite another text about the sea and its tides and what the wind does there"), (8, f"x {item}"), (8, f"x {item}"), (None, item), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, `a.b` string, own int")
    got = sorted((r.doc_id is None, r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect())
    assert got == [(False, 7, 1), (False, 8, 1), (True, None, 1)]
    assert decontam.leaks(docs.limit(0), items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0


def test_one_text_gives_a_bounded_number_of_lessons():
    many = " ".join(f"write a{i}@b.org or see 12.{i % 250}.7.9 and 55{i:07d} on 2024-01-{i % 28 + 1:02d}" for i in range(3000))
    few, all_of = pii.lessons(many, 20), pii.lessons(many[:4000], 10**9)
    assert 0 < len(few) <= 20 + 20 * 24 and {y for _, y in few} == {True, False}
    assert pii.lessons(many[:4000], 10**6) == all_of


def test_language_and_model_beside_any_columns(spark):
    schema = "doc_id long, held_out boolean, text string, score int, lang_pred string, `a.b` string, `x y` string, tail int, _row int, n_tokens string"
    docs = spark.createDataFrame([(i, False, t, 1, "p", "k", "z", 2, 3, "n") for i, t in enumerate(["the wind and the sea", "der Wind und das Meer", None, ""] * 3)], schema)
    train = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([("the wind and the sea and the boat", "en"), ("der Wind und das Meer und das Boot", "de")])], "doc_id long, text string, lang string")
    told = langid.identify(docs, train)
    assert told.columns == ["doc_id", "held_out", "a.b", "x y", "tail", "_row", "n_tokens", "lang_pred", "score"]
    rows = told.orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:3]] == ["en", "de", "und"] and all(r["a.b"] == "k" and r._row == 3 for r in rows)
    assert langid.identify(docs.limit(0), train).count() == 0 and langid.identify(docs, train.limit(0)).select("lang_pred").distinct().collect()[0][0] == "und"
    scored = lm.score(docs, train, P.path("byte_bpe_50k.tiktoken"))
    assert scored.columns == ["doc_id", "held_out", "lang_pred", "a.b", "x y", "tail", "_row", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = scored.orderBy("doc_id").collect()
    assert len(rows) == 12 and all(r["x y"] == "z" and r.tail == 2 and r._row == 3 for r in rows) and [r.n_tokens for r in rows[:4]] == [6, 6, 1, 1]


def test_html_keeps_what_only_looks_like_junk():
    page = """<body><div class="header">Site name</div><article><div class="header"><h1>Title of it</h1></div><p>Long text of the article.</p><p class="share-price">Share price rose.</p>
    <div class="share-buttons">Share</div><div id="cookie-banner-2">Cookies</div><div class="comment-list">First!</div><p class="search-history notice-period">Words.</p><div class="related posts">More</div></article><div class="site-footer">Foot</div></body>"""
    assert html.Page(page).text(None) == "Title of it\nLong text of the article.\nShare price rose.\nWords."


def test_secrets_of_a_text_with_very_many(spark):
    text = " ".join(f"token=abc{i:06d}x" for i in range(9000))
    (r,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(s.start, s.rank, s.end) for s in r.spans if s.kind in ("assign", "access", "hex")] == brute.secrets(text)


def _generated(spark) -> int:
    """Rows that all Generate nodes of the session have made so far."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    for i in range(runs.size()):
        of = runs.apply(i).executionId()
        nodes, values = store.planGraph(of).allNodes(), store.executionMetrics(of)
        for j in range(nodes.size()):
            metrics = nodes.apply(j).metrics()
            for k in range(metrics.size()):
                m = metrics.apply(k)
                if nodes.apply(j).name() == "Generate" and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return total


def test_entries_that_no_member_has_are_not_dealt(spark):
    """200 askers of 20 entries beside 20 members of 10: three entries shared do not link, six do."""
    members = [(1, 1000 + m, 1000, 100, [m * 10 + i for i in range(10)], False) for m in range(20)]
    askers = [(1, a, a, 100, [a % 20 * 10 + i for i in range(3)] + [10_000 + a * 100 + i for i in range(17)], True) for a in range(1, 201)]
    askers.append((1, 500, 500, 100, [70 + i for i in range(6)] + [90_000 + i for i in range(14)], True))
    rows = spark.createDataFrame(members + askers, "g long, a long, c long, n long, d array<long>, asks boolean")
    before = _generated(spark)
    assert {tuple(r) for r in jaccard.links_in_groups(rows, 80).collect()} == {(500, 1007)}
    assert _generated(spark) - before < 3000
