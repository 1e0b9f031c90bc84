"""Quality classifier: attention-based multiple-instance learning over passages.

Every passage of a text (`PASSAGE` bytes, the whole text in a row) is encoded into format features: shares
of character classes, of pairs of classes, hashed words, and how much of it repeats.  A gated attention
network learns, from labels of documents only, what to weigh: with z = tanh(W x), a passage's weight is
softmax(w . (tanh(V z) * sigmoid(U z))), and the weighted sum of z is scored by a logistic output.

Training uses at most `train_docs` labelled documents in hash order, and of each at most PASSAGES passages, spread evenly
over the text; features are computed where the documents are, the fit runs on the driver over that bounded sample.
Scores use every passage.

Null, empty and word-free texts: one passage without features, scored like any other.  Repeated rows of a labelled document
count once in training and are each scored; different texts under one doc_id are all lessons of its label.  Without both labels
in the sample, every score is the share of label 1 (0.5 if there are none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import PIECE, lean, numbered, slices, utf8, word_hashes

PASSAGE, TRAIN_DOCS, PASSAGES = 640, 3000, 48
HIDDEN, GATE, HASHED = 24, 16, 64

#: Class of each byte: ASCII punctuation one by one; then digit, upper, lower, space, line end, other.
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASSES = len(_SIGNS) + 6
_CLASS = np.full(256, CLASSES - 1, np.uint8)
for _i, _c in enumerate(_SIGNS):
    _CLASS[_c] = _i
_CLASS[48:58] = CLASSES - 6
_CLASS[65:91] = CLASSES - 5
_CLASS[97:123] = CLASSES - 4
_CLASS[[32, 9]] = CLASSES - 3
_CLASS[[10, 13]] = CLASSES - 2
_COARSE = np.concatenate([np.zeros(len(_SIGNS), np.uint8), np.arange(1, 7, dtype=np.uint8)])[_CLASS]
FEATURES = CLASSES + 49 + HASHED + 4


def features(texts: pa.Array, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Passages' features (float32) and each row's first passage."""
    data, offsets = utf8(texts)
    out, counts = [], []
    words = word_hashes(data, offsets, PIECE)
    for a, b, hashes, at in words:
        text, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        n = np.maximum(1, -(-np.diff(own) // passage))
        first = np.concatenate(([0], np.cumsum(n)))
        m = int(first[-1])
        row = np.repeat(np.arange(b - a), np.diff(own))
        where = first[row] + (np.arange(len(text)) - own[row]) // passage
        x = np.zeros((m, FEATURES), np.float32)
        size = np.maximum(1, np.bincount(where, minlength=m))[:, None]
        x[:, :CLASSES] = np.bincount(where * CLASSES + _CLASS[text], minlength=m * CLASSES).reshape(m, -1) / size
        c = _COARSE[text].astype(np.int64)
        x[:, CLASSES : CLASSES + 49] = np.bincount((where[1:] * 49 + c[:-1] * 7 + c[1:])[row[1:] == row[:-1]], minlength=m * 49).reshape(m, -1) / size
        # words: spread over a text's passages by rank (their places follow closely)
        k = np.diff(at)
        of = np.repeat(np.arange(b - a), k)
        rank = np.arange(len(hashes)) - at[:-1][of]
        place = first[of] + rank * n[of] // np.maximum(1, k[of])
        each = np.maximum(1, np.bincount(place, minlength=m))[:, None]
        x[:, CLASSES + 49 : CLASSES + 49 + HASHED] = np.bincount(place * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64), minlength=m * HASHED).reshape(m, -1) / each
        # repetition: share of a text's words that are new, of its word pairs that are new; mean word length; size
        fresh, pairs = np.ones(b - a), np.ones(b - a)
        for i in np.flatnonzero(k > 1):
            own_words = np.sort(hashes[at[i] : at[i + 1]])
            fresh[i] = (1 + np.count_nonzero(own_words[1:] != own_words[:-1])) / len(own_words)
            two = np.sort(hashes[at[i] : at[i + 1] - 1] * np.uint64(3) + hashes[at[i] + 1 : at[i + 1]])
            pairs[i] = (1 + np.count_nonzero(two[1:] != two[:-1])) / len(two)
        doc = np.repeat(np.arange(b - a), n)
        x[:, -4], x[:, -3] = fresh[doc], pairs[doc]
        x[:, -2] = np.minimum(4, np.log1p(size[:, 0] / each[:, 0]))
        x[:, -1] = np.minimum(2, np.log1p(k[doc]) / 6)
        out.append(x)
        counts.append(n)
    counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
    return np.concatenate(out) if out else np.empty((0, FEATURES), np.float32), np.concatenate(([0], np.cumsum(counts)))


class GatedAttention:
    def __init__(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, seed: int = 7):
        self.share = float(y.mean()) if len(y) else 0.5
        self.fitted = len(np.unique(y)) > 1
        if not self.fitted:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = self._scaled(x)
        r = np.random.default_rng(seed)
        shapes = {"W": (FEATURES, HIDDEN), "c": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "o": (HIDDEN,), "b": (1,)}
        p = self.p = {k: (r.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else r.normal(0, 0.1, s) * (k in "wo")).astype(np.float32) for k, s in shapes.items()}
        m, v, t = {k: 0 * a for k, a in p.items()}, {k: 0 * a for k, a in p.items()}, 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                own = order[i : i + batch]
                n = np.diff(first)[own]
                rows = np.concatenate([np.arange(first[j], first[j + 1]) for j in own])
                t += 1
                for k, g in self._gradients(x[rows], np.concatenate(([0], np.cumsum(n))), y[own]).items():
                    g = g + 1e-4 * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.scale, -5, 5).astype(np.float32)

    def _forward(self, x, first):
        p = self.p
        z = np.tanh(x @ p["W"] + p["c"])
        tv, su = np.tanh(z @ p["V"]), 1 / (1 + np.exp(-(z @ p["U"])))
        e = np.exp(np.clip((tv * su) @ p["w"], -30, 30))
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        a = e / np.add.reduceat(e, first[:-1])[doc]
        rep = np.add.reduceat(a[:, None] * z, first[:-1], axis=0)
        s = 1 / (1 + np.exp(-np.clip(rep @ p["o"] + p["b"][0], -30, 30)))
        return z, tv, su, a, doc, rep, s

    def _gradients(self, x, first, y):
        p = self.p
        z, tv, su, a, doc, rep, s = self._forward(x, first)
        ds = ((s - y) / len(y)).astype(np.float32)
        drep = ds[:, None] * p["o"]
        dz = a[:, None] * drep[doc]
        da = (drep[doc] * z).sum(1)
        dl = a * (da - np.add.reduceat(a * da, first[:-1])[doc])
        dgate = dl[:, None] * p["w"]
        dv, du = dgate * su * (1 - tv * tv), dgate * tv * su * (1 - su)
        dz = dz + dv @ p["V"].T + du @ p["U"].T
        dh = dz * (1 - z * z)
        return {"W": x.T @ dh, "c": dh.sum(0), "V": z.T @ dv, "U": z.T @ du, "w": (tv * su).T @ dl, "o": rep.T @ ds, "b": ds.sum(keepdims=True)}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        if not self.fitted:
            return np.full(n, self.share)
        return self._forward(self._scaled(x), first)[-1].astype(float) if n else np.empty(0)


def _labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, label and text of at most `most` labelled documents, in hash order."""
    own = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = own.count()
    span = 1 << 30
    reach = span if n <= most else int(span * min(1.0, 1.2 * most / n + 1e-6))
    chosen = own.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(span))).filter(F.col("h") < reach).orderBy("h", "doc_id").limit(most)
    return docs.join(F.broadcast(chosen), "doc_id")  # at most `most` rows of two numbers


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> GatedAttention:
    """A model from docs(doc_id, text) and labels(doc_id, label of 0 or 1); of several texts under one doc_id it learns from one."""

    def load(batches):
        for b in batches:
            x, first = features(b.column(2))
            own = [x[np.unique(np.linspace(i, j - 1, min(PASSAGES, j - i)).astype(int))] for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(o) for o in own], pa.int32()), pa.array([o.tobytes() for o in own], pa.binary())], ["doc_id", "label", "n", "x"])

    rows = _labelled(docs.select("doc_id", "text"), labels, train_docs).select(F.col("doc_id").cast("long"), F.col("label").cast("int"), F.col("text").cast("string")).mapInArrow(load, "doc_id long, label int, n int, x binary")
    # one row a document, merged before it leaves its task: a doc_id of very many rows brings one to the driver
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("x", "label", "n")).alias("r")).select("doc_id", "r.*").toPandas().sort_values("doc_id")
    x = np.concatenate([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows.x]) if len(rows) else np.empty((0, FEATURES), np.float32)
    return GatedAttention(x, np.concatenate(([0], np.cumsum(rows.n.to_numpy(np.int64)))), (rows.label.to_numpy() > 0).astype(np.float32))


def score(docs: DataFrame, model: GatedAttention, name: str = "score") -> DataFrame:
    """docs with the score (0 to 1) of column text."""
    keep = [c for c in docs.columns if c != name]
    at = keep.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(name, "double")

    def run(batches):
        for b in lean(batches):
            _, offsets = utf8(b.column(at))
            made = [shared.value.score(*features(b.column(at).slice(i, j - i))) for i, j in slices(offsets)]  # about 50 bytes of features a byte of text
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(made) if made else [], pa.float64())], schema.names)

    return numbered(docs.select(*[F.col(f"`{c}`") for c in keep])).mapInArrow(run, schema)
