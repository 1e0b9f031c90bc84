"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans: the base rules of each kind, and wider forms (numbers in
groups, addresses spelt out).  Boosted trees score every other proposal from its format and its context;
they learn what validated spans look like against the proposals that fail validation, on a bounded sample of
documents.  The labels do not restate the base rules: positives are the wide forms of validated spans (a phone
number without + and country code, an address with (at) and (dot), a card or an IP address with other separators), as they
stand in their texts and after a cue word; negatives are proposals that touch no base span and follow no cue, and
sentences that look like a spelt-out address.  Thresholds are calibrated per kind on a held-out part of the sample; proposals over the
threshold that touch no base span are added, best score first.  Base spans always stay.

Null and empty texts have no spans; positions are code points, ends exclusive.  With no sample of both
outcomes no span is added.  Texts of any length are read whole; repeated rows each have their spans; columns named like
the results are replaced.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.llm.common import lean, numbered

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS, TREES, DEPTH = 6000, 40, 3
#: Spans of one text that give lessons, of each sort.
PER_TEXT = 200

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_NUMBERS = re.compile(r"[+(]?[0-9][0-9().\x20/-]{5,}(?<=[0-9])")
_GROUP = re.compile(r"[0-9]+")
_SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{1,63}){1,6}", re.I)
_HINT = re.compile(r"tel|phone|call|mobil|fax|card|visa|credit|mail|contact|account|ssn|iban|\bip\b|server|host", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(x: str) -> str:
    return "".join(c for c in x if "0" <= c <= "9")


def _emails(text: str):
    """An address must hold an @: its local part is the run before it, so only the surroundings of each @ are read."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the base rules: leftmost, non-overlapping within a kind."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _stretches(text: str):
    """Runs of numbers; of a run longer than one number can be, each stretch of groups of 7 to 19 digits."""
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() <= 40:
            yield m.start(), m.end()
            continue
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (a, _) in enumerate(groups):
            n = 0
            for c, b in groups[i : i + 19]:
                n += b - c
                if n > 19 or b - a > 40:
                    break
                if n >= 7:
                    yield a - (a > m.start() and text[a - 1] in "+("), b


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the wide generators; they may overlap."""
    found = []
    for a, b in _stretches(text):
        x = text[a:b]
        n = len(_digits(x))
        if n < 7:
            continue
        if x.count(".") == 3:
            found.append((a, 1, b))
        if 12 <= n <= 19:
            found.append((a, 2, b))
        if n <= 15:
            found.append((a, 3, b))
    if "at)" in text or "at]" in text or "at}" in text or "AT)" in text or "AT]" in text:
        found += [(m.start(), 0, m.end()) for m in _SPELT.finditer(text)]
    return found


def _wide(kind: int, x: str) -> list[str]:
    """Forms of a validated span that the base rules do not know."""
    if kind == 0:
        local, _, domain = x.partition("@")
        return [f"{local} {at} {domain.replace('.', dot)}" for at, dot in (("(at)", " (dot) "), ("[at]", " [dot] "), ("{at}", "{dot}"), ("(at)", "."))]
    if kind == 1:
        return [x.replace(".", ". "), x.replace(".", " . ")]
    if kind == 2:
        d = _digits(x)
        return [s.join(d[i : i + 4] for i in range(0, len(d), 4)) for s in ("/", ". ")]
    rest = re.sub(r"^\+[0-9]{1,3}[\x20.-]*(?=[0-9(])", "", x) if re.match(r"\+[0-9]{1,3}[\x20.(-]", x) else x[1:]
    d = _digits(rest)
    return [rest] + ([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"] if len(d) == 10 else [])


def _some(spans: list[tuple], most: int) -> list[tuple]:
    """The spans, in order; of more than `most` those least by a hash of their places, which are spread over the text."""
    if len(spans) <= most:
        return spans
    return sorted(heapq.nsmallest(most, spans, key=lambda s: (zlib.crc32(b"%d:%d" % (s[0], s[2])), s)))


def lessons(text: str, most: int = PER_TEXT) -> list[tuple[list[float], bool]]:
    """Described proposals of one text and whether they are personal data, from `most` of its base spans and of its other proposals at most."""
    base, out = base_spans(text), []
    taken = Taken(base)
    # after a cue it may well be personal data: no lesson
    others = [p for p in proposals(text) if not taken.meets(p) and not _CUES[p[1]].search(text[max(0, p[0] - 24) : p[0]])]
    out += [(describe(text, p), False) for p in _some(others, most)]
    base = _some(base, most)
    for a, kind, b in base:
        for form in _wide(kind, text[a:b]):
            for cue in ("", _SAID[kind]):
                before = text[max(0, a - 40) : a] + cue
                made, end = before + form + text[b : b + 40], len(before) + len(form)
                out += [(describe(made, p), True) for p in proposals(made) if p[1] == kind and p[0] < end and p[2] > len(before) and not Taken(base_spans(made)).meets(p)]
        if kind == 0:  # "meet (at) noon. Then" is a sentence
            before = text[max(0, a - 40) : a]
            made = before + text[a:b].replace("@", " (at) ").replace(".", ". ") + text[b : b + 40]
            out += [(describe(made, p), False) for p in proposals(made) if p[1] == 0 and p[2] > len(before)]
    return out


def describe(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of a span; none of the validations that define the base rules."""
    a, kind, b = span
    x = text[a:b]
    groups = re.findall(r"[0-9]+", x)
    n = sum(map(len, groups))
    before, after = text[max(0, a - 24) : a], text[b : b + 12]
    sizes = [len(g) for g in groups] or [0]
    return [
        x.count(". "), kind, b - a, n, len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], n / (b - a),
        x.count(" "), x.count("-"), x.count("."), x.count("("), x.count(")"), x.count("/"), x.startswith("+"), x.startswith("("), x.startswith("0"),
        len(set(x)), max([int(g) if len(g) < 9 else 10**9 for g in groups], default=0), sum(c.isalpha() for c in x),
        before[-1:].isalnum(), before[-1:].isspace(), after[:1].isalnum(), after[:1].isspace(), after[:1] in ".,;:)", bool(_HINT.search(before)), sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
    ]


#: What announces each kind, and the words that a lesson puts before a form.
_CUES = [re.compile(c, re.I) for c in (r"mail|contact|write", r"\bip\b|server|host|address", r"card|visa|credit|account", r"tel|phone|call|mobil|fax|contact|dial|reach")]
_SAID = ["mail ", "server ", "card ", "call "]


class Boosted:
    """Gradient-boosted trees for a yes or no, on binned features, by second-order gains."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.2, bins: int = 32, least: float = 2.0):
        self.rate, self.trees = rate, []
        self.start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        coded = np.stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T)], 1)
        margin = np.full(len(y), self.start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(coded, cuts, p - y, p * (1 - p), np.arange(len(y)), depth, least)
            self.trees.append(tree)
            margin += rate * self._walk(tree, x)

    def _grow(self, coded, cuts, g, h, rows, depth, least):
        G, H = g[rows].sum(), h[rows].sum()
        leaf = -G / (H + 1)
        if not depth or len(rows) < 4:
            return leaf
        best = (1e-6, None)
        for f, q in enumerate(cuts):
            if not len(q):
                continue
            gl = np.cumsum(np.bincount(coded[rows, f], g[rows], len(q) + 1))[:-1]
            hl = np.cumsum(np.bincount(coded[rows, f], h[rows], len(q) + 1))[:-1]
            gain = np.where((hl * 4 >= least) & ((H - hl) * 4 >= least), gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1), 0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (f, i))
        if best[1] is None:
            return leaf
        f, i = best[1]
        left = coded[rows, f] <= i
        return (f, cuts[f][i], self._grow(coded, cuts, g, h, rows[left], depth - 1, least), self._grow(coded, cuts, g, h, rows[~left], depth - 1, least))

    def _walk(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, cut, a, b = tree
        left = x[:, f] <= cut
        out = np.empty(len(x))
        out[left], out[~left] = self._walk(a, x[left]), self._walk(b, x[~left])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        for t in self.trees:
            margin += self.rate * self._walk(t, x)
        return 1 / (1 + np.exp(-margin))


class Taken:
    """Spans in order of start, and the furthest end so far: whether another span overlaps one of them is one search."""

    def __init__(self, spans: list[tuple]):
        self.starts = [s[0] for s in spans]
        self.ends = list(accumulate((s[2] for s in spans), max))

    def meets(self, span: tuple) -> bool:
        i = bisect_left(self.starts, span[2])
        return i > 0 and self.ends[i - 1] > span[0]

    def add(self, span: tuple) -> None:
        """A span that meets none."""
        i = bisect_left(self.starts, span[0])
        self.starts.insert(i, span[0])
        self.ends.insert(i, span[2])


class Finder:
    """The trees and a threshold for each kind (2: nothing passes)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, precision: float = 0.95, most: int = 20_000):
        self.model, self.thresholds = None, [2.0] * len(KINDS)
        x, y = x[:most], y[:most]
        fold = np.arange(len(y)) % 3 == 2
        if len(y) < 30 or min(y[~fold].sum(), (1 - y[~fold]).sum()) < 5:
            return
        self.model = Boosted(x[~fold], y[~fold])
        s = self.model.score(x[fold])
        for kind in range(len(KINDS)):
            own = x[fold][:, 1] == kind
            by = np.argsort(-s[own], kind="stable")
            good = np.cumsum(y[fold][own][by]) / np.arange(1, own.sum() + 1)
            ok = np.flatnonzero(good >= precision)
            if len(ok) and y[fold][own].sum() >= 5:
                self.thresholds[kind] = max(0.5, float(s[own][by][ok[-1]]))

    def find(self, text: str) -> tuple[list[tuple], list[tuple]]:
        """Base spans; added spans."""
        base = base_spans(text)
        if self.model is None:
            return base, []
        taken = Taken(base)
        more = [p for p in proposals(text) if not taken.meets(p)]
        if not more:
            return base, []
        s = self.model.score(np.array([describe(text, p) for p in more], float))
        added, own = [], Taken([])
        for i in np.argsort(-s, kind="stable"):
            if s[i] >= self.thresholds[more[i][1]] and not own.meets(more[i]):
                added.append(more[i])
                own.add(more[i])
        return base, sorted(added)


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Finder:
    """A finder from a sample of at most `train_docs` texts that hold a proposal, in hash order."""

    def load(batches):
        for b in lean(batches):
            rows = [(h, [float(v) for v in x], y) for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for x, y in lessons(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.bool_())], ["h", "x", "y"])

    n = docs.count()
    span = 1 << 30
    reach = span if n <= train_docs else int(span * train_docs / n)
    h = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    rows = docs.filter(h < reach).select(h.alias("h"), F.col("text").cast("string")).mapInArrow(load, "h long, x array<double>, y boolean").orderBy("h", "x", "y").limit(20_000).toPandas()
    if not len(rows):
        return Finder(np.empty((0, 1)), np.empty(0))
    x, y = np.array(rows.x.tolist()), rows.y.to_numpy().astype(float)
    by = np.lexsort([*x.T, y])  # the order of rows is not the same from run to run
    by = by[np.random.default_rng(11).permutation(len(by))]
    return Finder(x[by], y[by])


def detect(docs: DataFrame, finder: Finder) -> DataFrame:
    """docs with base and added: arrays of (start, rank, end) in order."""
    keep = [c for c in docs.columns if c not in ("base", "added")]
    at = keep.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(finder)  # a few hundred numbers
    kind = T.ArrayType(T.StructType([T.StructField(x, T.IntegerType()) for x in ("start", "rank", "end")]))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("base", kind).add("added", kind)
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in lean(batches):
            both = [shared.value.find(t) if t else ([], []) for t in b.column(at).to_pylist()]
            cols = [pa.array([[{"start": s, "rank": k, "end": e} for s, k, e in x[i]] for x in both], arrow) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], schema.names)

    return numbered(docs.select(*[F.col(f"`{c}`") for c in keep])).mapInArrow(run, schema)


def redact(text: str, spans: list[tuple]) -> str:
    """text with each span replaced by [KIND]; of overlapping spans the first, then the longest."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, finder: Finder) -> DataFrame:
    """docs with the found spans of text replaced; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(finder)
    cols, schema = docs.columns, docs.schema
    at = cols.index("text")

    def run(batches):
        for b in lean(batches):
            texts = [t if not t else redact(t, sum(shared.value.find(t), [])) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)], cols)

    return numbered(docs).mapInArrow(run, schema)
