"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text yields, at every position, the longest match.  Only letters
count: other characters become one separator.  A text is
parsed into phrases: the longest prefix of the rest that occurs in the language's text, then again from
there.  The language that needs the fewest phrases, normalised by the logarithm of its automaton's text
length (phrases * log2(length) / characters, the cross-parsing entropy), wins.

The automaton is completed to a table: a missing transition counts a phrase and restarts at the root, so a
parse is one table look-up a character, and numpy walks many texts in step.  Texts are walked in lanes of
`lane` characters; a lane starts a new phrase.

Every language has an alphabet of its own: the frequent letters of its training text, one symbol for its rarer
ones, and one for letters that it does not hold, which end a phrase each.  So scripts tell languages apart, and
languages of many letters keep small tables.

Training text is a bounded sample: pieces of at most PIECE characters of many texts in hash order, until `chars` characters a
language (fewer where the languages are so many that the tables would pass TABLES bytes).  Texts of any length are read
whole; repeated rows each have their prediction.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.llm.common import numbered

TRAIN_CHARS, LANE, SYMBOLS = 24_000, 256, 63
PIECE, TABLES = 2_000, 1 << 29
UNKNOWN = "und"


def suffix_automaton(text: list[int]) -> tuple[list[dict[int, int]], list[int]]:
    """Transitions and links of the suffix automaton of a symbol sequence (state 0: the root)."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return nexts, link


def parse_table(text: np.ndarray, symbols: int) -> np.ndarray:
    """Completed transitions: table[state * symbols + c] is 2 * (next state * symbols) + (1 if a phrase ends before c)."""
    nexts, _ = suffix_automaton(text.tolist())
    table = np.full((len(nexts), symbols), -1, np.int64)
    for s, own in enumerate(nexts):
        for c, t in own.items():
            table[s, c] = t
    root = np.where(table[0] >= 0, table[0], 0)
    ends = table < 0
    table = np.where(ends, root[None, :], table)
    table = 2 * symbols * table + ends
    return table.astype(np.int32).ravel()


class Model:
    """Parse tables of the languages, each over its own alphabet.

    Symbols: 0 what is no letter, 1 a letter outside the training text, 2 a rare one of it, 3 and more its frequent ones.
    """

    def __init__(self, texts: dict[str, str], symbols: int = SYMBOLS):
        self.names = sorted(texts)
        self.symbols = symbols
        self.letters, self.own, self.tables, bits = [], [], [], []
        for k in self.names:
            points = _lower(_points(texts[k]))
            kinds, n = np.unique(points, return_counts=True)
            letters = np.array([chr(c).isalpha() for c in kinds], bool)
            kinds, n = kinds[letters], n[letters]
            self.letters.append(kinds)
            code = np.full(len(kinds), 2, np.uint8)
            often = np.lexsort((kinds, -n))[: symbols - 3]
            code[np.sort(often)] = np.arange(3, 3 + len(often))
            self.own.append(code)
            made = squeeze(self.lookup(len(self.own) - 1)[points])[0]
            self.tables.append(parse_table(made, symbols))
            bits.append(np.log2(max(2, len(made))))
        self.bits = np.array(bits)

    def lookup(self, k: int) -> np.ndarray:
        """Language k's symbol of every code point, lower-casing included."""
        low, letter = _cases()
        out = letter.copy()
        if len(self.letters[k]):
            at = np.minimum(np.searchsorted(self.letters[k], low), len(self.letters[k]) - 1)
            out = np.where(self.letters[k][at] == low, self.own[k][at], out).astype(np.uint8)
        return out

    def phrases(self, looks: list[np.ndarray], points: np.ndarray, offsets: np.ndarray, lane: int = LANE, width: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that each text (its code points between offsets) needs in each language, and its symbols."""
        out = np.zeros((len(offsets) - 1, len(self.names)), np.int64)
        sizes = np.zeros(len(offsets) - 1, np.int64)
        for k, look in enumerate(looks):
            codes, own = squeeze(look[points], offsets)
            out[:, k] = self._walk(self.tables[k], codes, own, lane, width)
            sizes = np.diff(own)  # what is no letter is the same in every language
        return out, sizes

    def _walk(self, table: np.ndarray, symbols: np.ndarray, offsets: np.ndarray, lane: int, width: int) -> np.ndarray:
        n = np.diff(offsets)
        lanes = -(-n // lane)
        of = np.repeat(np.arange(len(n)), lanes)
        start = offsets[:-1][of] + lane * (np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        size = np.minimum(lane, offsets[1:][of] - start)
        out = np.zeros(len(n), np.int64)
        by = np.argsort(-size, kind="stable")
        padded = np.concatenate([symbols, np.zeros(lane, np.uint8)])
        steps = np.arange(lane)
        for a in range(0, len(by), width):
            own = by[a : a + width]
            length = size[own]
            longest = int(length[0])
            block = np.ascontiguousarray(padded[start[own][:, None] + steps[None, :longest]].T).astype(np.int32)
            active = np.searchsorted(-length, -np.arange(longest), "left")  # lanes longer than the step
            state = np.zeros(len(own), np.int32)
            count = np.ones(len(own), np.int32)
            for t in range(longest):
                m = active[t]
                v = table.take(state[:m] + block[t, :m])
                count[:m] += v & 1
                state[:m] = v >> 1
            out += np.bincount(of[own], weights=count, minlength=len(n)).astype(np.int64)
        return out


@cache
def _cases() -> tuple[np.ndarray, np.ndarray]:
    """Simple lower case of every code point, and whether it is a letter; made once a process."""
    points = np.arange(0x110000, dtype=np.uint32)
    return _lower(points), np.array([chr(c).isalpha() for c in range(0x110000)], np.uint8)


def squeeze(codes: np.ndarray, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Runs of separators (0) become one; offsets follow."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    if offsets is not None:
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
    return codes[keep], offsets


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _lower(points: np.ndarray) -> np.ndarray:
    """Simple lower case of each code point (those that lower to several stay)."""
    kinds, at = np.unique(points, return_inverse=True)
    low = np.array([ord(x) if len(x) == 1 else c for c, x in ((int(c), chr(c).lower()) for c in kinds)], np.uint32)
    return low[at] if len(points) else points


def sample(docs: DataFrame, chars: int = TRAIN_CHARS, piece: int = PIECE) -> dict[str, str]:
    """Labelled text a language: a piece of each of many texts, in hash order until `chars` characters.

    A language of few texts gives longer pieces of each, so that it reaches `chars` where its texts have as many.
    """
    h = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    rows = docs.filter("lang is not null and text is not null and length(text) > 0").select("lang", "text", h.alias("h"), F.length("text").alias("n"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("m"), F.avg(F.least(F.col("n"), F.lit(piece))).alias("mean")).collect()
    if not sizes:
        return {}
    chars = min(chars, TABLES // (2 * SYMBOLS * 4 * len(sizes)))
    # a hash range that holds a few times the wanted rows at the mean length; the rest of the rows never leave the executors
    reach, most = F.lit(0), F.lit(piece)
    for r in sizes:
        share = min(1.0, (4 * chars / r.mean + 40) / r.m)
        reach = F.when(F.col("lang") == r.lang, F.lit(int(share * (1 << 30)))).otherwise(reach)
        if r.m * r.mean < 2 * chars:  # every text of such a language is read, each for an even share at least
            most = F.when(F.col("lang") == r.lang, F.lit(max(piece, chars))).otherwise(most)
    room = F.greatest(F.lit(1), F.col("n") - most + 2)
    taken = F.substring("text", (F.pmod(F.col("h"), room) + 1).cast("int"), most.cast("int"))
    found = rows.filter(F.col("h") < reach).select("lang", taken.alias("text"), "h").orderBy("lang", "h", "text").collect()
    out: dict[str, str] = {}
    for r in found:
        own = out.get(r.lang, "")
        if len(own) < chars:
            out[r.lang] = own + " " + r.text[: chars - len(own)]
    return out


def identify(docs: DataFrame, train: DataFrame, chars: int = TRAIN_CHARS, lane: int = LANE) -> DataFrame:
    """Columns of docs(doc_id, held_out, text) but text, and lang_pred, score, which replace columns of these names; others stay, whatever their names.

    Null texts and texts without a letter: `und`, score 0.  Ties go to the first language by name.  Without any
    training text every text is `und`.  The score is the margin of the winner's entropy over the next one's.
    """
    spark = docs.sparkSession
    texts = sample(train, chars)
    shared = spark.sparkContext.broadcast(Model(texts))  # TABLES bounds its size
    keep = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string"))
    schema = T.StructType(given.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")

    def run(batches):
        model = shared.value
        looks = [model.lookup(k) for k in range(len(model.names))]
        for b in batches:
            frame = b.column(len(keep))
            texts = frame.to_pylist()
            pred, score = [], []
            for a in range(0, len(texts), 256):
                part = texts[a : a + 256]
                known = [t is not None and any(map(str.isalpha, t)) and bool(model.names) for t in part]
                points = [_points(t) if ok else np.empty(0, np.uint32) for t, ok in zip(part, known)]
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in points])))
                every = np.concatenate(points) if offsets[-1] else np.empty(0, np.uint32)
                if not model.names:
                    pred += [UNKNOWN] * len(part)
                    score += [0.0] * len(part)
                    continue
                needed, size = model.phrases(looks, every, offsets, lane)
                cost = needed * model.bits / np.maximum(1, size)[:, None]
                best = cost.argmin(1)
                low = cost[np.arange(len(part)), best]
                rest = np.sort(cost, 1)[:, 1] if cost.shape[1] > 1 else low * 2
                margin = np.where(rest > 0, 1 - low / np.maximum(rest, 1e-12), 0.0)
                pred += [model.names[i] if ok else UNKNOWN for i, ok in zip(best, known)]
                score += [float(m) if ok else 0.0 for m, ok in zip(margin, known)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema.names)

    return numbered(given).mapInArrow(run, schema)
