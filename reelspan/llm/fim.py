"""Fill-in-middle transformation, its cuts found by a piecewise-linear learned rank index.

The boundaries between a text's units (code points, words or lines) lie at growing byte offsets.  Segments are fitted
to all of them, each a line that misses no offset by more than EPSILON bytes, and the misses are stored as one signed
byte a boundary.  A cut at unit r is the line's prediction for r, corrected by the stored miss: exact, without a walk
through the text.  Texts are cut as bytes; a task holds one text, its misses and one piece of its offsets.

Defined results.  A null or empty text is plain and empty.  A text that holds one of the three marks is plain, so that
every output can be taken apart again.  Repeated rows and rows that share a doc_id have the same draws; a null doc_id
draws as an empty one.  An empty table gives no rows.  Very long texts are indexed in pieces of PIECE boundaries.  Columns
of docs stay, whatever their names, but for those named as a result column, which are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import SPACE, free_name, numbered, slices, utf8

EPSILON = 100
PIECE = 1 << 16
MARKS = ("<P>", "<S>", "<M>")
RESULT = {"n": "long", "form": "string", "prefix_n": "long", "middle_n": "long", "output": "string"}


# ---------------------------------------------------------------- boundaries

def _chars(data: np.ndarray, before: int) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray, before: int) -> np.ndarray:
    space = SPACE[data]
    return ~space & np.concatenate(([before < 0 or bool(SPACE[before])], space[:-1]))


def _lines(data: np.ndarray, before: int) -> np.ndarray:
    return np.concatenate(([before == 10], data[:-1] == 10))


UNITS = {"char": _chars, "word": _words, "line": _lines}


def boundaries(data: np.ndarray, unit: str = "char", piece: int = PIECE) -> Iterator[np.ndarray]:
    """Offsets at which units begin, the first at 0, and the text's end, in ascending pieces.

    A word takes the white space after it; white space before the first word is a unit.
    """
    for at in range(0, len(data), piece):
        found = np.flatnonzero(UNITS[unit](data[at : at + piece], int(data[at - 1]) if at else -1)) + at
        if not at and (not len(found) or found[0]):
            found = np.concatenate(([0], found))
        yield found
    yield np.array([len(data)], np.int64)


# ---------------------------------------------------------------- the index

class RankIndex:
    """Rank to offset over ascending offsets: lines through (rank, offset) points, and every point's miss.

    A segment begins at a point and goes on while some slope keeps all its points within epsilon of the line.
    """

    def __init__(self, pieces: Callable[[], Iterator[np.ndarray]], epsilon: int = EPSILON):
        self.first, self.base, self.slope = [], [], []
        low, high, rank = -np.inf, np.inf, 0
        for y in pieces():
            at, step = 0, 1024
            while at < len(y):
                if not self.first or len(self.first) == len(self.slope):  # no open segment
                    self.first.append(rank + at)
                    self.base.append(int(y[at]))
                    low, high, step, at = -np.inf, np.inf, 1024, at + 1
                    continue
                rise = y[at : at + step] - self.base[-1]
                run = np.arange(rank + at - self.first[-1], rank + at - self.first[-1] + len(rise))
                lows = np.maximum.accumulate(np.maximum((rise - epsilon) / run, low))
                highs = np.minimum.accumulate(np.minimum((rise + epsilon) / run, high))
                fits = len(rise) if lows[-1] <= highs[-1] else int(np.argmax(lows > highs))
                if fits:
                    low, high = lows[fits - 1], highs[fits - 1]
                if fits < len(rise):
                    self.slope.append(_between(low, high))
                at, step = at + fits, 2 * step
            rank += len(y)
        if len(self.slope) < len(self.first):
            self.slope.append(_between(low, high))
        self.size = rank
        self.misses = np.empty(rank, np.int8)
        first, base, slope, rank = np.array(self.first), np.array(self.base), np.array(self.slope), 0
        for y in pieces():
            r = np.arange(rank, rank + len(y))
            s = np.searchsorted(first, r, "right") - 1 if len(first) > 1 else 0
            self.misses[rank : rank + len(y)] = y - (base[s] + np.rint(slope[s] * (r - first[s])).astype(np.int64))
            rank += len(y)

    def predicted(self, rank: int) -> int:
        s = bisect_right(self.first, rank) - 1
        return self.base[s] + int(np.rint(self.slope[s] * (rank - self.first[s])))

    def offset(self, rank: int) -> int:
        return self.predicted(rank) + int(self.misses[rank])


def _between(low: float, high: float) -> float:
    return (low + high) / 2 if np.isfinite(low) and np.isfinite(high) else 0.0


# ---------------------------------------------------------------- the transformation

def draws(key: str, salt: str, n: int = 4) -> Column:
    """The first n groups of eight hex digits of sha256 of `salt:key` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)])


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "char", plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS, salt: str = "1") -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_n, middle_n (units, null if plain) and output.

    Of 100 draws, `plain` texts stay as they are; of the others, `spm` in 100 begin with the suffix.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in RESULT])
    name = free_name(kept, "draws")
    given = kept.withColumn(name, draws(key, salt))
    at, drawn = given.columns.index(text), given.columns.index(name)
    p, s, m = (x.encode() for x in marks)
    schema = kept.schema
    for column, kind in RESULT.items():
        schema = schema.add(column, kind)

    def one(data: np.ndarray, h: list[int]) -> tuple:
        index = RankIndex(lambda: boundaries(data, unit)) if len(data) else None
        n, own = index.size - 1 if index else 0, data.tobytes()
        if not n or p in own or s in own or m in own or h[2] % 100 >= 100 - plain:
            return n, "plain", None, None, own
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        i, j = index.offset(a), index.offset(b)
        if h[3] % 100 < spm:
            return n, "spm", a, b - a, b"".join((s, own[j:], p, own[:i], m, own[i:j]))
        return n, "psm", a, b - a, b"".join((p, own[:i], s, own[j:], m, own[i:j]))

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for a, b in slices(offsets, 1 << 24):
                h = batch.column(drawn).slice(a, b - a).to_pylist()
                rows = [one(data[offsets[a + i] : offsets[a + i + 1]], x) for i, x in enumerate(h)]
                n, form, prefix, middle, output = zip(*rows)
                keep = [c.slice(a, b - a) for i, c in enumerate(batch.columns) if i != drawn]
                made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays([*keep, *made], schema.names)

    return numbered(given).mapInArrow(run, schema)


def restored(rows: DataFrame, name: str = "restored", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """rows with the text that each (form, output) was made of, from these two alone."""
    p, s, m = marks

    def parts(first: str, second: str) -> Column:
        """The three parts of an output that begins with mark `first` and goes on with `second` and m."""
        rest = F.expr(f"substring(output, {len(first) + 1})")
        return F.split(rest, "|".join(f"\\Q{x}\\E" for x in (second, m)), -1)

    psm, spm = parts(p, s), parts(s, p)
    made = F.when(F.col("form") == "psm", F.concat(psm[0], psm[2], psm[1])).when(F.col("form") == "spm", F.concat(spm[1], spm[2], spm[0]))
    return rows.withColumn(name, F.coalesce(made, "output"))
