"""Spelling variants: words one edit apart, found by bidirectional FM-index search schemes, and the form each word follows.

A word that differs from another by one inserted, deleted or replaced code point shares with it its first half or its
second half.  So words are dealt by half: a word asks in the group of each of its halves and stands as a candidate in
the groups whose words could ask for it (two a side).  A task packs whole groups into indexes over the text $w1$w2$...$:
suffix-rank intervals of that text and of its reverse are kept in step, so a search may go either way.  The half is matched
exactly from its end leftwards to the delimiter; then the search turns and goes right across the other half to the
delimiter, with one error.  Second halves are searched in the same way over reversed words.

Size.  Corpus counts are summed in each task first.  A group of more than GROUP words is split into blocks by hash; its
words then ask in every block.  A task holds one index, about SYMBOLS code points or one block of one group, whichever
is larger.  A word has at most two times its length times the alphabet's size of near words, so pairs grow with the vocabulary.

Defined results.  Null and empty texts have no words; a null doc_id is an empty one in the hash that plants misspellings.
Repeated rows count again.  An empty table gives no rows.  Very long texts are read in pieces that end at white space.  Ties
between forms go to the smallest in code-point order.  Columns of docs other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import LOWER, beside, cut, parts_of, utf8, whole_words

RUN = "[a-zÀ-ÿ]+"
GROUP = 100_000
SYMBOLS = 1 << 20
QUERIES = 1 << 13


# ---------------------------------------------------------------- vocabulary

def vocabulary(docs: DataFrame, least_length: int = 5, least_n: int = 3, planted: int = 97) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of a least length and a least number of occurrences.

    Where `planted` divides the crc32 of `doc_id:run`, one code point of the run is left out (0: never).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, table, counts = re.compile(RUN).findall, LOWER.tobytes(), Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for b in batches:
            data, offsets = utf8(b.column(1))
            for i, doc_id in enumerate(b.column(0).to_pylist()):
                start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
                for piece in whole_words(data[offsets[i] : offsets[i + 1]], 1 << 20):
                    for word, n in Counter(find(piece.tobytes().translate(table).decode("utf-8", "replace"))).items():
                        if planted and not (h := zlib.crc32(word.encode(), start)) % planted:
                            h %= len(word)
                            word = word[:h] + word[h + 1 :]
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > 200_000:
                        yield flush()
        yield flush()

    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


# ---------------------------------------------------------------- the index

def suffix_array(t: np.ndarray) -> np.ndarray:
    """Begins of the suffixes of t in order; t ends with a 0 that occurs once.  Prefix doubling over the ties that are left."""
    n, bits = len(t), max(1, int(t.max()).bit_length())
    first = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(first):
        key <<= bits
        key[: max(0, n - j)] |= t[j:].astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1], [True]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new[:-1], np.arange(n), 0))
    tied, k = np.flatnonzero(~(new[:-1] & new[1:])), first
    while len(tied):
        own = order[tied]
        key = rank[own] * (n + 1) + rank[own + k]
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[tied] = own
        new = np.concatenate(([True], key[1:] != key[:-1], [True]))
        rank[own] = np.maximum.accumulate(np.where(new[:-1], tied, 0))
        tied, k = tied[~(new[:-1] & new[1:])], 2 * k
    return order


class Ranks:
    """Occurrences of symbols before places of a Burrows-Wheeler transform: counts at every STEP places, and a look at the rest."""

    STEP = 32

    def __init__(self, t: np.ndarray, order: np.ndarray, symbols: int):
        bwt, n = t[order - 1], len(t)
        blocks = n // self.STEP + 1
        self.bwt = np.zeros(blocks * self.STEP, np.int32)
        self.bwt[:n] = bwt
        held = np.bincount(np.arange(n) // self.STEP * symbols + bwt, minlength=blocks * symbols).reshape(blocks, symbols)
        self.before = (np.cumsum(held, axis=0) - held).astype(np.int32)
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(t, minlength=symbols))))[:symbols]
        self.bwt, self.symbols = self.bwt.reshape(blocks, self.STEP), symbols
        self.smaller: np.ndarray | None = None

    def _rest(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block, off = at // self.STEP, at % self.STEP
        return block, self.bwt[block], np.arange(self.STEP) < off[:, None]

    def of(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        block, rest, seen = self._rest(at)
        return self.before[block, symbol] + ((rest == symbol[:, None]) & seen).sum(1)

    def below(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many smaller symbols there are before each place."""
        if self.smaller is None:
            self.smaller = np.cumsum(self.before, axis=1, dtype=np.int32) - self.before
        block, rest, seen = self._rest(at)
        return self.smaller[block, symbol] + ((rest < symbol[:, None]) & seen).sum(1)

    def all(self, at: np.ndarray) -> np.ndarray:
        """Occurrences of every symbol before each place, a row a place."""
        block, rest, seen = self._rest(at)
        which = (np.arange(len(at))[:, None] * self.symbols + rest)[seen]
        return self.before[block] + np.bincount(which, minlength=len(at) * self.symbols).reshape(len(at), self.symbols)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of each pattern with a symbol before it."""
        return self.begin[symbol] + self.of(symbol, low), self.begin[symbol] + self.of(symbol, high)


class WordIndex:
    """A bidirectional FM-index over distinct words (arrays of symbols from 2 on), delimited by 1."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        self.n, one = len(words), np.ones(1, np.int32)
        text = np.concatenate([one, *[x for w in words for x in (w, one)]])
        end = np.zeros(1, np.int32)
        left = np.concatenate([text, end])
        right = np.concatenate([text[::-1], end])
        self.left = Ranks(left, suffix_array(left), symbols)
        self.order = suffix_array(right)
        self.right = Ranks(right, self.order, symbols)
        self.delimiters = np.flatnonzero(right == 1)
        self.size = len(left)

    def extended_left(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray, mirror: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals in the text, and the begin of the interval of the reversed pattern in the reversed text, one symbol further left."""
        mirror = mirror + self.left.below(symbol, high) - self.left.below(symbol, low)
        low, high = self.left.step(symbol, low, high)
        return low, high, mirror

    def word_at(self, rank: np.ndarray) -> np.ndarray:
        """Number of the word whose reverse, with its delimiters, begins the suffix of that rank of the reversed text."""
        return self.n - 1 - np.searchsorted(self.delimiters, self.order[rank])

    def one_error(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs: words that begin with the first half symbols of a query and are one edit from it.

        Query i is flat[start[i] : start[i] + length[i]].  Each pair comes once: an inserted symbol counts as put behind
        its like, of a run the last symbol is deleted.
        """
        q = np.arange(len(start))
        low, high, mirror = np.zeros(len(q), np.int64), np.full(len(q), self.size), np.zeros(len(q), np.int64)
        done: list[tuple[np.ndarray, ...]] = []
        for j in range(int(half.max(initial=-1)) + 1):  # the half from its end to its begin, then the delimiter
            inside = j < half[q]
            low, high, mirror = self.extended_left(np.where(inside, flat[np.where(inside, start[q] + half[q] - 1 - j, 0)], 1), low, high, mirror)
            for which, keep in ((~inside, False), (inside, True)):
                some = which & (low < high)
                if not keep:
                    done.append((q[some], mirror[some], (mirror + high - low)[some]))
            some = inside & (low < high)
            q, low, high, mirror = q[some], low[some], high[some], mirror[some]
        q, low, high = (np.concatenate(x) for x in zip(*done)) if done else (q, low, high)
        rest = length - half
        wrong = (np.empty(0, np.int64),) * 3  # states that have their error
        found: list[tuple[np.ndarray, np.ndarray]] = []
        t = 0
        while len(q) or len(wrong[0]):
            here = lambda x: flat[np.minimum(start[x] + half[x] + t, len(flat) - 1)]  # noqa: E731, B023
            inside = t < rest[q]
            want = np.where(inside, here(q), 0)
            a, z = self.right.all(low), self.right.all(high)
            at, c = np.nonzero((z - a)[:, 2:] > 0)
            c += 2
            child = (q[at], self.right.begin[c] + a[at, c], self.right.begin[c] + z[at, c])
            other, within = c != want[at], inside[at]
            last = inside & ((t + 1 == rest[q]) | (flat[np.minimum(start[q] + half[q] + t + 1, len(flat) - 1)] != want))
            wrong = tuple(np.concatenate((x, y[other])) for x, y in zip(wrong, child))  # inserted
            inside = t < rest[wrong[0]]
            lo, hi = self.right.step(np.where(inside, here(wrong[0]), 1), wrong[1], wrong[2])
            some = lo < hi
            found.append((wrong[0][some & ~inside], self.word_at(lo[some & ~inside])))
            some &= inside
            wrong = tuple(np.concatenate(x) for x in zip((wrong[0][some], lo[some], hi[some]), [x[other & within] for x in child], (q[last], low[last], high[last])))  # gone on, replaced, deleted
            q, low, high = (x[~other & within] for x in child)
            t += 1
        return (np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])) if found else (q, q)


# ---------------------------------------------------------------- near words

def _pairs(words: list[str], n: np.ndarray, side: np.ndarray, group: np.ndarray, asks: np.ndarray, stands: np.ndarray) -> Iterator[tuple[list[str], list[str], np.ndarray]]:
    """(word, near, n of near) among rows of whole groups: from each row that asks to the rows of its group that stand."""
    names, number = np.unique(np.array(words, object), return_inverse=True)
    count = np.zeros(len(names), np.int64)
    count[number] = n
    points = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in names]
    alphabet = np.unique(np.concatenate(points))
    points = [(np.searchsorted(alphabet, x) + 2).astype(np.int32) for x in points]
    for own in (0, 1):
        here = np.flatnonzero(side == own)
        stand, ask = here[stands[here]], here[asks[here]]
        if not len(stand) or not len(ask):
            continue
        turned = (lambda x: x[::-1]) if own else (lambda x: x)
        held = np.unique(number[stand])
        index = WordIndex([turned(points[i]) for i in held], len(alphabet) + 2)
        known = np.sort(group[stand] * len(names) + number[stand])
        step = min(QUERIES, max(256, (1 << 22) // (len(alphabet) + 2)))
        for a in range(0, len(ask), step):
            rows = ask[a : a + step]
            texts = [turned(points[i]) for i in number[rows]]
            length = np.array([len(x) for x in texts])
            half = (length + 1) // 2 if own else length // 2
            q, w = index.one_error(np.concatenate(texts), np.cumsum(length) - length, length, half)
            w, q = held[w], rows[q]
            key = group[q] * len(names) + w
            at = np.searchsorted(known, key)
            ok = known[np.minimum(at, len(known) - 1)] == key
            q, w = number[q[ok]], w[ok]
            if own:  # what the first half finds is not told again
                ok = np.array([not names[y].startswith(names[x][: len(names[x]) // 2]) for x, y in zip(q, w)], bool)
                q, w = q[ok], w[ok]
            if len(q):
                yield names[q].tolist(), names[w].tolist(), count[w]


def near_words(vocabulary: DataFrame, group: int = GROUP, symbols: int = SYMBOLS) -> DataFrame:
    """(word, near, near_n) for every two words of vocabulary(word, n) that are one edit apart, in both directions.

    Words are distinct and of at least two code points.
    """
    m = F.char_length("word")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.floor((m - 1) / 2).cast("int").alias("a"), F.floor((m + 1) / 2).cast("int").alias("b"), F.floor(m / 2).cast("int").alias("own")),
        F.struct(F.lit(1).alias("side"), F.floor(m / 2).cast("int").alias("a"), F.floor((m + 2) / 2).cast("int").alias("b"), F.floor((m + 1) / 2).cast("int").alias("own")),
    )
    rows = vocabulary.select("word", "n", F.explode(sides).alias("s")).select("word", "n", "s.side", "s.own", F.explode(F.sequence("s.a", "s.b")).alias("half"))
    part = F.when(F.col("side") == 0, F.left("word", F.col("half"))).otherwise(F.right("word", F.col("half")))
    rows = rows.select("word", "n", "side", (F.col("half") == F.col("own")).alias("asks"), F.xxhash64("side", "half", part).alias("place"))
    large = rows.groupBy("place").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > group)
    blocks = F.coalesce(F.ceil(F.col("rows") / group).cast("int"), F.lit(1))
    rows = beside(rows, large, "place", how="left").withColumn("home", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    rows = rows.withColumn("block", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array("home"))))
    dealt = rows.select("side", "place", "block", "word", "n", "asks", (F.col("block") == F.col("home")).alias("stands")).repartition(parts_of(vocabulary), "place", "block").sortWithinPartitions("place", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None

        def made(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            get = lambda name: rows.column(name).to_numpy()
            place, block = get("place"), get("block")
            group = np.cumsum(np.concatenate(([False], (place[1:] != place[:-1]) | (block[1:] != block[:-1]))))
            for word, near, n in _pairs(rows.column("word").to_pylist(), get("n"), get("side"), group, get("asks"), get("stands")):
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n)], ["word", "near", "near_n"])

        for b in batches:
            more = pa.Table.from_batches([b])
            waiting = more if waiting is None else pa.concat_tables([waiting, more])
            if waiting.nbytes > 6 * symbols and waiting.num_rows > 1:
                waiting = waiting.combine_chunks()
                place, block = waiting.column("place").to_numpy(), waiting.column("block").to_numpy()
                ends = np.flatnonzero((place[1:] != place[:-1]) | (block[1:] != block[:-1]))
                if len(ends):  # all but the last group are whole
                    yield from made(waiting.slice(0, int(ends[-1]) + 1))
                    waiting = waiting.slice(int(ends[-1]) + 1)
        if waiting is not None and waiting.num_rows:
            yield from made(waiting)

    return dealt.mapInArrow(run, "word string, near string, near_n long")


# ---------------------------------------------------------------- forms and roots

def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of words(word, n).

    A word's form is its near word of largest n (ties: the smallest), if that is at least `ratio` times its own; its root is
    where the forms end.  Forms have growing n, so there are no cycles; roots are found by following links of links,
    in as many rounds as the logarithm of the longest path.
    """
    words = cut(words.select("word", "n"))
    best = F.struct((-F.col("near_n")).alias("less"), "near")
    none = F.lit(None).cast("struct<less:bigint,near:string>")
    both = words.select("word", "n", F.lit(0).cast("long").alias("k"), none.alias("best")).unionByName(near_words(words).select("word", F.lit(None).cast("long").alias("n"), F.lit(1).cast("long").alias("k"), best.alias("best")))
    summed = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("k").alias("n_near"), F.min("best").alias("best"))
    follows = F.col("best").isNotNull() & (-F.col("best.less") >= ratio * F.col("n"))
    rows = cut(summed.select("word", "n", "n_near", F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n")))
    links = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = links.filter("moved").limit(1).count()
        links = links.drop("moved")
        if not moved:
            break
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
