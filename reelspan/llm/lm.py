"""Language-model scoring by a causal self-attention model trained in numpy on subword ids.

Base score: add-one unigram log-probabilities of words.  Word counts cover every training document; frequent
words (at most `head` of them, by a count threshold) are broadcast, the rest is joined.

Model: one causal attention layer over subword ids (vocabulary entries of a public rank file, by longest
match inside each word), with learned distance biases; it predicts the class of the next id by a softmax over
groups of classes and one over the group's classes, and the id within its class by its share.  Texts are scored in overlapping windows: a window reads
`window` ids and scores the last `stride` of them, so each id is scored once, in batches of masked attention.
Id counts, and with them the classes' and the ids' shares, cover every training document, and so does the fit: the
driver only starts the model, on a bounded draw of windows; then the tasks take it on over every window of every
training text, in a few rounds, after each of which their changes are averaged.  How texts are dealt to tasks moves the
fitted weights a little.  Gradients are hand-written.

The text scored by the model is the text's words, A-Z lower-cased, and one end: white space counts as one
separator.  Null and empty texts hold the end only.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspan.llm.bpe import load_ranks
from reelspan.llm.common import LOWER, SPACE, cut, mix, numbered, slices, utf8, whole_words, word_hashes

HEAD, WINDOW, STRIDE, DIM, CLASSES = 150_000, 16, 8, 16, 256
#: About LEAST windows are drawn for the start; of one document FEW, or more while the documents are few.
LEAST, FEW = 50_000, 8
STEPS, BATCH = 600, 512
LONGEST, VOCABULARY = 4, 3000
#: Windows of a tile and of a segment of text, segments of a step, and rounds in which the tasks' models are brought together.
TILE, SEGMENT, SEGMENTS, ROUNDS = 4, 32, 32, 4


# ---------------------------------------------------------------- subword ids

class Pieces:
    """Vocabulary entries of at most four bytes, found by longest match; all single bytes are among them.  The last id ends a text."""

    def __init__(self, path: str, most: int = VOCABULARY):
        ranks = load_ranks(path)
        own = sorted((r, k) for k, r in ranks.items() if len(k) <= LONGEST and (len(k) == 1 or r < most) and b" " not in k[1:])
        self.n = len(own) + 1
        self.end = len(own)
        self.tables = {}
        for size in range(1, LONGEST + 1):
            keys = np.array([int.from_bytes(k, "little") for _, k in own if len(k) == size], np.uint32)
            ids = np.array([i for i, (_, k) in enumerate(own) if len(k) == size], np.int32)
            by = np.argsort(keys)
            self.tables[size] = (keys[by], ids[by])
        # by its first two bytes, then by each next one: the id of the longest entry, or (from n on) a prefix of entries still longer
        names = {k: i for i, (_, k) in enumerate(own)}
        longer = [{k[:size] for k in names if len(k) > size} for size in range(LONGEST)]
        self.size = np.array([len(k) for _, k in own], np.intp)
        self.first, self.then, live = np.empty(1 << 16, np.uint16), [], {}
        for pair in range(1 << 16):
            k = pair.to_bytes(2, "little")
            self.first[pair] = live.setdefault(k, self.n + len(live)) if k in longer[2] else names.get(k, names[k[:1]])
        for size in range(3, LONGEST + 1):
            table, after = np.empty((self.n + len(live), 256), np.uint16), {}
            table[: self.n] = np.arange(self.n)[:, None]
            for k, i in live.items():
                table[i] = next(names[k[:j]] for j in range(size - 1, 0, -1) if k[:j] in names)
            for k in sorted(longer[size] if size < LONGEST else ()):
                table[live[k[:-1]], k[-1]] = after.setdefault(k, self.n + len(after))
            for k in names:
                if len(k) == size and k not in after:
                    table[live[k[:-1]], k[-1]] = names[k]
            self.then.append(table.ravel())
            live = after

    def ids(self, data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows' texts, each with a space before every word and one end id; and the rows' offsets.

        Rows are taken together up to `most` bytes; a longer one in pieces that end at white space.
        """
        out, sizes = [], []
        for a, b in slices(offsets, most):
            at, end = int(offsets[a]), int(offsets[b])
            if b - a == 1 and end - at > most:
                one = [self._ids(p, np.array([0, len(p)]))[0][:-1] for p in whole_words(data[at:end], most)]
                one.append(np.array([self.end], np.int32))
                out += one
                sizes.append([sum(map(len, one))])
            else:
                ids, own = self._ids(data[at:end], offsets[a : b + 1] - at)
                out.append(ids)
                sizes.append(np.diff(own))
        return np.concatenate(out) if out else np.empty(0, np.int32), np.concatenate(([0], np.cumsum(np.concatenate(sizes) if sizes else [])))

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        # a leading space for each row, runs of white space as one space
        text = np.full(len(data) + rows + LONGEST, 0x20, np.uint8)
        own = offsets + np.arange(rows + 1)
        keep = np.ones(len(data) + rows, bool)
        keep[own[:-1]] = False
        text[: len(keep)][keep] = LOWER[data]
        space = SPACE[text[: len(keep)]]
        follows = np.append(space[1:], True)
        solid = ~(space & follows)
        at = np.concatenate(([0], np.cumsum(solid)))[own]
        packed = np.where(space, np.uint8(0x20), text[: len(keep)])[solid]
        n = len(packed)
        packed = np.append(packed, np.full(LONGEST, 0x20, np.uint8))
        word_start = packed[:n] == 0x20
        word_start[at[:-1][at[:-1] < at[1:]]] = True
        # the longest entry that begins at a word's start and stays inside it (a space is in no entry but as its first byte),
        # then from where that ends: all words advance together
        four = np.ndarray((n,), "<u4", packed.tobytes(), 0, (1,))  # the four bytes from each place on
        begins, found = np.zeros(n + 1, bool), np.empty(n, np.int32)
        here = np.flatnonzero(word_start)
        stop = np.append(here[1:], n)
        while len(here):
            key = four[here]
            got = self.first[key & np.uint32(0xFFFF)]
            for k, table in enumerate(self.then, 2):
                got = table[got.astype(np.uint32) << np.uint32(8) | (key >> np.uint32(8 * k) & np.uint32(0xFF))]
            begins[here], found[here] = True, got
            here = here + self.size[got]
            on = here < stop
            here, stop = here[on], stop[on]
        picks = np.flatnonzero(begins[:n])
        counts = np.searchsorted(picks, at)
        out = np.empty(len(picks) + rows, np.int32)
        ends = counts[1:] + np.arange(rows)
        taken = np.ones(len(out), bool)
        taken[ends] = False
        out[taken] = found[picks]
        out[ends] = self.end
        return out, np.concatenate(([0], ends + 1))


# ---------------------------------------------------------------- the model

def blocks(ids: np.ndarray, offsets: np.ndarray, pad: int, window: int, stride: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows, or those numbered `own`: text, inputs (window - 1 ids, padded before a text's begin) and the stride targets (-1: none)."""
    n = np.diff(offsets)
    ends = np.cumsum(-(-n // stride))
    if own is None:
        own = np.arange(int(ends[-1]) if len(n) else 0)
    doc = np.searchsorted(ends, own, "right")
    first = stride * (own - np.concatenate(([0], ends))[doc])  # first target of the window, in its text
    most = max(0, len(ids) - 1)
    at = first[:, None] + np.arange(-(window - stride), stride - 1)[None, :]
    x = np.where((at >= 0) & (at < n[doc][:, None]), ids[np.clip(offsets[:-1][doc][:, None] + at, 0, most)], pad)
    to = first[:, None] + np.arange(stride)[None, :]
    y = np.where(to < n[doc][:, None], ids[np.clip(offsets[:-1][doc][:, None] + to, 0, most)], -1)
    return doc, x, y


class Attention:
    """One causal attention layer with a class softmax, trained by Adam."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, n: int, dim: int = DIM, classes: int = CLASSES, window: int = WINDOW, stride: int = STRIDE, steps: int = STEPS, batch: int = BATCH, rate: float = 0.01, seed: int = 3, counts: np.ndarray | None = None, windows: tuple[np.ndarray, np.ndarray] | None = None):
        """Learns from the texts ids[offsets], or from the counts of all ids and drawn windows (inputs, targets)."""
        self.window, self.stride, self.n = window, stride, n
        counts = (np.bincount(ids, minlength=n) if counts is None else counts).astype(float) + 0.1
        # classes of like total share: frequent ids have one of their own
        by = np.argsort(-counts, kind="stable")
        share = np.cumsum(counts[by]) / counts.sum()
        self.of = np.empty(n, np.int32)
        rank = np.minimum((share * classes).astype(int), classes - 1)
        self.of[by] = np.unique(rank, return_inverse=True)[1]
        m = int(self.of.max()) + 1
        total = np.bincount(self.of, counts, m)
        self.rank = np.empty(n + 1, np.int16)  # of ids by count; the pad is the last
        self.rank[np.append(by, n)] = np.arange(n + 1)
        self.inner = np.log(counts / total[self.of]).astype(np.float32)
        # classes in groups of about the root of their number, by share; a group that is not full has classes of no share
        self.wide = int(np.ceil(np.sqrt(m)))
        groups = -(-m // self.wide)
        full = np.zeros(groups * self.wide)
        full[:m] = total / total.sum()
        full = full.reshape(groups, self.wide)
        with np.errstate(divide="ignore"):
            inside = np.maximum(np.log(full / full.sum(1, keepdims=True)), -1e9)
        r = np.random.default_rng(seed)
        scale = 1 / np.sqrt(dim)
        p = {"E": r.normal(0, 0.5, (n + 1, dim)), "Q": r.normal(0, scale, (dim, dim)), "K": r.normal(0, scale, (dim, dim)), "V": r.normal(0, scale, (dim, dim)), "D": np.zeros(window), "H": r.normal(0, scale, (2 * dim, 2 * dim)), "g": np.zeros(2 * dim), "O": r.normal(0, scale, (2 * dim, groups)), "b": np.log(full.sum(1)), "I": r.normal(0, scale, (groups, 2 * dim, self.wide)), "i": inside}
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        self.group = np.append((self.of // self.wide).astype(np.int16), np.int16(groups))  # the pad's is none of them
        self._mask()
        self._train(*(self._blocks(ids, offsets) if windows is None else windows), steps, batch, rate, r)
        self.freeze()

    def _mask(self):
        w, s = self.window, self.stride
        # query j stands before the id it predicts: it sees the ids at distance 0 (the last one read) to window - 1
        back = (np.arange(w - s, w)[:, None] - 1) - np.arange(w - 1)[None, :]
        self.back, self.seen = np.clip(back, 0, w - 1), back >= 0

    def _blocks(self, ids, offsets):
        """Of all windows: inputs and targets."""
        return blocks(ids, offsets, self.n, self.window, self.stride)[1:]

    def segments(self, ids: np.ndarray, offsets: np.ndarray, long: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
        """The texts one behind the other in segments of `long` windows, each with the ids its first window reads; and each window's text."""
        w, s = self.window, self.stride
        lead = -(-(w - s) // s)  # strides of pads before a text
        n = np.diff(offsets)
        strides = -(-n // s) + lead
        start = (np.cumsum(strides) - strides + lead) * s + w - s
        rows = -(-int(strides.sum()) // long)
        text = np.full(w - s + rows * long * s, self.n, np.int16)
        place = np.arange(len(ids))
        place += np.repeat(start - offsets[:-1], n)
        text[place] = ids
        return np.lib.stride_tricks.as_strided(text, (rows, w - s + long * s), (long * s * 2, 2), writeable=False), np.repeat(np.arange(len(n)), strides)

    def _band(self, dense):
        """Of tiles (segments, tiles, queries, keys): what each window's queries have with the keys it reads."""
        s, (a, b, c, e) = self.stride, dense.strides
        return np.lib.stride_tricks.as_strided(dense, (*dense.shape[:2], dense.shape[2] // s, s, self.window - 1), (a, b, s * (c + e), c, e))

    def _pairs(self, ids):
        """Products of the queries and keys of ids: all that attention asks of two ids."""
        z = self.query.take(ids, 0) @ self.key.take(ids, 0).T
        return z if not z.size or -30 <= z.min() and z.max() <= 30 else np.clip(z, -30, 30, out=z)

    def _asked(self, text, n):
        """By segment, tile, window, target and id read: the place in a table of n x n pairs of the id before the target and the id read."""
        w, s = self.window, self.stride
        many = (text.shape[1] - (w - s)) // s
        tile = TILE if many % TILE == 0 else 1
        last = (text[:, w - s - 1 : -1] * np.intp(n)).reshape(len(text), many // tile, tile, s, 1)
        text = text.astype(np.intp)
        a, b = text.strides
        return last + np.lib.stride_tricks.as_strided(text, (len(text), many // tile, tile, 1, w - 1), (a, tile * s * b, s * b, 0, b))

    def _values(self, rows, tile):
        """Of rows by place (segments, places, dim): those that each tile of windows reads."""
        w, s = self.window, self.stride
        a, b, c = rows.strides
        return np.lib.stride_tricks.as_strided(rows, (len(rows), (rows.shape[1] - (w - s)) // s // tile, (tile - 1) * s + w - 1, rows.shape[2]), (a, tile * s * b, b, c))

    def _forward(self, text, a):
        """From the attention before it is shared out: that in tiles, each tile's values, and of the targets that are ids, by group of classes: places, the ids before them, ids, attended values, hidden layer and where each group begins."""
        p, d, s = self.p, self.p["E"].shape[1], self.stride
        tile = a.shape[2]
        a /= (a.reshape(-1, a.shape[-1]) @ np.ones(a.shape[-1], a.dtype)).reshape(a.shape[:-1])[..., None]
        value = self._values(self.value.take(text.ravel(), 0, mode="clip").reshape(*text.shape, d), tile)
        dense = np.zeros((*a.shape[:2], tile * s, value.shape[2]), a.dtype)  # one product a tile of windows, of which the windows' own part counts
        self._band(dense)[...] = a
        lead = self.window - s
        to, last = text[:, lead:].ravel(), text[:, lead - 1 : -1].ravel()
        group = self.group.take(to)
        order = np.argsort(group, kind="stable")  # ids of one group of classes in a row, pads last
        at = np.searchsorted(group.take(order), np.arange(len(p["b"]) + 1))
        order = order[: at[-1]]
        to, last = to.take(order), last.take(order)
        mean = (dense @ value).reshape(-1, d).take(order, 0)
        h = mean @ p["H"][d:]
        h += self.own.take(last, 0, mode="clip")
        return dense, value, order, last, to, mean, _tanh(h), at

    def _logits(self, h, at):
        """Of the groups, then of the classes of each target's own group."""
        z = np.empty((len(h), self.out.shape[2]), h.dtype)
        for j in np.flatnonzero(np.diff(at)):
            own = z[at[j] : at[j + 1]]
            np.matmul(h[at[j] : at[j + 1]], self.out[j], out=own)
            own += self.shift[j]
        return np.minimum(z, 60, out=z) if self.steep else z

    def _gradients(self, text):
        """Of the mean loss over the targets of the segments; and their number.

        Attention, values and the last id's part of the hidden layer depend on ids alone, so gradients are summed by
        id, or by pair of ids, before they meet the parameters.
        """
        p, d = self.p, self.p["E"].shape[1]
        used = np.flatnonzero(np.bincount(text.ravel(), minlength=self.n + 1))
        local = np.zeros(self.n + 1, np.int16)
        local[used] = np.arange(len(used))
        here = local.take(text)
        asked = self._asked(here, len(used))
        a = self._pairs(used).take(asked)
        a += self.bias
        np.exp(a, out=a)
        dense, value, order, last, to, mean, h, at = self._forward(text, a)
        many, each, of = max(1, len(to)), np.arange(len(to)), self.of.take(to)
        groups, dz = len(p["b"]), self._logits(h, at)
        np.exp(dz, out=dz)
        dz *= np.reciprocal(dz @ self.halves) @ self.halves.T
        dz[each, groups + of % self.wide] -= 1
        dh, g = np.empty_like(h), {"O": np.zeros_like(p["O"]), "b": np.zeros_like(p["b"]), "I": np.zeros_like(p["I"]), "i": np.zeros_like(p["i"])}
        for j in np.flatnonzero(np.diff(at)):
            own, there = dz[at[j] : at[j + 1]], h[at[j] : at[j + 1]]
            own[:, j] -= 1
            np.matmul(own, self.out[j].T, out=dh[at[j] : at[j + 1]])
            to_out, to_shift = there.T @ own, np.ones(len(own), own.dtype) @ own
            g["O"] += to_out[:, :groups]
            g["b"] += to_shift[:groups]
            g["I"][j], g["i"][j] = to_out[:, groups:], to_shift[groups:]
        h *= h
        np.subtract(1, h, out=h)
        dh *= h
        dm = dh @ p["H"][d:].T
        dmean, dot = np.zeros((a.size // a.shape[-1], d), dm.dtype), np.zeros(a.size // a.shape[-1], dm.dtype)
        dmean[order] = dm
        dot[order] = np.einsum("ij,ij->i", dm, mean)
        dmean = dmean.reshape(*dense.shape[:3], d)
        ds = self._band(dmean @ value.transpose(0, 1, 3, 2)) - dot.reshape(a.shape[:-1])[..., None]
        ds *= a
        g["D"] = np.bincount(self.back.ravel(), ((np.ones(ds.size // self.seen.size, ds.dtype) @ ds.reshape(-1, self.seen.size)).reshape(self.seen.shape) * self.seen).ravel(), self.window)
        pairs = np.bincount(asked.ravel(), ds.ravel(), len(used) ** 2).reshape(len(used), len(used)).astype(ds.dtype)
        # what the tiles say of a place is added, then by id
        told, made = dense.transpose(0, 1, 3, 2) @ dmean, np.zeros((*text.shape, d), dmean.dtype)
        long = dense.shape[2]
        for k in range(0, told.shape[2], long):
            size = min(long, told.shape[2] - k)
            a, b, c = made.strides
            there = np.lib.stride_tricks.as_strided(made[:, k:], (*told.shape[:2], size, d), (a, long * b, b, c))
            there += told[:, :, k : k + size]
        e, q, k = (t.take(used, 0) for t in (p["E"], self.query, self.key))
        dv, do = _sums(here.ravel(), made.reshape(-1, d), len(used)), _sums(local.take(last), dh, len(used))
        dq, dk = pairs @ k, pairs.T @ q
        g["Q"], g["K"], g["V"], g["g"] = e.T @ dq, e.T @ dk, e.T @ dv, np.ones(len(do), do.dtype) @ do
        g["H"] = np.concatenate([e.T @ do, mean.T @ dh])
        g["E"] = np.zeros_like(p["E"])
        g["E"][used] = dq @ p["Q"].T + dk @ p["K"].T + dv @ p["V"].T + do @ p["H"][:d].T
        return {k: v / many for k, v in g.items()}, len(to)

    def prior(self) -> np.ndarray:
        """Log probability of each id by the biases alone."""
        return self.p["b"][self.of // self.wide] + self.p["i"].ravel()[self.of] + self.inner

    def _train(self, x, y, steps, batch, rate, r):
        if not len(x):
            return
        text = np.where((both := np.concatenate([x[:, : self.window - self.stride], y], 1)) < 0, self.n, both).astype(np.int16)  # a window is a segment
        step = self.steps()
        for t in range(1, steps + 1):
            step(text[r.integers(0, len(x), batch)], rate * min(1, t / 20) * (1 - 0.9 * t / steps))

    def steps(self):
        """A function that makes one step of Adam on segments, at a rate; it returns the number of targets."""
        names, t = sorted(self.p), 0
        all_of = self.flat()  # the parameters are views of it from here on
        m, v, g, by, scaled = (np.zeros_like(all_of) for _ in range(5))

        def views(flat):
            parts = np.split(flat, np.cumsum([self.p[k].size for k in names])[:-1])
            return {k: part.reshape(self.p[k].shape) for k, part in zip(names, parts)}

        into, self.p = views(g), views(all_of)

        def step(text, rate):
            nonlocal t
            t += 1
            self.freeze()
            grads, many = self._gradients(text)
            for k, grad in grads.items():
                into[k][...] = grad
            for mean, beta, new in ((m, 0.9, g), (v, 0.99, np.multiply(g, g, out=by))):
                mean *= np.float32(beta)
                mean += np.multiply(new, np.float32(1 - beta), out=scaled)
            np.sqrt(np.multiply(v, np.float32(1 / (1 - 0.99**t)), out=by), out=by)
            np.add(by, np.float32(1e-8), out=by)
            np.divide(m, by, out=by)
            np.multiply(by, np.float32(rate / (1 - 0.9**t)), out=by)
            np.subtract(all_of, by, out=all_of)
            return many

        return step

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def move(self, by: np.ndarray):
        """Adds to all parameters, in the order of flat()."""
        at = 0
        for k in sorted(self.p):
            a = self.p[k]
            self.p[k] = a + by[at : at + a.size].reshape(a.shape).astype(np.float32)
            at += a.size
        self.freeze()

    def freeze(self):
        """With one layer, keys, values, queries and the last id's part of the hidden layer depend on the id alone: tables."""
        p, d = self.p, self.p["E"].shape[1]
        self.key, self.value, self.query = (p["E"] @ p[k] for k in "KVQ")
        self.own = p["E"] @ p["H"][:d] + p["g"]
        self.bias = np.where(self.seen, p["D"][self.back], -100).astype(np.float32)
        self.shares = None
        groups = len(p["b"])
        self.out = np.concatenate([np.broadcast_to(p["O"], (groups, *p["O"].shape)), p["I"]], 2)
        self.shift = np.concatenate([np.broadcast_to(p["b"], (groups, groups)), p["i"]], 1)
        self.halves = (np.arange(groups + self.wide)[:, None] >= groups) == np.array([False, True])
        self.halves = self.halves.astype(p["O"].dtype)
        # logits are at most so large, as the hidden layer is within -1 and 1; beyond, they are cut before np.exp
        self.steep = bool((np.abs(self.out).sum(1) + self.shift).max() > 80)

    def all_pairs(self) -> np.ndarray:
        """Of all pairs of ids by rank, so that frequent ones lie together, the exponentials that attention shares out; made once for a frozen model."""
        if self.shares is None:
            self.shares = np.exp(self._pairs(np.argsort(self.rank)))
        return self.shares

    def score(self, ids: np.ndarray, offsets: np.ndarray, width: int = 32) -> np.ndarray:
        """log10 probability of each text."""
        text, doc = self.segments(ids, offsets)
        each, pairs = np.zeros((len(text), SEGMENT)), self.all_pairs()
        decay = np.where(self.seen, np.exp(self.bias), 0).astype(pairs.dtype)
        for a in range(0, len(text), width):
            asked = pairs.take(self._asked(self.rank.take(text[a : a + width]), self.n + 1))
            asked *= decay
            _, _, order, _, to, _, h, at = self._forward(text[a : a + width], asked)
            z = self._logits(h, at)
            got = self.inner.take(to) + z[np.arange(len(z)), len(at) - 1 + self.of.take(to) % self.wide]
            for j in np.flatnonzero(np.diff(at)):
                got[at[j] : at[j + 1]] += z[at[j] : at[j + 1], j]
            np.exp(z, out=z)
            got -= np.log(z @ self.halves) @ np.ones(2, z.dtype)
            sums = each[a : a + width]
            sums += np.bincount(order // self.stride, got, sums.size).reshape(sums.shape)
        return np.bincount(doc, each.ravel()[: len(doc)], len(offsets) - 1) / np.log(10)


def _tanh(z: np.ndarray) -> np.ndarray:
    """In place; np.exp is several times as fast as np.tanh."""
    z += z
    with np.errstate(over="ignore"):  # infinity gives 1
        np.exp(z, out=z)
    z += 1
    np.divide(-2, z, out=z)
    z += 1
    return z


def _sums(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each id below n."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(ids):
        order = np.argsort(ids, kind="stable")
        ids = ids.take(order)
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        kind = np.result_type(rows, np.complex64) if rows.shape[1] % 2 == 0 else rows.dtype  # two columns at a time
        out.view(kind)[ids[first]] = np.add.reduceat(rows.take(order, 0).view(kind), first, 0)
    return out


# ---------------------------------------------------------------- Spark

def word_counts(train: DataFrame) -> DataFrame:
    """h, c: the count of each word (as a 64-bit hash) over train(text).  Counted within a task, then summed."""

    def count(batches):
        hashes, counts, held = [], [], 0

        def merged():
            h, at = np.unique(np.concatenate(hashes), return_inverse=True)
            return h, np.bincount(at, np.concatenate(counts), len(h)).astype(np.int64)

        for b in batches:
            data, offsets = utf8(b.column(0))
            for _, _, own, _ in word_hashes(data, offsets):
                h, n = np.unique(own, return_counts=True)
                hashes.append(h)
                counts.append(n)
                held += len(h)
            if held > 1 << 22:
                h, n = merged()
                if len(h) > 1 << 21:  # mostly new words: hand over what there is
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "c"])
                    h, n = h[:0], n[:0]
                hashes, counts, held = [h], [n], len(h)
        if hashes:
            h, n = merged()
            for i in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(h[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], ["h", "c"])

    return train.select(F.col("text").cast("string")).filter("text is not null").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the words whose count reaches the least threshold that at most `most` words reach."""
    sizes = counts.groupBy(F.floor(F.log2("c") * 8).alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("k")).collect()
    total, cut_at = 0, None
    for r in sizes:
        total += r.n
        if total > most:
            break
        cut_at = r.k
    if cut_at is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = counts.filter(F.floor(F.log2("c") * 8) >= int(cut_at)).toPandas()
    h, c = rows.h.to_numpy(np.int64).view(np.uint64), rows.c.to_numpy(np.int64)
    by = np.argsort(h)
    return h[by], c[by]


def gather(train: DataFrame, pieces: Pieces, window: int = WINDOW, stride: int = STRIDE, rate: float = np.inf, least: int = LEAST, few: int = FEW) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The count of every id over all of train(doc_id, text); inputs and targets of the drawn windows."""
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    share = min(1.0, max(1 / rate, least / max(1.0, (sizes.bytes or 0) / 3 / stride)))  # an id has about three bytes
    most = max(few, -(-4 * least // max(1, sizes.n)))
    width = window - 1 + stride
    record = np.dtype([("hash", "<u8"), ("ids", "<i2", width)])

    def run(batches):
        counts = np.zeros(pieces.n, np.int64)
        for b in batches:
            data, offsets = utf8(b.column(1))
            seeds = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, j in slices(offsets):
                ids, at = pieces.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                counts += np.bincount(ids, minlength=pieces.n)
                n = -(-np.diff(at) // stride)
                doc, first = np.repeat(np.arange(j - i), n), np.repeat(np.cumsum(n) - n, n)
                h = mix(seeds[i:j][doc] + np.arange(len(doc), dtype=np.uint64) - first.astype(np.uint64), 5)
                own = np.flatnonzero(h < np.uint64(min(2**64 - 1, int(share * 2**64))))
                own = own[np.lexsort((h[own], doc[own]))]
                own = own[np.arange(len(own)) - np.searchsorted(doc[own], doc[own]) < most]
                if len(own):
                    made = np.empty(len(own), record)
                    _, x, y = blocks(ids, at, pieces.n, window, stride, own)
                    made["hash"], made["ids"] = h[own], np.concatenate([x, y], 1)
                    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int32()), pa.array([None], pa.int64()), pa.array([made.tobytes()], pa.binary())], ["id", "c", "windows"])
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int32()), pa.array(counts[have]), pa.nulls(len(have), pa.binary())], ["id", "c", "windows"])

    text = F.col("text").cast("string")
    made = cut(train.select(F.xxhash64(F.col("doc_id"), text), text).mapInArrow(run, "id int, c long, windows binary"))
    counts = np.zeros(pieces.n, np.int64)
    for r in made.filter("id is not null").groupBy("id").agg(F.sum("c").alias("c")).collect():
        counts[r.id] = r.c
    rows = made.filter("windows is not null").select("windows").toLocalIterator()  # one file of windows at a time
    drawn = np.frombuffer(b"".join(r.windows for r in rows), record)
    by = np.lexsort((drawn["ids"][:, 0], drawn["ids"][:, -1], drawn["hash"]))  # the same order however the rows were dealt
    ids = drawn["ids"][by]
    return counts, (ids[:, : window - 1], ids[:, window - 1 :])


def fit(model: Attention, train: DataFrame, pieces: Pieces, total: int, rounds: int = ROUNDS, rate: float = 0.004) -> int:
    """Takes the model on over every window of train(doc_id, text), which has `total` ids; returns the number of ids it was fitted to.

    Every text is in one round, by hash.  In a round each task goes on from the shared model over all windows of its
    texts, a segment of them at a time, and the tasks' changes are averaged by the ids they saw: sums of whole numbers,
    parameter by parameter, so their order doesn't matter and what reaches the driver has the size of the model.
    """
    spark, text, seen = train.sparkSession, F.col("text").cast("string"), 0
    given = train.select(F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(rounds)).alias("round"), text.alias("text"))
    unit = 2.0**50 / max(1, total)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches, step_rate=rate * (1 - r / rounds), shared=shared):
            own = copy.deepcopy(shared.value)
            start, step, many, t = own.flat().astype(float), own.steps(), 0, 0
            random = np.random.default_rng(7)
            for b in batches:
                data, offsets = utf8(b.column(0))
                for i, j in slices(offsets):
                    segments, _ = own.segments(*pieces.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                    for k in np.array_split(random.permutation(len(segments)), -(-len(segments) // SEGMENTS)):
                        t += 1
                        many += step(segments[k], step_rate * min(1, t / 20))
            if many:
                moved = np.append(np.rint((own.flat() - start) * (many * unit)).astype(np.int64), many)
                for k in range(0, len(moved), 10_000):
                    part = moved[k : k + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, k + len(part), dtype=np.int32)), pa.array(part)], ["at", "v"])

        rows = given.filter(F.col("round") == r).select("text").mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
        shared.unpersist()
        if len(rows):
            sums = rows.sort_values("at").v.to_numpy(np.int64)
            model.move(sums[:-1] / (sums[-1] * unit))
            seen += int(sums[-1])
    return seen


def train_model(train: DataFrame, pieces_path: str, steps: int = STEPS) -> tuple[Pieces, Attention]:
    """A model started on drawn windows, then fitted to all; without steps, the shares of the ids alone."""
    pieces = Pieces(pieces_path)
    counts, windows = gather(train, pieces)
    model = Attention(np.empty(0, np.int32), np.zeros(1, np.int64), pieces.n, steps=steps, counts=counts, windows=windows)
    if steps:
        fit(model, train, pieces, int(counts.sum()))
    return pieces, model


def score(docs: DataFrame, train: DataFrame, pieces_path: str, head: int = HEAD) -> DataFrame:
    """Columns of docs(doc_id, held_out, text) but text, and n_tokens, n_known, train_tokens, base_score, score, which replace columns of these names.

    Other columns stay, whatever their names.  Repeated rows are scored each; without training texts all words are unknown.
    """
    spark = docs.sparkSession
    counts = cut(word_counts(train))
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = train.count()  # one end a document
    n, v = int(totals.n or 0) + ends, int(totals.v or 0) + (1 if ends else 0)
    base = float(np.log10(float(n) + v + 1))  # the denominator N + 1 * (V + 1)
    shared = spark.sparkContext.broadcast((*_head(counts, head), *train_model(train, pieces_path)))
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in docs.columns if c not in ("text", *made)]
    given = numbered(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string")))  # c0, c1, ...: no name of ours is among them

    def run(batches):
        have, many, pieces, model = shared.value
        logs = np.log10(many + 1.0)
        for b in batches:
            data, offsets = utf8(b.column(len(keep)))
            rows: list = [[], [], [], [], [], []]
            for i, j, own, at in word_hashes(data, offsets):
                k = np.diff(at)
                doc = np.repeat(np.arange(j - i), k)
                if len(have):
                    where = np.minimum(np.searchsorted(have, own), len(have) - 1)
                    hit = have[where] == own
                    gain = np.bincount(doc[hit], logs[where[hit]], j - i)
                else:
                    hit, gain = np.zeros(len(own), bool), np.zeros(j - i)
                known = np.bincount(doc[hit], minlength=j - i) + (1 if ends else 0)
                miss, to = own[~hit].view(np.int64), np.concatenate(([0], np.cumsum(np.bincount(doc[~hit], minlength=j - i))))
                ids, ido = pieces.ids(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                rows[0] += (k + 1).tolist()
                rows[1] += known.tolist()
                rows[2] += (gain + np.log10(ends + 1.0) - (k + 1) * base).tolist()
                rows[3] += model.score(ids, ido).tolist()
                rows[4].append(miss)
                rows[5].append(np.diff(to))
            sizes = np.concatenate([[0], *rows[5]]) if rows[5] else np.zeros(1)
            tail = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(rows[4]) if rows[4] else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in range(len(keep))), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.float64()), pa.array(rows[3], pa.float64()), tail], schema.names)

    own = [f"c{i}" for i in range(len(keep))]
    schema = given.select(*own).schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double").add("tail", T.ArrayType(T.LongType()))
    scored = given.mapInArrow(run, schema)
    scored = cut(scored.withColumn("_row", F.monotonically_increasing_id()))
    # words outside the head: joined by hash, summed by row; a word no training text has adds log10(0 + 1) = 0
    tail = scored.select("_row", F.explode("tail").alias("h")).groupBy("_row", "h").agg(F.count(F.lit(1)).alias("tf"))
    tail = tail.join(counts, "h").groupBy("_row").agg(F.sum("tf").alias("known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("gain"))
    out = scored.drop("tail").join(tail, "_row", "left")
    return out.select(*[F.col(c).alias(k) for c, k in zip(own, keep)], "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"), "score")
