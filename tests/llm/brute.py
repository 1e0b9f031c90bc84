"""Plain versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def digits(x):
    return re.sub(r"[^0-9]", "", x)


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        v = int(c) * (1 + i % 2)
        s += v // 10 + v % 10
    return s % 10 == 0


def pii(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def secrets(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(rows, k, percent):
    """doc_id -> (set size, component) for (doc_id, text) rows."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets)]
