"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule's Boolean trigram query is derived from its regular expression: the pattern is read into stretches of literal
text that every match must hold, each a set of alternatives; the query is an OR over the alternatives of the longest
stretch, of the AND of their trigrams.  The index is a table of postings (trigram, row) of the lower-cased texts,
for the trigrams that any query names, written to the shared folder.  The postings of an alternative's trigrams are
intersected by grouping them by row; the rows that satisfy a rule's query are its candidates, and they alone are
verified with the regular expression.  A rule without a mandatory trigram scans every document.

Null and empty texts have no spans.  Every match counts, in texts of any length.  Positions are code
points, ends exclusive.  Rows are named by a hash of doc_id and text: repeated rows share it and have the same spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import beside, cut


@dataclass(frozen=True)
class Rule:
    """kind; regular expression of Java and Python; group and least length to keep a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The base rules, in the order of the contract, and further public key formats.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: Alternatives that a stretch may have; beyond that it ends.
MOST = 64


def _parts(pattern: str) -> list:
    """The pattern as alternatives, each a list of (atom, least, most): an atom is a set of characters, a list like this, or None for any other."""
    at = 0

    def alternatives():
        nonlocal at
        out = [[]]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                out.append([])
            else:
                atom = one()
                out[-1].append((atom, *times()))
        return out

    def one():
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "(":
            if m := re.compile(r"\?[a-z]*:").match(pattern, at):
                at = m.end()
            elif pattern[at] == "?":
                raise ValueError(f"look-around in {pattern}")
            inside = alternatives()
            at += 1
            return inside
        if c == "[":
            m = re.compile(r"(\^?)((?:\\x[0-9A-Fa-f]{2}|\\.|[^\]\\])+)\]").match(pattern, at)
            at = m.end()
            plain = re.findall(r"\\.|[^\\]", m[2])
            return None if m[1] or any(x in m[2] for x in ("-", "\\x")) and len(m[2]) > 1 or any(x[0] == "\\" and x[1].isalnum() for x in plain) else {x[-1].lower() for x in plain}
        if c == "\\":
            if pattern[at] == "x":
                at += 3
                return {chr(int(pattern[at - 2 : at], 16)).lower()}
            at += 1
            return None if pattern[at - 1].isalnum() else {pattern[at - 1]}
        return None if c in ".^$" else {c.lower()}

    def times():
        nonlocal at
        m = re.compile(r"([*+?]|\{([0-9]+)(,?)([0-9]*)\})[?+]?").match(pattern, at)
        if not m:
            return 1, 1
        at = m.end()
        if m[1] in "*+?":
            return {"*": (0, None), "+": (1, None), "?": (0, 1)}[m[1]]
        return int(m[2]), int(m[2]) if not m[3] else int(m[4]) if m[4] else None

    return alternatives()


def _exact(atom) -> set[str] | None:
    """All strings of an atom, if they are few."""
    if atom is None or isinstance(atom, set):
        return atom
    out: set[str] = set()
    for own in atom:
        made = {""}
        for inner, least, most in own:
            few = _exact(inner)
            if few is None or most is None or most > 3:
                return None
            made = {x + y for x in made for n in range(least, most + 1) for y in (few if n else {""}) for y in [y * n]} if len(few) == 1 or most < 2 else None
            if made is None or len(made) > MOST:
                return None
        out |= made
    return out if len(out) <= MOST else None


def trigram_query(pattern: str) -> list[list[str]]:
    """OR of ANDs of the trigrams that a match of the pattern must hold, lower-cased; [] if there is no mandatory one."""
    ways = _parts(pattern)
    if len(ways) > 1:
        few = _exact(ways)
        stretches = [few] if few else []
    else:
        stretches, now = [], {""}
        for atom, least, most in ways[0]:
            few = _exact(atom)
            if few is not None and most == 1:
                made = {x + y for x in now for y in (few | {""} if least == 0 else few)}
                if len(made) <= MOST:
                    now = made
                    continue
            once = {x + y for x in now for y in few} if few is not None and least >= 1 else now
            stretches.append(once if len(once) <= MOST else now)  # up to the first copy of a repeated atom
            now = few if few is not None and least >= 1 else {""}  # and from the last one on
        stretches.append(now)
    best = max(stretches, key=lambda s: min(map(len, s)), default={""})
    if min(map(len, best)) < 3:
        return []
    least = [x for x in best if not any(y != x and y in x for y in best)]  # a longer alternative asks for no less
    return [sorted({x[i : i + 3] for i in range(len(x) - 2)}) for x in sorted(least)]


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: (trigram, row) of rows(row, text) for each of the trigrams that the lower-cased text holds, once."""
    low = F.col("low")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams])) if trigrams else F.array().cast("array<string>")
    return rows.select("row", F.lower("text").alias("low")).select(F.explode(held).alias("trigram"), "row")


def candidates(index: DataFrame, queries: dict[int, list[list[str]]]) -> DataFrame:
    """(row, rules): the rules whose query the row's postings satisfy, by intersecting the posting lists of each alternative."""
    asked = [(t, f"{rule}-{i}", rule, len(own)) for rule, ways in queries.items() for i, own in enumerate(ways) for t in own]
    wanted = index.sparkSession.createDataFrame(asked, "trigram string, way string, rule int, n int")
    met = index.join(F.broadcast(wanted), "trigram").groupBy("row", "way", "rule", "n").agg(F.countDistinct("trigram").alias("m")).filter("m = n")
    return met.groupBy("row").agg(F.collect_set("rule").alias("rules"))


#: Matches gathered in one array before they are put behind the others.
FOLD = 256


def let(value: Column, body) -> Column:
    """body(value) with value computed once: inside a lambda it is a variable, not a copied expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(rule: Rule, at: int) -> Column:
    """Kept matches of rule as an array of (start, rank of kind, end, kind).

    The gaps between matches (a split) and the matches themselves give positions by their lengths.
    """
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.split("text", rule.pattern, -1)
    rows = F.arrays_zip(gaps.alias("gap"), whole.alias("match"), group.alias("group"))
    kind = "struct<pos:int,spans:array<struct<start:int,rank:int,end:int,kind:string>>>"
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def step(acc, x):
        start = acc["pos"] + F.char_length(x["gap"])
        end = start + F.coalesce(F.char_length(x["match"]), F.lit(0))
        found = F.struct(start.alias("start"), F.lit(at).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        good = x["match"].isNotNull() & (F.char_length(x["group"]) >= rule.least)
        return F.struct(end.alias("pos"), F.when(good, F.array_append(acc["spans"], found)).otherwise(acc["spans"]).alias("spans")).cast(kind)

    def stretch(acc, i, own):
        """FOLD matches more: their spans are gathered by themselves and put behind the others at once, as each append copies its array."""
        begin = F.struct(acc["pos"].alias("pos"), none.alias("spans")).cast(kind)
        made = F.aggregate(F.slice(own, i * FOLD + 1, F.lit(FOLD)), begin, step)
        return let(made, lambda m: F.struct(m["pos"].alias("pos"), F.concat(acc["spans"], m["spans"]).alias("spans")).cast(kind))

    zero = F.struct(F.lit(0).alias("pos"), none.alias("spans")).cast(kind)
    return let(rows, lambda own: F.aggregate(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / FOLD).cast("int")), zero, lambda acc, i: stretch(acc, i, own), lambda acc: acc["spans"]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text and spans: array of (start, rank, end, kind), by start, then rules' order, one row for each row of docs."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    if queries:
        index = cut(postings(rows, sorted({t for q in queries.values() for own in q for t in own})))
        rows = beside(rows, candidates(index, queries), "row", how="left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<int>"))
    found = [F.when((F.coalesce(F.array_contains("rules", i), F.lit(False)) if i in queries else F.lit(True)) & F.rlike("text", F.lit(r.pattern)), _spans(r, i)).otherwise(none) for i, r in enumerate(rules)]
    return rows.select("doc_id", "text", F.array_sort(F.concat(*found)).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
