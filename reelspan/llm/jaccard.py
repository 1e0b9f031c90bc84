"""Exact n-gram Jaccard join by a token-group matrix.

Two documents link when 100 * |A & B| >= threshold * |A | B| over their sets of word shingles.

* Equal sets form a class (64-bit signature of the set); only classes go on.
* Every class keeps its extended prefix: its rarest n - ceil(t*n) + m shingles in one total order.  Linked sets
  share at least m = 4 shingles of those prefixes (all they need to share, where that is fewer); sets too small
  for a link at the threshold link only when equal.
  Any total order gives exact results; this one puts shingles that many documents share last, by a
  bounded count sketch over the whole corpus.
* Similar classes are gathered into groups around pivots: the pivot of a prefix shingle is the class with the
  largest share of shared prefix shingles, the one nearest the middle of a set of copies.  A class joins the
  group of its most similar pivot (at the threshold less REACH, at least), and links with it at the threshold.
* The token-group matrix holds each group's union of prefix shingles and its range of set sizes; in it, the largest
  component of a group that the links with pivots make stands apart from the group's rest.  A class
  opens a group only if that has members of larger components, it meets the union m times and the sizes allow a link,
  and, once its set is compared with the pivot's, only if the triangle inequality of the Jaccard distance leaves
  room for a linked member.
* Inside an opened group a class is its difference from the pivot: the shingles that only one of the two has.
  Two differences D and E that share s entries belong to sets |D| + |E| - 2s shingles apart, which gives their
  Jaccard exactly.  links_in_groups() connects what is linked there by stars: every class meets the one
  nearest the group's middle, and those of each entry that several share meet again in a subgroup with a middle of
  its own; n copies of a text cost n small differences, not n * n pairs.
* Links are closed by connected components; classes already connected are not compared again.

Nulls and texts without words: an empty set, linked with nothing.  Repeated rows link like any equal sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspan.llm.common import BROADCAST_ROWS, PIECE, beside, cut, lean, mix, parts_of, shuffles_go, sifted, slices, utf8, word_hashes
from reelspan.llm.graph import components

#: Least and most bits of the count sketch; in between, four cells for each document.
SKETCH_BITS = (18, 22)
BLOCK = 1 << 12
#: Prefix shingles that linked sets share.
MEET = 4
#: How far under the threshold (in percent) a class may still join a pivot's group.
REACH = 20
#: Groups of so many classes are compared pair by pair; larger ones are split.
SMALL = 16
#: About so many members of a larger group choose its centre.
DRAWN = 24
#: Groups whose members have so many entries in all deal their askers by these entries alone.
FEW_ENTRIES = 1024


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text's word hashes (a shorter text is one shingle)."""
    if not len(words):
        return words
    n = max(1, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        total += mix(words[i : i + n], i + 1)
    out = np.sort(mix(total, 97 + min(k, len(words))))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def sets_of(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    data, offsets = utf8(texts)
    for a, b, hashes, at in word_hashes(data, offsets, PIECE):
        for i in range(b - a):
            yield shingles(hashes[at[i] : at[i + 1]], k)


def signature(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(mix(np.array([np.add.reduce(mix(s, 7)) + np.uint64(len(s))], np.uint64), 11).view(np.int64)[0])


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as hold the largest, compressed: a task's cells are as many as the sketch's, however few texts it has."""
    kind = np.min_scalar_type(int(counts.max()))
    return bytes([kind.itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"u{data[0]}")


def _sketch(docs: DataFrame, k: int, bits: int) -> np.ndarray:
    """A level for each of 2**bits cells: 0 for shingles that are not more frequent than chance."""

    def count(batches):
        cells = np.zeros(1 << bits, np.int64)
        for batch in lean(batches):
            for s in sets_of(batch.column(0), k):
                if len(s):
                    np.add.at(cells, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
        for at in range(0, len(cells), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK], pa.int32()), pa.array([packed(cells[at : at + BLOCK])], pa.binary())], ["block", "cells"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BLOCK, np.int64)  # a task sends each block once; they are added as they come
        for b in batches:
            for x in b.column("cells").to_pylist():
                total += unpacked(x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())], ["block", "cells"])

    with shuffles_go(docs.sparkSession):
        rows = docs.select("text").mapInArrow(count, "block int, cells binary").groupBy("block").applyInArrow(add, "block int, cells binary").collect()
    cells = np.zeros(1 << bits, np.int64)
    for r in rows:
        cells[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.cells, "<i8")
    usual = np.median(cells)
    noise = max(1.0, np.sqrt(usual))
    return np.minimum(255, np.floor(8 * np.log2(np.maximum(1.0, (cells - usual) / (4 * noise))))).astype(np.uint8)


def _signatures(docs: DataFrame, k: int, percent: int, level: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (null without words) and prefix (null for a class already met in this task)."""
    bits = int(level.value.nbytes).bit_length() - 1

    def sign(batches):
        order, met = level.value, set()
        for batch in lean(batches):
            ids, n, cls, prefix = batch.column(0), [], [], []
            for s in sets_of(batch.column(1), k):
                n.append(len(s))
                if not len(s):
                    cls.append(None)
                    prefix.append(None)
                    continue
                c = signature(s)
                cls.append(c)
                need = len(s) - -(-percent * len(s) // 100) + MEET
                if c in met or -(-percent * (len(s) + 1) // 100) > len(s):
                    prefix.append(None)
                    continue
                met.add(c)
                rank = order[(s >> np.uint64(64 - bits)).astype(np.int64)]
                chosen = np.lexsort((mix(s, 3), rank))[:need]
                prefix.append(s[chosen].view(np.int64))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "class", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, "doc_id long, n_shingles long, class long, prefix array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """wanted (class, doc_id, others) with the class's set instead of the doc_id."""
    names = [c for c in wanted.columns if c != "doc_id"]
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def load(batches):
        for batch in lean(batches):
            _, offsets = utf8(batch.column(len(names)))
            for first, last in slices(offsets, 1 << 22):  # sets are about as large as their texts
                b = batch.slice(first, last - first)
                sets = list(sets_of(b.column(len(names)), k))
                # another text under the same doc_id is not the class's
                own = [i for i, (c, s) in enumerate(zip(b.column(0).to_pylist(), sets)) if len(s) and signature(s) == c]
                rows = [c.take(pa.array(own, pa.int64())) for c in b.columns[: len(names)]]
                yield pa.RecordBatch.from_arrays([*rows, pa.array([sets[i].view(np.int64) for i in own], pa.list_(pa.int64()))], [*names, "set"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if not small:
        texts = sifted(texts, wanted, "doc_id")
    rows = texts.join(F.broadcast(wanted) if small else wanted, "doc_id").select(*names, "text")
    return rows.mapInArrow(load, ", ".join(f"`{c}` long" for c in names) + ", set array<long>")


def _compared(docs: DataFrame, pairs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """pairs (a, b) with na, nb, apart (shingles that only one of them has), more and less (those of a, of b, alone).  Each set travels once, to its b."""
    ids = classes.select("class", "doc_id")
    one = _sets(docs, cut(pairs.select(F.col("a").alias("class"), "b").join(ids, "class").select("class", "b", "doc_id")), k)
    two = _sets(docs, cut(pairs.select(F.col("b").alias("class")).distinct().join(ids, "class").select("class", "doc_id")), k)
    full = one.select(F.col("class").alias("a"), "b", F.col("set").alias("x")).join(two.select(F.col("class").alias("b"), F.col("set").alias("y")), "b")
    full = full.select("a", "b", F.size("x").cast("long").alias("na"), F.size("y").cast("long").alias("nb"), F.array_except("x", "y").alias("more"), F.array_except("y", "x").alias("less"))
    return full.withColumn("apart", (F.size("more") + F.size("less")).cast("long"))


def _jaccard_at_least(n, apart, percent):
    """Whether sets of n shingles in sum, `apart` of them in one set only, reach percent: (n - apart) / (n + apart)."""
    return F.lit(100) * (n - apart) >= F.lit(percent) * (n + apart)


def _symmetric(x: str, y: str):
    return F.concat(F.array_except(x, y), F.array_except(y, x))


def links_in_groups(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked between the askers and the members of each group of rows(g, a, c, n, d, asks).

    a is a class of n shingles in component c so far, d its symmetric difference from the group's centre; asks tells
    askers from members.  With w = (100 + percent) |d| - (100 - percent) n, classes whose differences share s entries
    link when their w sum to 2 (100 + percent) s or less.  So an asker that is linked with a member of another
    component with which it shares nothing is linked with the member of least w in another component, too: one
    comparison an asker finds what connects them.  Classes that share an entry meet again in the subgroup of that
    entry, without it.  Before that a group is centred on the entries that more than half of some DRAWN members have: any
    centre is right, this one keeps differences and subgroups small; groups of SMALL rows are compared pair by pair.  Subgroups of one component, or with the rows of
    another subgroup, go; a class enters those of its rarest entries only, as many as the bound on s asks for.  Entries of an
    asker that no member has lead to nobody: where the members have few, they are taken out before the entries are dealt.
    """
    scale = 100 + percent
    links = rows.select("a", F.col("c").alias("b")).limit(0)
    asked, met = F.when(F.col("asks"), F.col("c")), F.when(~F.col("asks"), F.col("c"))
    ends = [F.min(asked).alias("a0"), F.max(asked).alias("a1"), F.min(met).alias("b0"), F.max(met).alias("b1")]
    open_still = "a0 <> b1 or a1 <> b0"  # an asker and a member of different components
    state = cut(rows)
    while True:
        live = state.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("asks")).alias("members"), *ends).filter(open_still).select("g", "m", "members")
        state = cut(beside(state, live, "g"))
        small = state.filter(F.col("m") <= SMALL)
        x, y = (small.filter(kind).select("g", *[F.col(c).alias(f"{side}_{c}") for c in ("a", "c", "n", "d")]) for side, kind in (("x", "asks"), ("y", "not asks")))
        apart = F.size("x_d") + F.size("y_d") - 2 * F.size(F.array_intersect("x_d", "y_d"))
        pairs = x.join(y, "g").filter(f"x_c <> y_c and x_n * 100 >= {percent} * y_n and y_n * 100 >= {percent} * x_n")
        links = links.union(cut(pairs.filter(_jaccard_at_least(F.col("x_n") + F.col("y_n"), apart, percent)).select(F.col("x_a").alias("a"), F.col("y_a").alias("b")).distinct()))
        large = state.filter(F.col("m") > SMALL)
        if large.isEmpty():
            return links
        # the centre of each large group; the member nearest to it, and the nearest one of another component than that
        drawn = large.filter("not asks").filter(F.pmod(F.xxhash64("a"), F.col("members")) < DRAWN)
        n = drawn.groupBy("g").agg(F.count(F.lit(1)).alias("drawn"))
        often = drawn.select("g", F.explode("d").alias("t")).groupBy("g", "t").agg(F.count(F.lit(1)).alias("f")).join(n, "g").filter("2 * f > drawn")
        centre = large.select("g").distinct().join(often.groupBy("g").agg(F.collect_list("t").alias("centre")), "g", "left").select("g", F.coalesce("centre", F.array().cast("array<bigint>")).alias("centre"))
        large = beside(large, centre, "g", "centre").withColumn("d", _symmetric("d", "centre")).drop("centre", "m", "members")
        large = cut(large.withColumn("w", F.size("d") * scale - F.col("n") * (100 - percent)))
        members, nearest = large.filter("not asks"), F.min_by(F.struct("a", "c", "w", "d"), F.struct("w", "a"))
        one = cut(members.groupBy("g").agg(nearest.alias("x")))
        two = beside(members, one.select("g", F.col("x.c").alias("c1")), "g").filter("c <> c1").groupBy("g").agg(nearest.alias("y"))
        room = F.when(F.col("asks"), "asks").otherwise("met")
        bounds = large.groupBy("g").agg(F.min(F.when(F.col("asks"), F.col("w"))).alias("least"), *[F.max(F.when(room == x, F.size("d") * scale + F.col("n") * (100 - percent))).alias(f"most_{x}") for x in ("asks", "met")])
        both = one.join(two, "g", "left").join(bounds, "g")
        star = beside(large, both.withColumn("size", F.concat("x.d", F.coalesce("y.d", F.array().cast("array<bigint>")))), "g", "size")
        star = star.withColumn("x", F.when(F.col("x.c") != F.col("c"), F.col("x")).otherwise(F.col("y")))
        star = star.select("g", "a", "c", "n", "d", "asks", "w", F.when(F.col("asks"), F.col("x.w")).otherwise(F.col("least")).alias("other_w"), (F.col("w") <= F.when(F.col("asks"), F.col("most_met")).otherwise(F.col("most_asks"))).alias("near"), F.col("x.a").alias("x_a"), F.col("x.c").alias("x_c"), (F.col("asks") & (F.col("w") + F.col("x.w") <= 2 * scale * F.size(F.array_intersect("d", "x.d")))).alias("linked"))
        star = cut(star.filter("other_w is not null"))  # else every member is of the asker's component
        made = star.filter("linked")
        links = links.union(cut(made.select("a", F.col("x_a").alias("b"))))
        merged = components(made.select(F.col("c").alias("a"), F.col("x_c").alias("b")).distinct()).withColumnRenamed("node", "c")
        star = cut(beside(star, merged, "c", how="left").withColumn("c", F.coalesce("component", "c")).filter("near").select("g", "a", "c", "n", "d", "asks", "w", "other_w"))  # who is too far even if it shared all of a partner's entries goes
        # subgroups: by entries that askers and members of different components share
        dealt = star.select("g", "a", "c", "asks", F.greatest(F.lit(1), F.ceil((F.col("w") + F.col("other_w")) / (2 * scale))).alias("needed"), "d").filter(F.col("needed") <= F.size("d"))
        members, askers = dealt.filter("not asks"), dealt.filter("asks")
        few = members.groupBy("g").agg(F.sum(F.size("d")).alias("m"))
        held = beside(members, few.filter(F.col("m") <= FEW_ENTRIES).select("g"), "g").select("g", F.explode("d").alias("t")).groupBy("g").agg(F.collect_set("t").alias("held"))
        askers = beside(askers, few.join(held, "g", "left").select("g", "held"), "g", "held")  # a group without members goes
        askers = askers.withColumn("d", F.when(F.col("held").isNull(), F.col("d")).otherwise(F.array_intersect("d", "held"))).drop("held").filter(F.col("needed") <= F.size("d"))
        entries = cut(members.unionByName(askers)).withColumn("t", F.explode("d")).drop("d")
        useful = entries.groupBy("g", "t").agg(F.count(F.lit(1)).alias("f"), *ends).filter(open_still).select("g", "t", "f")
        entries = cut(entries.join(useful, ["g", "t"]))
        own = Window.partitionBy("g", "a", "asks")
        entries = cut(entries.withColumn("u", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("f", "t"))).filter("rank <= u - needed + 1").select("g", "a", "c", "asks", "t"))
        alike = entries.groupBy("g", "t").agg(F.bit_xor(F.xxhash64("a", "asks")).alias("rows"), F.count(F.lit(1)).alias("m"), *ends).filter(open_still).groupBy("g", "rows", "m").agg(F.min("t").alias("t")).select("g", "t")
        state = entries.join(alike, ["g", "t"]).select("g", "t", "a", "asks").join(star, ["g", "a", "asks"]).select(F.xxhash64("g", "t").alias("g"), "a", "c", "n", F.array_remove("d", F.col("t")).alias("d"), "asks")


def ngram_jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80, sketch_bits: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs(doc_id, text); links at percent / 100 Jaccard."""
    spark = docs.sparkSession
    if sketch_bits is None:
        sketch_bits = min(max(int(docs.count()).bit_length() + 2, SKETCH_BITS[0]), SKETCH_BITS[1])
    level = spark.sparkContext.broadcast(_sketch(docs, k, sketch_bits))  # 2**sketch_bits bytes
    signed = cut(_signatures(docs, k, percent, level))
    classes = cut(signed.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n")))

    # prefix shingles, shuffled once: those of a single class cannot link
    rows = signed.filter("prefix is not null").select(F.explode("prefix").alias("token"), "class").repartition(parts_of(docs), "token")
    shared = rows.groupBy("token").agg(F.min("class").alias("one"), F.max("class").alias("other")).filter("one < other").select("token")
    rows = cut(rows.join(shared, "token").select("token", "class").distinct())
    need = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + MEET
    central = rows.groupBy("class").agg(F.count(F.lit(1)).alias("m")).join(classes, "class").select("class", "n", F.floor(F.col("m") * 1000 / F.least(need, F.col("n"))).cast("long").alias("share"))
    rows = cut(rows.join(central, "class"))
    pivots = rows.groupBy("token").agg(F.max(F.struct("share", "class"))["class"].alias("pivot"))

    # groups: a class and its most similar pivot
    enough = F.least(F.lit(MEET), F.ceil(F.lit(percent) * F.col("n") / 100))
    near = rows.join(pivots, "token").filter("class <> pivot").groupBy("class", "n", "pivot").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= enough)
    near = cut(near.select(F.col("class").alias("a"), F.col("pivot").alias("b")))
    both = F.col("na") + F.col("nb")
    near = cut(_compared(docs, near, classes, k).filter(_jaccard_at_least(both, F.col("apart"), percent - REACH)).select("a", "b", "na", "nb", "apart"))
    links = near.filter(_jaccard_at_least(both, F.col("apart"), percent)).select("a", "b")
    joined = near.groupBy("a").agg(F.min(F.struct((F.col("apart") / both).alias("d"), "b"))["b"].alias("p")).select(F.col("a").alias("class"), "p")
    centres = joined.select(F.col("p").alias("class"), "p").distinct()
    alone = rows.select("class").distinct().join(joined.select("class"), "class", "left_anti").select("class", F.col("class").alias("p"))
    comp = components(links).withColumnRenamed("node", "class")
    members = joined.unionByName(centres).unionByName(alone).distinct().join(classes.select("class", "n"), "class")
    members = cut(members.join(comp, "class", "left").select("class", "p", "n", F.coalesce("component", "class").alias("c")))

    # what is connected already is not compared again: in each group the largest component apart from the rest
    sizes = members.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    members = cut(beside(members, sizes, "c").withColumn("key", F.struct("size", "c")))
    main = members.groupBy("p").agg(F.max("key").alias("main"))
    members = cut(beside(members, main, "p").withColumn("g", F.xxhash64("p", F.col("key") == F.col("main"))).select("class", "p", "n", "c", "key", "g"))

    # token-group matrix: union of prefixes, range of sizes and greatest key of each group
    matrix = rows.select("token", "class").join(members, "class").groupBy("token", "g", "p").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("key").alias("key"))
    fits = f"r.n * 100 >= {percent} * m.least and m.most * 100 >= {percent} * r.n"
    # of two classes of different components the one with the lesser key asks: that of the smaller component
    rows = rows.join(members.groupBy("class").agg(F.min("key").alias("key")), "class")
    opened = rows.alias("r").join(matrix.alias("m"), F.expr(f"r.token = m.token and r.key < m.key and {fits}")).groupBy("r.class", "r.n", "m.p", "m.g").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= enough)
    opened = cut(opened.select(F.col("class").alias("a"), F.col("p").alias("b"), "g"))
    asked = cut(opened.select("g").distinct())
    inside = members.join(asked, "g", "left_semi").select(F.col("class").alias("a"), F.col("p").alias("b"), "g")

    # differences from the pivots of opened groups
    wanted = cut(opened.select("a", "b").union(inside.select("a", "b")).filter("a <> b").distinct())
    found = cut(_compared(docs, wanted, classes, k).filter(_jaccard_at_least(both, F.col("apart"), max(0, 2 * percent - 100 - REACH))).select("a", "b", F.col("na").alias("n"), F.concat("more", "less").alias("d"), _jaccard_at_least(both, F.col("apart"), percent).alias("linked")))
    pivots = members.filter("class = p").select(F.col("class").alias("a"), F.col("p").alias("b"), "n", F.array().cast("array<bigint>").alias("d"))
    links = cut(links.union(found.filter("linked").select("a", "b")))
    comp = members.select("class").distinct().join(components(links).withColumnRenamed("node", "class"), "class", "left").select(F.col("class").alias("a"), F.coalesce("component", "class").alias("c"))
    roles = opened.withColumn("asks", F.lit(True)).union(inside.withColumn("asks", F.lit(False)))
    rows = roles.join(found.drop("linked").union(pivots), ["a", "b"]).join(comp, "a").select("g", "a", "c", "n", "d", "asks")
    group = components(cut(links.union(links_in_groups(rows, percent))))

    ids = classes.join(group.select(F.col("node").alias("class"), "component"), "class", "left").select("class", F.coalesce("component", "class").alias("component"), "doc_id")
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = cut(ids.join(least, "component").select("class", "component_id"))
    return signed.join(ids, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
