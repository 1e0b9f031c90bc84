"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: numbers (with a unit that follows) and capitalised names inside a sentence turn into
typed placeholders, the rest is lower-cased words.  Names in a row are one placeholder, as a number and its unit are, so
that other names or units leave the template's length as it is.  Windows of `window` template words are hashed, and a hash
join finds items whose templates recur in a document, verbatim or with other numbers, names or units.
An item is a leak when at least `share` of its distinct windows recur, and the slots agree: over
the matched windows that hold placeholders, an item's slot value always meets the same value in the
document, for at least `share` of the slots (verbatim copies agree with themselves).

Only (doc_id, position, hash) rows are exploded; a window's words are read again where a hash met.

Items shorter than a window are one window of their own length, met by a hash join at that length inside any text;
where such a template has placeholders only, their values must be the same too.  Null and empty texts match nothing.  Results are per distinct
(doc_id, item_id), a null doc_id included: repeated rows count once, and of different texts under one doc_id each is judged by itself, the
fullest match is told.  Empty tables give no rows.  Very long texts are one row of words each.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import beside, cut

#: Units that may follow a number.
UNITS = "km|cm|mm|kg|mg|ml|lb|lbs|oz|ft|mph|kph|miles?|meters?|metres?|grams?|liters?|litres?|hours?|minutes?|seconds?|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|usd|eur"
#: Broadcast the item windows up to so many; beyond that both sides are shuffled.
BROADCAST_ROWS = 200_000
NUMBER, UNIT, NAME, JOIN = "\u0001", "\u0002", "\u0003", "\u0004"


def let(value: Column, body) -> Column:
    """body(value) with value computed once: inside a lambda it is a variable, not a copied expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def written(text: Column) -> Column:
    """Words as written, lower case; a word that fills a slot has its placeholder before it."""
    t = F.coalesce(text, F.lit(""))
    t = F.when(F.rlike(t, F.lit(f"[{NUMBER}-{JOIN}]")), F.translate(t, NUMBER + UNIT + NAME + JOIN, "    ")).otherwise(t)
    t = F.when(F.rlike(t, F.lit(r"\d")), F.regexp_replace(F.regexp_replace(F.regexp_replace(t, rf"(?i)(\d)[ \t]*({UNITS})\b", f"$1 {UNIT}$2"), r"(\d)[.,](?=\d)", "$1_"), r"(?<![\p{L}\d_])(?=\d)", NUMBER)).otherwise(t)
    t = F.when(F.contains(t, F.lit(UNIT)), F.regexp_replace(t, rf" {UNIT}(?<={NUMBER}[\d_]{{1,255}} {UNIT})", JOIN)).otherwise(t)
    t = F.regexp_replace(t, r"(?<=\p{Ll}[,;]? )(?=\p{Lu}\p{Ll})", NAME)
    t = F.regexp_replace(t, rf" {NAME}(?<={NAME}[\p{{L}}\p{{N}}_]{{1,255}} {NAME})", JOIN)
    return F.filter(F.split(F.lower(t), f"[^\\p{{L}}\\p{{N}}_{NUMBER}{UNIT}{NAME}{JOIN}]+"), lambda w: w != "")


def window_hashes(words: Column, window: int) -> Column:
    """64-bit hash of each window of template words, built by doubling: 1, 2, 4, ... words at a time."""

    def longer(out: Column | None, done: int, h: Column, width: int, left: int) -> Column:
        """out: hashes of the first `done` words of each window; h: of `width` words; left: what is to come, in units of width."""
        if left & 1:
            out = h if out is None else F.zip_with(out, F.slice(h, done + 1, F.greatest(F.lit(1), F.size(h))), lambda a, b: F.xxhash64(a, b))
            done += width
        left >>= 1
        if not left:
            return out
        twice = F.zip_with(h, F.slice(h, width + 1, F.greatest(F.lit(1), F.size(h))), lambda a, b: F.xxhash64(a, b))
        if out is None:
            return let(twice, lambda x: longer(None, done, x, 2 * width, left))
        return let(twice, lambda x: longer(out, done, x, 2 * width, left))

    template = F.transform(words, lambda w: F.xxhash64(F.when(w < "\u0004", F.substring(w, 1, 1)).otherwise(w)))
    return let(template, lambda h: F.slice(longer(None, 0, h, 1, window), 1, F.greatest(F.least(F.size(h), F.lit(1)), F.size(h) - window + 1)))


def leaks(docs: DataFrame, items: DataFrame, window: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_windows (item's distinct windows), n_found, slots, consistent for each leaked item of docs(doc_id, text), items(item_id, text)."""
    own = items.filter("text is not null").select("item_id", written(F.col("text")).alias("words")).withColumn("width", F.least(F.lit(window), F.size("words")))
    widths = sorted({window, *(r.width for r in own.filter(F.col("width") > 0).select("width").distinct().collect())})
    made = [own.filter(F.col("width") == w).select("item_id", F.posexplode(window_hashes(F.col("words"), w)).alias("at", "h"), "words", "width") for w in widths]
    keys = reduce(DataFrame.unionByName, made).select("item_id", "at", "h", F.slice("words", F.col("at") + 1, F.col("width")).alias("item_words"), "width")
    sizes = keys.groupBy("item_id").agg(F.countDistinct("h").alias("n_windows"))
    n = keys.limit(BROADCAST_ROWS + 1).count()
    small = (lambda df: F.broadcast(df)) if n <= BROADCAST_ROWS else (lambda df: df)

    # a text is known by its own hash: rows that share a doc_id are not taken for one another
    text = docs.select("doc_id", "text").filter("text is not null").withColumn("own", F.xxhash64("doc_id", "text"))

    def windows_met(width: int) -> DataFrame:
        """own, doc_id, h, words of the documents' windows of `width` words that items of that width have too."""
        hashes = keys.filter(F.col("width") == width).select("h").distinct()
        found = cut(text.select("own", let(written(F.col("text")), lambda w: window_hashes(w, width)).alias("hashes")).select("own", F.posexplode("hashes").alias("pos", "h")).join(small(hashes), "h", "left_semi").select("own", "pos", "h"))
        # the words of the windows that met, read again from the few texts that hold them
        places = found.groupBy("own").agg(F.collect_set(F.struct("pos", "h")).alias("places"))
        again = beside(text, places, "own", "places", sparse=True).select("own", "doc_id", written(F.col("text")).alias("words"), "places")
        own_words = F.transform("places", lambda x: F.struct(x["h"].alias("h"), F.slice("words", x["pos"] + 1, width).alias("words")))
        return again.select("own", "doc_id", F.explode(own_words).alias("x")).select("own", "doc_id", "x.h", "x.words", F.lit(width).alias("width")).distinct()

    found = reduce(DataFrame.unionByName, [windows_met(w) for w in widths])
    met = found.join(small(keys), ["width", "h"])
    # a short item of slots only would meet any number or name
    met = met.filter((F.col("width") == window) | F.exists("item_words", lambda w: w >= JOIN) | (F.col("item_words") == F.col("words")))
    slot = F.filter(F.arrays_zip(F.col("item_words").alias("i"), F.col("words").alias("d")), lambda x: x["i"] < JOIN)
    met = met.select("own", "doc_id", "item_id", "h", "at", slot.alias("slots"))
    shares = met.groupBy("own", "doc_id", "item_id").agg(F.countDistinct("h").alias("n_found")).join(small(sizes), "item_id").filter(F.col("n_found") >= F.lit(share) * F.col("n_windows"))
    slots = met.select("own", "item_id", F.explode("slots").alias("s")).groupBy("own", "item_id", F.col("s.i").alias("i"), F.col("s.d").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = slots.groupBy("own", "item_id", "i").agg(F.max("n").alias("best"), F.sum("n").alias("n"))
    best = best.groupBy("own", "item_id").agg(F.sum("n").alias("slots"), F.sum("best").alias("consistent"))
    out = shares.join(best, ["own", "item_id"], "left").fillna(0, ["slots", "consistent"]).filter(F.col("consistent") >= F.lit(share) * F.col("slots"))
    fullest = F.max(F.struct("n_found", "consistent", (-F.col("slots")).alias("s")))
    return out.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), fullest.alias("f")).select("doc_id", "item_id", "n_windows", "f.n_found", (-F.col("f.s")).alias("slots"), "f.consistent")
