"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every item falls into windows of ten words (a shorter item is one window). A window is a set of three-word
shingles; it can occur in a document only if all of them do, so the one necessary prefix token is its rarest
shingle. Shingles are ordered by how often they stand in the corpus; only the prefix token is joined with the
documents, its place gives where the window would begin, bounds of position and length drop what cannot fit,
and what remains is compared word for word (128 bits of hash over the exact words).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithlink.llm.common import materialize

WINDOW = 10
SHINGLE = 3
#: What separates words once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which the join's small side is sent to every task (some 100 bytes a row); beyond, both sides are shuffled.
BROADCAST_ROWS = 300_000


def _split(lowered: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def exact_words(text: Column) -> Column:
    """Words with only A-Z made lower case."""
    return _split(F.translate(text, UPPER, LOWER))


def coarse_words(text: Column) -> Column:
    """The same number of words at the same places, all letters lower case: equal wherever exact words are, and cheaper."""
    return _split(_lowered(text))


def _lowered(text: Column) -> Column:
    """Lower case letter by letter. Only the capital sigma would depend on what stands around it, so it goes first."""
    return F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))


def _keys(words: str, size: int, lowered: bool = False) -> Column:
    """The hash of each run of `size` words; one that begins at each place where a run fits."""
    word = (lambda i: _lowered(F.col(words)[i])) if lowered else (lambda i: F.col(words)[i])
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*(word(i + k) for k in range(size))))
    return F.when(F.size(words) >= size, runs)


def _windows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """window (id), item, length, size (of its shingles), h1, h2 (of its exact words), shingles: array of (offset, key)."""
    rows = items.select(F.col(item_col).alias("item"), exact_words(F.col(text_col)).alias("words")).filter((F.size("words") > 0) & F.col("item").isNotNull())
    length = F.least(F.size("words"), F.lit(WINDOW))
    cut = rows.select("item", length.alias("length"), F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("words"))
    cut = cut.distinct().withColumn("size", F.least("length", F.lit(SHINGLE)))
    keys = reduce(lambda c, s: c.when(F.col("size") == s, _keys("words", s, lowered=True)), range(2, SHINGLE + 1), F.when(F.col("size") == 1, _keys("words", 1, lowered=True)))
    return cut.select(
        "item", "length", "size", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"), F.transform(keys, lambda k, i: F.struct(i.alias("offset"), k.alias("key"))).alias("shingles")
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, n_hit (words inside an occurring window), n_items, items_sha256, contaminated.

    Null and empty texts have no words. Items without words or id take no part; items that repeat an id count once in
    n_items. Rows that repeat an id, a text or both each give a row. No items: nothing is hit. Only the named columns
    are read, so others can't clash. Very long texts count whole; an empty docs gives an empty result. Windows of the items are broadcast while they number at most BROADCAST_ROWS, and
    so are the places to compare; beyond that Spark joins them by shuffling.
    """
    windows = materialize(_windows(items, item_col, item_text_col), "windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most SHINGLE of them
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("mark", F.xxhash64("text"))
    coarse = base.select("id", "mark", coarse_words(F.col("text")).alias("words"))

    # every place in the corpus where a shingle of the items stands
    shingles = windows.select("size", F.explode("shingles.key").alias("key")).distinct()
    known = shingles.count()
    found = None
    for size in sizes:
        places = coarse.select("id", "mark", F.size("words").alias("n_words"), F.posexplode(_keys("words", size)).alias("place", "key"))
        here = places.join(_small(shingles.filter(F.col("size") == size).select("key"), known), "key").withColumn("size", F.lit(size))
        found = here if found is None else found.unionByName(here)
    if found is None:
        spots = None
    else:
        found = materialize(found, "shingle-places")
        rarity = found.groupBy("size", "key").agg(F.count(F.lit(1)).alias("often"))
        # an inner join: a window with a shingle that stands nowhere can't occur, and its rarest shingle is such a one
        each = windows.withColumn("s", F.explode("shingles")).select("item", "length", "size", "h1", "h2", "s.offset", "s.key")
        ranked = each.join(rarity, ["size", "key"], "left").groupBy("item", "length", "size", "h1", "h2").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "key", "offset")).alias("first"))
        prefix = ranked.filter("first.often > 0").select("item", "length", "size", "h1", "h2", "first.key", "first.offset")
        fits = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))
        spots = found.join(_small(prefix, windows.count()), ["size", "key"]).withColumn("start", F.col("place") - F.col("offset")).filter(fits)
        spots = materialize(spots.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "length", "h1", "h2", "item")).alias("spots")), "spots")
    if spots is None:
        joined = base.withColumn("spots", F.lit(None).cast("array<struct<start:int,length:int,h1:long,h2:long,item:long>>"))
    else:
        total = spots.agg(F.sum(F.size("spots")).alias("n")).first()["n"] or 0
        right = spots.select(F.col("id").alias("spot_id"), F.col("mark").alias("spot_mark"), "spots")
        joined = base.join(_small(right, total), F.col("id").eqNullSafe(F.col("spot_id")) & (F.col("mark") == F.col("spot_mark")), "left")
    words = joined.select("id", "spots", F.size(coarse_words(F.col("text"))).cast("long").alias("n_words"), F.when(F.col("spots").isNotNull(), exact_words(F.col("text"))).alias("words"))

    def same(s: Column) -> Column:
        span = F.slice("words", s["start"] + 1, s["length"])
        return (F.xxhash64(span) == s["h1"]) & (F.xxhash64(F.lit(1), span) == s["h2"])

    hits = words.select("id", "n_words", F.when(F.col("spots").isNotNull(), F.filter("spots", same)).alias("hits"))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    named = F.array_sort(F.array_distinct(F.transform("hits", lambda s: s["item"].cast("string"))))
    out = hits.select("id", "n_words", F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_hit"), F.coalesce(named, F.array().cast("array<string>")).alias("items"))
    out = out.withColumn("n_hit", F.greatest("n_hit", F.lit(0).cast("long")))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
