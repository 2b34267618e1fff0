"""Blocking: keys of each record, candidate pairs by shared keys, the best candidates of each reference record.

Records are DataFrames (source, id, row, name, address); `row` orders the records of a source and breaks ties.
Keys are computed once per record; pairs come from an equi-join on keys, and partial counts are merged before any
pair work. Repeated keys multiply on both sides, as bags do.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithlink.functions import address as A
from kithlink.functions import phonetic as P
from kithlink.functions import text as T
from kithlink.functions.dictionaries import ADDRESS_STOPWORDS, NAME_STOPWORDS
from kithlink.operators.postings import REFERENCE, best_candidates, best_hybrid

MAX_CANDIDATES = 200

#: Families of keys that can be switched off, with the parameters of the main profile.
DEFAULTS = {
    "name_token_min_length": 3, "address_token_min_length": 3, "name_token_max_tokens": 5, "name_ngram_size": 3, "address_ngram_size": 3, "postal_code_prefix_length": 3,
    "use_first_token": True, "use_first_two_tokens": True, "use_name_tokens": True, "use_name_ngrams": True, "use_soundex": True, "use_metaphone": True, "use_nysiis": True,
    "use_postal_code_prefix": True, "use_house_number": True, "use_street_tokens": True, "use_city": True, "use_state": True, "use_address_ngrams": True, "use_cross": True,
}


def union_sources(s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The three sources as one table with a source tag; repeats stay."""
    tagged = [df.withColumn("source", F.lit(f"source{i}")) for i, df in enumerate((s1, s2, s3), 1)]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True).unionByName(tagged[2], allowMissingColumns=True)


def with_normal_forms(records: DataFrame, profile: str = "main") -> DataFrame:
    """records with nn and na, the normal forms of name and address."""
    return T.staged(records, nn=T.normalize_name(F.col("name"), profile), na=T.normalize_address(F.col("address"), profile))


def _tagged(prefix: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(f"{prefix}:"), v))


def _one(condition: Column, *parts) -> Column:
    value = F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return F.when(condition, F.array(value)).otherwise(F.array().cast("array<string>"))


def _nth(array: Column, n: int = 1) -> Column:
    return F.try_element_at(array, F.lit(n))


def name_keys(nn: Column, config: dict | None = None) -> Column:
    """Main profile, beside columns metaphone and nysiis. A name without usable tokens gives '_empty_' only."""
    c = DEFAULTS | (config or {})

    def of(toks: Column) -> Column:
        size, parts = F.size(toks), []
        if c["use_first_token"]:
            parts.append(_one(size >= 1, "name_first:", _nth(toks)))
        if c["use_first_two_tokens"]:
            parts.append(_one(size >= 2, "name_first2:", _nth(toks), "_", _nth(toks, 2)))
        if c["use_name_tokens"]:
            parts.append(_tagged("name_token", F.slice(toks, 1, c["name_token_max_tokens"])))
        if c["use_name_ngrams"]:
            grams = F.flatten(F.transform(F.slice(toks, 1, 3), lambda t: F.slice(T.ngrams(t, c["name_ngram_size"]), 1, 5)))
            parts.append(_tagged("name_ngram", grams))
        for name, code in (("soundex", P.soundex(nn)), ("metaphone", F.col("metaphone")), ("nysiis", F.col("nysiis"))):
            if c[f"use_{name}"]:
                parts.append(F.array(F.concat(F.lit(f"name_{name}:"), code)))
        return F.when(size == 0, F.array(F.lit("_empty_"))).otherwise(F.concat(*parts))

    return T.let(T.tokens(nn, c["name_token_min_length"], NAME_STOPWORDS), of)


def address_keys(na: Column, config: dict | None = None, components: Column | None = None) -> Column:
    """Main profile, from the normal form (whose commas are gone, so a state key never comes up). components: of na, if they are a column already."""
    c = DEFAULTS | (config or {})
    parts_of = A.address_components(na) if components is None else components
    postal, house, city, state = (parts_of[k] for k in ("postal_code", "house_number", "city", "state"))
    parts = []
    if c["use_postal_code_prefix"]:
        parts += [_one(postal != "", "postal_prefix:", F.substring(postal, 1, c["postal_code_prefix_length"])), _one(postal != "", "postal_full:", postal)]
    if c["use_house_number"]:
        parts.append(_one(house != "", "house_num:", house))
    if c["use_street_tokens"]:
        parts.append(_tagged("street_token", F.slice(T.tokens(parts_of["street"], c["address_token_min_length"], ADDRESS_STOPWORDS), 1, 3)))
    if c["use_city"]:
        clean = T.normalize_name(city)
        parts.append(_one((city != "") & (clean != ""), "city:", clean))
    if c["use_state"]:
        parts.append(_one(state != "", "state:", state))
    if c["use_address_ngrams"]:
        parts.append(_tagged("addr_ngram", F.slice(T.ngrams(na, c["address_ngram_size"]), 1, 10)))
    return F.concat(*parts)


def cross_keys(nn: Column, na: Column, config: dict | None = None) -> Column:
    """Main profile: first name word with postal prefix, and with the first address word; plain words, no stop words."""
    size = (DEFAULTS | (config or {}))["postal_code_prefix_length"]

    def of(read: Column) -> Column:
        n, a, postal = read["n"], read["a"], read["postal"]
        return F.concat(_one((F.size(n) > 0) & (postal != ""), "cross:", _nth(n), "_", F.substring(postal, 1, size)), _one((F.size(n) > 0) & (F.size(a) > 0), "cross_first:", _nth(n), "_", _nth(a)))

    return T.let(F.struct(T.words(nn).alias("n"), T.words(na).alias("a"), A.postal_code(na).alias("postal")), of)


def evaluate_keys(nn: Column, na: Column) -> Column:
    """Evaluate profile: no stop words, all trigrams of the first three tokens, Soundex even of an empty name."""

    def of(read: Column) -> Column:
        n, a, postal = read["n"], read["a"], read["postal"]
        grams = F.flatten(F.transform(F.slice(n, 1, 3), lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substring(t, i, F.lit(3)))))
        return F.concat(
            _one(F.size(n) >= 1, "nf:", _nth(n)), _one(F.size(n) >= 2, "n2:", _nth(n), "_", _nth(n, 2)), _tagged("nt", F.slice(n, 1, 5)), _tagged("ng", grams),
            F.array(F.concat(F.lit("sdx:"), P.soundex(nn, "evaluate"))), _one(postal != "", "pp:", F.substring(postal, 1, 3)), _one(postal != "", "pf:", postal), _tagged("at", F.slice(a, 1, 3)),
            _one(F.size(a) >= 2, "a2:", _nth(a), "_", _nth(a, 2)), _one((F.size(n) > 0) & (postal != ""), "cx:", _nth(n), "_", F.substring(postal, 1, 3)),
            _one((F.size(n) > 0) & (F.size(a) > 0), "cxa:", _nth(n), "_", _nth(a)),
        )

    found = F.struct(T.tokens(nn, profile="evaluate").alias("n"), T.tokens(na, profile="evaluate").alias("a"), A.postal_code(na, "evaluate").alias("postal"))
    return T.let(found, of)


def key_lists(records: DataFrame, profile: str = "main", config: dict | None = None) -> DataFrame:
    """The keys of each record (source, id, row, keys) in their order; repeated keys stay."""
    forms = with_normal_forms(records, profile)
    if profile == "main":
        c = DEFAULTS | (config or {})
        for name, code in (("metaphone", P.metaphone), ("nysiis", P.nysiis)):
            if c[f"use_{name}"]:
                forms = forms.withColumn(name, code(F.col("nn")))
        forms = T.staged(forms, parts=A.address_components(F.col("na")))
        parts = [name_keys(F.col("nn"), config), address_keys(F.col("na"), config, F.col("parts"))]
        keys = F.concat(*parts, *([cross_keys(F.col("nn"), F.col("na"), config)] if c["use_cross"] else []))
    else:
        keys = evaluate_keys(F.col("nn"), F.col("na"))
    return forms.select("source", "id", "row", keys.alias("keys"))


def keyed(records: DataFrame, profile: str = "main", config: dict | None = None) -> DataFrame:
    """A row for each key of each record (source, id, row, place, key); repeated keys stay."""
    return key_lists(records, profile, config).select("source", "id", "row", F.posexplode("keys").alias("place", "key"))


def candidate_counts(keys: DataFrame, max_block_size: int | None = None) -> DataFrame:
    """(source1_id, source, candidate_id, shared): how often keys of a reference record and of another record meet.

    Either side is counted by key first, so a key that a record has twice crosses the shuffle once with its count. AQE splits hot
    keys. max_block_size: leave out keys with more records on the other side (off by default, as it loses pairs).
    """
    counted = keys.groupBy("source", "id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"), F.min("row").alias("row"))
    left = counted.filter(F.col("source") == REFERENCE).select(F.col("id").alias("source1_id"), "key", F.col("n").alias("n1"), F.col("place").alias("at"))
    right = counted.filter(F.col("source") != REFERENCE).select("source", F.col("id").alias("candidate_id"), "key", F.col("n").alias("n2"), "row")
    if max_block_size is not None:
        few = right.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") <= max_block_size).select("key")
        right = right.join(few, "key", "left_semi")
    # place and row in one number: the least of numbers is found by hashing, the least of structs by sorting all that meet
    base, shift = F.lit(Decimal(1 << 65)), F.lit(Decimal(1 << 63))
    first = F.col("at").cast("decimal(10,0)") * base + (F.col("row").cast("decimal(20,0)") + shift)
    counts = left.join(right, "key").groupBy("source1_id", "source", "candidate_id").agg(F.sum(F.col("n1") * F.col("n2")).alias("shared"), F.min(first).alias("first"))
    at = F.floor(F.col("first") / base)
    return counts.select("source1_id", "source", "candidate_id", "shared", F.struct(at.alias("at"), "source", (F.col("first") - at * base).alias("row")).alias("met"))


def top_candidates(counts: DataFrame, k: int = MAX_CANDIDATES) -> DataFrame:
    """The k candidates with most shared keys for each reference record; ties go to the key met first, then to source and row."""
    order = Window.partitionBy("source1_id").orderBy(F.desc("shared"), "met", "candidate_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("source1_id", "candidate_id", "source", "shared", "rank")


def block(records: DataFrame, profile: str = "main", k: int = MAX_CANDIDATES, config: dict | None = None) -> DataFrame:
    """The k best candidates of each reference record, as top_candidates has them of candidate_counts, without a row for every pair."""
    return best_candidates(key_lists(records, profile, config), k)


def block_hybrid(records: DataFrame, by_vectors: DataFrame, k: int = MAX_CANDIDATES, k_keys: int = MAX_CANDIDATES, profile: str = "main", config: dict | None = None) -> DataFrame:
    """hybrid_candidates of block() with k_keys candidates and by_vectors, but for the candidates by keys, which never cross a shuffle."""
    return best_hybrid(key_lists(records, profile, config), by_vectors, k_keys, k)


def index_size(keys: DataFrame) -> DataFrame:
    """Number of distinct keys of the index."""
    return keys.agg(F.countDistinct("key").alias("index_size"))


def hybrid_candidates(by_keys: DataFrame, by_vectors: DataFrame, k: int = MAX_CANDIDATES) -> DataFrame:
    """Union of both kinds of candidates, each pair once, the best k by shared keys, then similarity, source and id."""
    keys = ["source1_id", "source", "candidate_id"]
    both = by_keys.select(*keys, F.col("shared").cast("long"), F.lit(None).cast("double").alias("similarity")).unionByName(by_vectors.select(*keys, F.lit(0).cast("long").alias("shared"), "similarity"))
    merged = both.groupBy(*keys).agg(F.max("shared").alias("shared"), F.max("similarity").alias("similarity"))
    order = Window.partitionBy("source1_id").orderBy(F.desc("shared"), F.desc_nulls_last("similarity"), "source", "candidate_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def save_index(keys: DataFrame, path: str) -> None:
    """Keep the index as Parquet, for later blocks against it."""
    keys.repartition("key").sortWithinPartitions("key").write.mode("overwrite").parquet(path)


def load_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
