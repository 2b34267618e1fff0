"""Truth, labels, samples and the final match lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithlink.session import counted


def parse_ids(column: Column) -> Column:
    """Comma list to array: blanks trimmed, empty parts dropped."""
    return F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def format_ids(column: Column) -> Column:
    return F.array_join(column, ",")


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(source1_id, candidate_id), each once, from rows with matched_ids; '' means no match. Items aren't trimmed."""
    listed = truth.filter(F.coalesce("matched_ids", F.lit("")) != "")
    return listed.select("source1_id", F.explode(F.split("matched_ids", ",")).alias("candidate_id")).distinct()


def with_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where the truth pairs have them, whatever the source, else 0."""
    known = counted(truth.select("source1_id", "candidate_id").distinct().withColumn("known", F.lit(1)), "truth-pairs")
    return pairs.join(known, ["source1_id", "candidate_id"], "left").withColumn("label", F.coalesce("known", F.lit(0)).cast("int")).drop("known")


def singletons(truth: DataFrame) -> DataFrame:
    return truth.filter(F.coalesce("matched_ids", F.lit("")) == "")


def non_singletons(truth: DataFrame) -> DataFrame:
    return truth.filter(F.coalesce("matched_ids", F.lit("")) != "")


def matches(scored: DataFrame, threshold: float, entities: DataFrame, order: str | None = None) -> DataFrame:
    """(source1_id, matched): candidates with prob >= threshold in order (of a column, else of the id); every entity has a row.

    An entity's list is as long as its candidates at most, which blocking bounds.
    """
    hits = scored.filter(F.col("prob") >= threshold)
    rank = F.col(order) if order else F.col("candidate_id")
    lists = hits.groupBy("source1_id").agg(F.sort_array(F.collect_set(F.struct(rank.alias("o"), F.col("candidate_id")))).alias("m"))
    done = entities.select("source1_id").distinct().join(lists.hint("merge"), "source1_id", "left")  # Spark can't guess how long the lists are
    return done.select("source1_id", F.coalesce(F.transform("m", lambda x: x["candidate_id"]), F.array().cast("array<string>")).alias("matched"))


def stratified_sample(truth: DataFrame, n: int, singleton_share: float = 0.06, seed: int = 42) -> DataFrame:
    """About n entities, the given share of them without matches; chosen by hash, so always the same."""
    alone = int(n * singleton_share)
    pick = lambda rows, k: rows.orderBy(F.xxhash64(F.lit(seed), "source1_id"), "source1_id").limit(k)
    return pick(singletons(truth), alone).unionByName(pick(non_singletons(truth), n - alone))


def decoy_sample(records: DataFrame, truth: DataFrame, per_true: int = 500, least: int = 50_000, seed: int = 42) -> DataFrame:
    """All records (id) of true pairs, and max(per_true x their number, least) others, chosen by hash."""
    wanted = truth.select(F.col("candidate_id").alias("id")).distinct()
    true = records.join(wanted, "id", "left_semi")
    others = records.join(wanted, "id", "left_anti")
    k = max(per_true * true.count(), least)
    return true.unionByName(others.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(k))


def split(labelled: DataFrame, share: float = 0.8, keys: tuple[str, ...] = ("source1_id", "candidate_id"), by: str = "label", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of the keys, the same share of each label. Splitting on source1_id alone keeps entities whole."""
    share_of = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) / 1_000_000
    if len(keys) == 1:
        marked = labelled.withColumn("u", share_of)
        return marked.filter(F.col("u") < share).drop("u"), marked.filter(F.col("u") >= share).drop("u")
    cuts = labelled.withColumn("u", share_of).groupBy(by).agg(F.percentile_approx("u", share, 10_000).alias("cut"))
    marked = labelled.withColumn("u", share_of).join(F.broadcast(cuts), by)  # a row a label
    return marked.filter("u <= cut").drop("u", "cut"), marked.filter("u > cut").drop("u", "cut")
