import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kithlink.operators import blocking, postings
from kithlink.plans import catalog

LISTS = "source string, id string, row long, keys array<string>"


def _lists(seed: int, repeated: bool) -> list[tuple]:
    pick = random.Random(seed)
    rows = []
    for i in range(120):
        source = f"source{pick.randint(1, 3)}"
        keys = [pick.choice(["hot", "hot", f"k{pick.randint(0, 30)}", f"r{pick.randint(0, 300)}", None]) for _ in range(pick.randint(0, 9))]
        rows.append((source, f"{source}-{pick.randint(0, 60) if repeated else i}", pick.randint(0, 40), keys))
    return rows + [("source1", "none", 1, None), ("source2", None, 2, ["hot", "k1"]), (None, "lost", 3, ["hot"])]


@pytest.mark.parametrize("repeated", [False, True])
def test_candidates_equal_those_of_joined_pairs(spark, repeated):
    lists = spark.createDataFrame(_lists(5, repeated), LISTS)
    counts = blocking.candidate_counts(lists.select("source", "id", "row", F.posexplode("keys").alias("place", "key"))).cache()
    for k in (3, 200):
        assert sorted(map(str, postings.best_candidates(lists, k).collect())) == sorted(map(str, blocking.top_candidates(counts, k).collect()))
    totals = counts.groupBy("source").agg(F.count(F.lit(1)).alias("pairs"), F.sum("shared").alias("shared"), F.max("shared").alias("most"))
    assert sorted(map(str, postings.pair_totals(lists).collect())) == sorted(map(str, totals.collect()))


@pytest.mark.parametrize("repeated", [False, True])
def test_hybrid_candidates_equal_those_of_merged_tables(spark, repeated):
    """Also with references that have neighbours only, ids of no record, repeated pairs, nulls and similarities that are no number."""
    pick, rows = random.Random(6), _lists(5, repeated)
    names = [r[1] for r in rows if r[0] == "source1"]
    others = [(r[0], r[1]) for r in rows if r[0] in ("source2", "source3")] + [("source3", "new")]
    near = [(pick.choice([*names, "none", "far", None]), *pick.choice(others), pick.choice([0.5, 0.25, float("nan"), pick.random()])) for _ in range(300)]
    near = spark.createDataFrame(near, "source1_id string, source string, candidate_id string, similarity double")
    lists = spark.createDataFrame(rows, LISTS)
    columns = ["source1_id", "source", "candidate_id", "shared", "similarity", "rank"]
    for k_keys, k in ((200, 200), (20, 8), (3, 6)):
        want = blocking.hybrid_candidates(postings.best_candidates(lists, k_keys), near, k).select(columns)
        assert sorted(map(str, postings.best_hybrid(lists, near, k_keys, k).collect())) == sorted(map(str, want.collect()))


def test_hybrid_candidates_cross_no_shuffle(spark):
    """Above the candidates by keys, whose schema ends with the similarity, there is no exchange, window or aggregate."""
    plan = catalog.jn04_hybrid_candidates(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert not any(x in above for x in ("Window", "Aggregate", "Join", "Sort"))


def test_no_pairs_cross_a_shuffle(spark):
    for df in (catalog.sl01_top_candidates(spark, "/root/testdata/sf0.001"), catalog.jn02_candidate_counts(spark, "/root/testdata/sf0.001")):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("k", [1, 4, 30])
def test_blocks_of_candidates_give_one_order(tmp_path, monkeypatch, k):
    pick = random.Random(k)
    record = pa.struct([("row", pa.int64()), ("keys", pa.list_(pa.int64()))])
    make = lambda n: [[pick.choice([pick.randint(0, 5), pick.randint(0, 40)]) for _ in range(pick.randint(0, 400 if i % 9 == 0 else 6))] for i in range(n)]
    left, right = make(30), make(700)
    table = lambda keys: pa.table({"source": ["source2"] * len(keys), "id": [f"c{i:03}" for i in range(len(keys))], "rows": pa.array([[{"row": i, "keys": x}] for i, x in enumerate(keys)], pa.list_(record))})
    pq.write_table(table(right), tmp_path / "part-00000.parquet")
    references = postings.References(table(left).to_batches()[0])
    expected = []
    for r, mine in enumerate(left):
        found = []
        for c, theirs in enumerate(right):
            if shared := sum(mine.count(x) * theirs.count(x) for x in set(mine)):
                found.append((-shared, min(mine.index(x) for x in theirs if x in mine), c))
        expected += [(f"c{r:03}", f"c{c:03}", "source2", -s, i) for i, (s, _, c) in enumerate(sorted(found)[:k], 1)]
    for size in (1 << 16, 100, 7):
        monkeypatch.setattr(postings, "BLOCK", size)
        for work in (postings._best, postings._best_of_repeated):
            assert [tuple(row.values()) for batch in work(references, [f"file://{tmp_path}/part-00000.parquet"], k) for row in batch.to_pylist()] == expected


@pytest.mark.parametrize("name", ["jn07_labels", "ag05_blocking_recall", "ag10_class_balance"])
def test_candidates_meet_the_truth_without_a_shuffle(spark, name):
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and plan.count("MapInArrow") == 1


@pytest.mark.parametrize("name", ["ag07_roc_auc", "ag08_average_precision", "sl12_threshold_grid", "sl13_best_threshold", "jn14_unknown_ids", "jn15_match_not_among_candidates", "pf03_singletons"])
def test_candidates_are_counted_once(spark, name):
    """What is read several times is written first."""
    assert "MapInArrow" not in catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [100_000, 0])
def test_pairs_are_never_the_side_that_is_sent_to_all(spark, monkeypatch, few):
    from kithlink.operators import features

    monkeypatch.setattr(features, "BROADCAST_RECORDS", few)
    plan = catalog.fe05_features_in_sql(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and ("SortMergeJoin" in plan) == (not few)


@pytest.mark.parametrize("profile", ["main", "evaluate"])
def test_features_in_blocks_equal_those_of_all_at_once(spark, monkeypatch, profile):
    """Also with ids that several records have, of no record, and null."""
    from kithlink.operators import features

    rows = catalog.records(spark, "/root/testdata/sf0.001")
    rows = features.with_tfidf(rows.unionByName(rows.filter("row % 50 = 1").withColumn("source", F.lit("source3"))), profile).cache()
    odd = spark.createDataFrame([("S1-0", "S2-none", "source2"), ("S1-0", None, "source2"), (None, "S2-1", "source2"), ("S1-none", "S2-1", "source2")], "source1_id string, candidate_id string, source string")
    pairs = catalog._pairs(spark, "/root/testdata/sf0.001", profile).filter("hash(source1_id) % 5 = 0").unionByName(odd).cache()
    whole = features.feature_matrix(pairs, rows, profile)
    monkeypatch.setattr(features, "BROADCAST_VECTORS", rows.count() // 2 + 1)
    parts = features.feature_matrix(pairs, rows, profile)
    assert parts.columns == whole.columns and whole.count() > 300
    assert "Join" not in parts._jdf.queryExecution().optimizedPlan().toString()  # no pair is shuffled with what features read
    assert parts.exceptAll(whole).isEmpty() and whole.exceptAll(parts).isEmpty()


def test_match_lists_are_not_sent_to_all(spark):
    plan = catalog.jn09_matches(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
