"""Blocking, metrics, models, files, validators, and the whole."""

import bisect
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from kithlink.operators import blocking, metrics, neighbours, resolve, tfidf, validate
from kithlink.operators.features import feature_matrix, feature_names
from kithlink.operators.models import KINDS, BalancedLogistic, BoostedTrees, CrossEncoder, Ensemble
from kithlink.operators.neighbours import nearest, nearest_approximate
from kithlink.plans.linkage import Linkage, evaluate
from kithlink.sources import tsv

RECORD = "source string, id string, row long, name string, address string"


def _records(n=40, seed=1):
    pick = random.Random(seed)
    a, b, s = "acme blue delta river north solar prime vector".split(), "robotics foods media motors labs textile energy".split(), "oak elm main lake hill park".split()
    rows, truth = [], []
    for i in range(n):
        name, address = f"{pick.choice(a)} {pick.choice(b)} {i} inc", f"{100 + i} {pick.choice(s)} street, springfield, il {60000 + i}"
        rows.append(("source1", f"S1-{i}", i, name, address))
        hits = []
        for k in (2, 3):
            if pick.random() < 0.7:
                rows.append((f"source{k}", f"S{k}-{i}", i, name.replace("inc", pick.choice(["incorporated", "inc.", ""])).title(), address.replace("street", pick.choice(["st", "street"]))))
                hits.append(f"S{k}-{i}")
        truth.append((f"S1-{i}", ",".join(hits)))
    return rows, truth


def test_shared_keys_multiply_as_bags(spark):
    keys = [("source1", "x", 0, 0, "a"), ("source1", "x", 0, 1, "a"), ("source1", "x", 0, 2, "b"), ("source2", "y", 0, 0, "a"), ("source2", "y", 0, 1, "a"), ("source2", "y", 0, 2, "c")]
    counts = blocking.candidate_counts(spark.createDataFrame(keys, "source string, id string, row long, place int, key string"))
    assert [(r["candidate_id"], r["shared"]) for r in counts.collect()] == [("y", 4)]


@pytest.mark.parametrize("profile", ["main", "evaluate"])
def test_blocking_does_not_depend_on_partitions(spark, profile):
    records = spark.createDataFrame(_records()[0], RECORD)
    one, many = (blocking.block(records.repartition(n), profile, 5).collect() for n in (1, 7))
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 200


def test_empty_names_block_together_in_main_only(spark):
    rows = spark.createDataFrame([("source1", "S1-1", 0, "the", ""), ("source2", "S2-1", 0, None, None), ("source3", "S3-1", 0, "", "")], RECORD)
    keys = lambda p: {(r["id"], r["key"]) for r in blocking.keyed(rows, p).collect()}
    assert ("S1-1", "_empty_") in keys("main") and ("S2-1", "_empty_") in keys("main") and ("S2-1", "sdx:0000") in keys("evaluate")
    assert blocking.block(rows, "main").count() == 2


def test_candidate_cap_and_hybrid(spark):
    by_keys = spark.createDataFrame([("a", "source2", "x", 5), ("a", "source2", "y", 3)], "source1_id string, source string, candidate_id string, shared long")
    near = spark.createDataFrame([("a", "source2", "y", 0.9), ("a", "source3", "z", 0.8), ("a", "source3", "w", 0.95)], "source1_id string, source string, candidate_id string, similarity double")
    assert [r["candidate_id"] for r in blocking.hybrid_candidates(by_keys, near, 3).orderBy("rank").collect()] == ["x", "y", "w"]


def test_neighbours(spark):
    pick = random.Random(2)
    rows = [(f"source{1 + i % 3}", f"v{i}", [pick.gauss(0, 1) for _ in range(8)]) for i in range(90)] + [("source2", "none", None)]
    v = spark.createDataFrame(rows, "source string, id string, vector array<double>")
    queries, others = v.filter("source = 'source1'"), v.filter("source <> 'source1'")
    exact = {(r["source1_id"], r["candidate_id"]) for r in nearest(queries, others, 5).collect()}
    assert len(exact) == 150
    rough = {(r["source1_id"], r["candidate_id"]) for r in nearest_approximate(queries, others, 5, bucket_length=1.0, tables=12).collect()}
    assert len(exact & rough) / len(exact) > 0.9


def test_tfidf_by_hand(spark):
    import math

    corpus = spark.createDataFrame([("s", "1", "red fox red"), ("s", "2", "red dog"), ("s", "3", "cat")], "source string, id string, t string")
    settings = tfidf.Settings("word", 1, 2, 10, min_df=1)
    idf = {r["term"]: r["idf"] for r in tfidf.fit(corpus, "t", settings, ["source", "id"]).collect()}
    assert idf["red"] == pytest.approx(math.log(4 / 3) + 1) and idf["red fox"] == pytest.approx(math.log(2) + 1) and len(idf) == 7
    vectors = tfidf.transform(corpus, "t", tfidf.fit(corpus, "t", settings, ["source", "id"]), settings, ["source", "id"])
    lengths = vectors.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1) for r in lengths)
    chars = spark.createDataFrame([("ab abcd",)], "t string").select(tfidf.terms(F.col("t"), tfidf.Settings("char_wb", 3, 5, 9)).alias("g")).first()["g"]
    assert sorted(chars) == sorted([" ab", "ab ", " ab ", " ab", "abc", "bcd", "cd ", " abc", "abcd", "bcd ", " abcd", "abcd "])


def test_metrics_by_hand(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "source1_id string, candidate_id string")
    entities = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "source1_id string")
    out = metrics.macro_f05(pairs([("A", "x"), ("A", "y"), ("C", "z")]), pairs([("A", "x"), ("C", "q"), ("D", "w"), ("Z", "x")]), entities).first()
    assert out["macro_f05"] == pytest.approx(0.458333, abs=1e-6) and (out["perfect"], out["partial"], out["zero"]) == (1, 1, 2)
    scored = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, prob double")
    assert metrics.average_precision(scored).first()["pr_auc"] == pytest.approx(0.833333, abs=1e-6)
    assert metrics.roc_auc(scored).first()["roc_auc"] == pytest.approx(0.75)
    assert metrics.roc_auc(scored.filter("label = 1")).first()["roc_auc"] is None
    best = metrics.best_threshold(scored, metrics.threshold_grid()).first()
    assert best["tau"] == pytest.approx(0.41) and best["f05"] == pytest.approx(1.25 * 1 / (1.25 + 0.25))
    empty = metrics.binary_metrics(scored.limit(0), 0.5).first()
    assert (empty["precision"], empty["f05"], empty["positives"]) == (0, 0, 0)
    assert metrics.macro_f05(pairs([]), pairs([]), entities.limit(0)).first()["macro_f05"] == 0


def test_features_of_both_profiles(spark):
    rows = [("source1", "S1-1", 0, "Acme Robotics", "12 Main St"), ("source2", "X", 0, "Acme Robotics Inc", "12 Main St"), ("source3", "X", 0, "Other", ""), ("source2", "S2-2", 1, "", "")]
    records = spark.createDataFrame(rows, RECORD)
    pairs = spark.createDataFrame([("S1-1", "X", "source2"), ("S1-1", "S2-2", "source2"), ("S1-1", "gone", "source2")], "source1_id string, candidate_id string, source string")
    main = {r["candidate_id"]: r for r in feature_matrix(pairs, records, "main").collect()}
    other = {r["candidate_id"]: r for r in feature_matrix(pairs, records, "evaluate").collect()}
    assert set(main) == set(other) == {"X", "S2-2"}
    x = main["X"]
    assert [x[c] for c in ("name_prefix_match", "name_suffix_match", "name_common_token_count", "name_unique_token_count", "name_abbreviation_match")] == [1, 0, 2, 1, 0]
    assert x["name_token_jaccard"] == pytest.approx(2 / 3) and x["name_token_overlap_ratio"] == 1 and x["addr_exact_match"] == 1 and x["addr_state_match"] == 0
    assert main["S2-2"]["name_jaro_winkler"] == 0 and main["S2-2"]["cross_name_name_overlap"] == 0
    assert other["X"]["name_exact"] == 0 and other["X"]["name_prefix"] == 0  # source3 hides source2
    assert len(feature_names(feature_matrix(pairs, records, "main"))) == 34 and len(feature_names(feature_matrix(pairs, records, "evaluate"))) == 31


def test_ids_and_samples(spark):
    row = spark.createDataFrame([(" a, ,b,",)], "x string").select(resolve.parse_ids(F.col("x")).alias("v")).first()
    assert row["v"] == ["a", "b"]
    truth = spark.createDataFrame(_records(60)[1], "source1_id string, matched_ids string")
    sample = resolve.stratified_sample(truth, 20, 0.1)
    assert sample.count() == 20 and resolve.singletons(sample).count() == 2 and sorted(map(tuple, sample.collect())) == sorted(map(tuple, resolve.stratified_sample(truth, 20, 0.1).collect()))
    labelled = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", int(i % 5 == 0)) for i in range(500)], "source1_id string, candidate_id string, label int")
    train, test = resolve.split(labelled)
    assert train.count() + test.count() == 500 and abs(train.count() - 400) < 12 and 70 <= train.filter("label = 1").count() <= 90


def test_the_whole_from_training_to_a_loaded_model(spark, tmp_path):
    rows, truth_rows = _records(40)
    records, truth = spark.createDataFrame(rows, RECORD), spark.createDataFrame(truth_rows, "source1_id string, matched_ids string")
    linkage = Linkage("evaluate", {"blocking": {"max_candidates_per_source1": 10}})
    got = linkage.train(records, truth)
    assert got["blocking_recall"] == 1 and got["f05"] > 0.9
    linkage.save(f"{tmp_path}/m")
    again = Linkage.load(f"{tmp_path}/m", linkage.config)
    assert again.threshold == linkage.threshold
    others = spark.createDataFrame([r for r in rows if int(r[1].split("-")[1]) % 3 == 0], RECORD)  # other records than it was trained on
    scores = lambda x: sorted((r["source1_id"], r["candidate_id"], round(r["prob"], 9)) for r in x.scored(others).collect())
    own = scores(linkage)
    assert own and scores(again) == own
    whole = {(r["source1_id"], r["candidate_id"]): r["prob"] for r in linkage.scored(records).collect()}
    assert all(abs(whole[a, b] - p) < 1e-6 for a, b, p in own if (a, b) in whole)  # a pair's features don't depend on what is predicted beside it
    assert len({r["source1_id"] for r in again.predict(records).collect()}) == 40


def test_evaluation_end_to_end(spark):
    rows, truth_rows = _records(40)
    out = evaluate(spark.createDataFrame(rows, RECORD), spark.createDataFrame(truth_rows, "source1_id string, matched_ids string"), decoys=(1, 10))
    assert out["macro_f05"] > 0.8 and len(out["top"]) == 10


def test_ensemble(spark, tmp_path):
    pick = random.Random(3)
    rows = [(f"S1-{i}", f"S2-{i}", pick.gauss(i % 2, 0.4), pick.random(), i % 2) for i in range(120)]
    matrix = spark.createDataFrame(rows, "source1_id string, candidate_id string, name_a double, addr_b double, label int")
    small = {"n_estimators": 3, "max_depth": 3, "iterations": 5, "depth": 3}
    model = Ensemble().fit(matrix, [{"name": n, "params": small} for n in ("xgboost", "lightgbm", "catboost")] + [{"name": "tabpfn", "use": False}])
    scored = model.predict(matrix)
    row = scored.first()
    assert row["prob"] == pytest.approx((0.35 * row["p_xgboost"] + 0.35 * row["p_lightgbm"] + 0.2 * row["p_catboost"]) / 0.9)
    assert scored.filter("predicted = label").count() > 100
    model.save(f"{tmp_path}/e")
    assert Ensemble.load(f"{tmp_path}/e").probabilities(matrix).first()["prob"] == row["prob"]
    with pytest.raises(ValueError):
        Ensemble().probabilities(matrix)
    with pytest.raises(ValueError):
        BoostedTrees("x").probabilities(matrix)
    texts = spark.createDataFrame([("a", "a"), ("a", "b")], "left string, right string")
    assert [r["p_c"] for r in CrossEncoder("c", lambda a, b: [50.0 if x == y else -50.0 for x, y in zip(a, b)]).probabilities(texts).collect()] == pytest.approx([1, 0])
    assert CrossEncoder("c").probabilities(texts).first()["p_c"] == 0
    assert BalancedLogistic(max_iter=50).fit(matrix).probabilities(matrix).filter("(prob >= 0.5) = (label = 1)").count() > 100


def test_ensemble_query_fits_whole_learners(spark, monkeypatch):
    """500 trees of depth 8 each, as the reference's configuration has them."""
    from kithlink.plans import catalog

    def fit(self, rows, configs):
        raise InterruptedError(configs)

    monkeypatch.setattr(catalog, "_training", lambda *_: None)
    monkeypatch.setattr(Ensemble, "fit", fit)
    with pytest.raises(InterruptedError) as said:
        catalog.ml07_ensemble(spark, "nowhere")
    used = {c["name"]: c["params"] for c in said.value.args[0] if c.get("use", True)}
    assert [(p["n_estimators"], p["max_depth"], p["learning_rate"]) for p in (used["xgboost"], used["lightgbm"])] == [(500, 8, 0.05)] * 2
    assert (used["catboost"]["iterations"], used["catboost"]["depth"]) == (500, 8)
    trees = {n: KINDS[n](n, p).learner() for n, p in used.items()}
    assert [trees[n].getMaxIter() for n in ("xgboost", "lightgbm")] == [500, 500] and trees["catboost"].getNumTrees() == 500


def test_logistic_equals_spark_and_caches_nothing(spark, tmp_path, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from kithlink.operators.features import assembled

    pick = random.Random(9)
    rows = [(pick.gauss(i % 4 == 0, 0.6) * 100, pick.random() + (i % 4 == 0), 7.0, int(i % 4 == 0)) for i in range(400)]
    matrix = spark.createDataFrame(rows, "name_a double, addr_b double, cross_c double, label int")
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, most = held(), []
    from kithlink.operators import models

    slopes = models._slopes
    monkeypatch.setattr(models, "_slopes", lambda *args: (most.append(held()), slopes(*args))[1])
    model = BalancedLogistic().fit(matrix)
    assert 2 < len(most) < 30 and max(most) <= before
    scaled = assembled(matrix.withColumns({n: (F.col(n) - m) / s for n, (m, s) in model.scale.items()}), model.names).withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(400 / 600))
    spark_ml = LogisticRegression(weightCol="w", regParam=1 / 400, standardization=False, maxIter=1000, tol=1e-12).fit(scaled)
    want = [r["p"] for r in spark_ml.transform(scaled).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert [r["prob"] for r in model.probabilities(matrix).collect()] == pytest.approx(want, abs=1e-6)
    model.save(f"{tmp_path}/l")
    assert BalancedLogistic.load(f"{tmp_path}/l").probabilities(matrix).collect() == model.probabilities(matrix).collect()
    ones = matrix.filter("label = 1")
    assert {r["prob"] for r in BalancedLogistic().fit(ones).probabilities(ones).collect()} == {1.0}


def test_files(spark, tmp_path):
    (tmp_path / "source1_train.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\textra\n007\t"a ""q"" b"\tNA\tx\nS1-2\t\t 5 st \ty\n')
    for name in ("train_source2.tsv", "source3_train.tsv"):
        (tmp_path / name).write_text("id\tname\taddress\nS2-1\tx\ty\n")
    (tmp_path / "ground_truth_train.tsv").write_text("source1_entity_id\tmatched_entity_ids\n007\tS2-1,S3-1\nS1-2\t\n")
    found = tsv.load_sources(spark, str(tmp_path))
    assert set(found) == {"source1", "source2", "source3", "ground_truth"}
    assert [tuple(r)[:3] for r in found["source1"].collect()] == [("007", 'a "q" b', "NA"), ("S1-2", "", " 5 st ")]
    assert resolve.truth_pairs(found["ground_truth"]).count() == 2 and tsv.load_sources(spark, str(tmp_path), "test") == {}
    with pytest.raises(FileNotFoundError):
        tsv.load_sources(spark, str(tmp_path), "test", "evaluate")
    with pytest.raises(ValueError):
        tsv.read_truth(spark, str(tmp_path / "source3_train.tsv"))
    matched = spark.createDataFrame([("S1-1", ["S2-1", "S3-1"]), ("S1-2", [])], "source1_id string, matched array<string>")
    tsv.write_results(matched, f"{tmp_path}/new/out.tsv")
    assert (tmp_path / "new/out.tsv").read_text() == "source1_id\tmatched_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    (tmp_path / "c.json").write_text(json.dumps({"blocking": {"use_soundex": False}}))
    (tmp_path / "c.yaml").write_text("blocking:\n  use_soundex: false\n")
    assert tsv.load_config(str(tmp_path / "c.json")) == tsv.load_config(str(tmp_path / "c.yaml"))


def test_strict_validator(spark, tmp_path):
    (tmp_path / "test_source1.tsv").write_text("id\tname\nS1-1\ta\nS1-2\tb\n\n")
    for i in (2, 3):
        (tmp_path / f"test_source{i}.tsv").write_text(f"id\tname\nS{i}-1\ta\n")
    good = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    cases = {
        good: set(), "source1_entity_id,matched_entity_ids\nS1-1,x\n": {"comma-separated header"}, "a\tb\n": {"unexpected header"}, "": {"empty file"}, good + "S1-3\n": {"row without tab"},
        good + "S1-1\t\n": {"duplicate row"}, good.replace("S3-1", "S2-1"): {"repeated id in a list"}, good.replace("S3-1", "S1-2"): {"self match"}, good.replace("S3-1", ""): {"wrong prefix"},
        good.replace("S3-1", "S3-9"): {"unknown id"}, good.replace("S1-2\t\n", ""): {"missing entity"}, good + "S1-9\t\n": {"unknown entity"},
    }
    for k, (text, rules) in enumerate(cases.items()):
        path = tmp_path / f"m{k}.tsv"
        path.write_text(text)
        found = validate.validate_strict(spark, str(path), str(tmp_path), check_ids=True)
        assert {r["rule"] for r in found.filter("severity = 'error'").collect()} == rules, text
        assert validate.passes(found) == (not rules)
    (tmp_path / "latin.tsv").write_bytes(good.encode() + b"S1-\xe9\t\n")
    assert {r["rule"] for r in validate.validate_strict(spark, str(tmp_path / "latin.tsv"), str(tmp_path)).collect()} >= {"not UTF-8"}
    assert {r["rule"] for r in validate.validate_strict(spark, str(tmp_path / "nothing"), str(tmp_path)).collect()} >= {"missing file", "ids not checked", "no candidate file"}
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\tS3-1\n")
    found = validate.validate_strict(spark, str(tmp_path / "m0.tsv"), str(tmp_path), str(tmp_path / "c.tsv"))
    assert {(r["severity"], r["rule"]) for r in found.collect()} == {("warning", "ids not checked"), ("warning", "match not among candidates")}


def test_own_validator(spark):
    rows = spark.createDataFrame([("S1-1", "S2-1, "), ("S1-1", ""), ("S1-3", "S2-2,S3-1")], "source1_id string, matched_ids string")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "")], "source1_id string, matched_ids string")
    assert {r["rule"] for r in validate.validate_results(rows, truth).collect()} == {"duplicate row", "blank id in a list", "missing entity", "unknown entity"}
    assert validate.counters(rows).first().asDict() == {"rows": 3, "empty": 1, "non_empty": 2, "total_matched": 4}
    assert validate.validate_results(rows.toDF("a", "b")).first()["rule"] == "unexpected header"
    assert validate.score_results(truth, truth).first()["macro_f05"] == 1


def test_stream(spark, tmp_path):
    from kithlink.streaming.candidates import stream_candidates

    rows, _ = _records(20)
    index = blocking.keyed(spark.createDataFrame(rows, RECORD), "evaluate")
    blocking.save_index(index, f"{tmp_path}/index")
    spark.createDataFrame([r[1:2] + r[3:] for r in rows if r[0] == "source1"], "id string, name string, address string").write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema("id string, name string, address string").parquet(f"{tmp_path}/in")
    started = stream_candidates(arriving, blocking.load_index(spark, f"{tmp_path}/index"), f"{tmp_path}/out", f"{tmp_path}/cp", k=5)
    started.processAllAvailable()
    started.stop()
    pairs = {(r["source1_id"], r["candidate_id"], r["shared"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = blocking.block(spark.createDataFrame(rows, RECORD), "evaluate", 5)
    assert {(r["source1_id"], r["shared"]) for r in want.collect()} == {(p[0], p[2]) for p in pairs}


def test_nearest_in_several_blocks(spark, monkeypatch):
    rng = random.Random(5)
    vector = lambda: [rng.gauss(0, 1) for _ in range(6)]
    asked = spark.createDataFrame([(f"S1-{i}", vector()) for i in range(23)], "id string, vector array<double>")
    others = spark.createDataFrame([("source2", f"S2-{i}", vector()) for i in range(60)], "source string, id string, vector array<double>")
    rows = lambda: sorted((r.source1_id, r["rank"], r.candidate_id) for r in neighbours.nearest(asked, others, 4).collect())
    whole = rows()
    monkeypatch.setattr(neighbours, "BLOCK", 5)
    assert rows() == whole and len(whole) == 23 * 4


@pytest.mark.parametrize("distinct", [1, 7, 3000])
def test_ranking_metrics_equal_their_definitions(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.3)) for _ in range(3000)]
    scored = spark.createDataFrame(rows, "prob double, label int")
    order = sorted(rows)
    pos, sorted_neg = [s for s, y in rows if y], sorted(s for s, y in rows if not y)
    won = sum((bisect.bisect_left(sorted_neg, s) + bisect.bisect_right(sorted_neg, s)) / 2 for s in pos)
    assert metrics.roc_auc(scored).first()[0] == pytest.approx(won / len(pos) / len(sorted_neg))
    want, seen, tp = 0.0, 0, 0
    for _, group in itertools.groupby(reversed(order), key=lambda r: r[0]):
        labels = [y for _, y in group]
        seen, tp = seen + len(labels), tp + sum(labels)
        want += sum(labels) * tp / seen
    assert metrics.average_precision(scored).first()[0] == pytest.approx(want / len(pos))
