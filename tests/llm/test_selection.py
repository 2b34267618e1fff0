"""Top-k search, graded classifiers and the pipeline."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kithlink.llm import ordinal
from kithlink.llm.grades import classify_quality, drop_toxic, score_toxicity
from kithlink.llm.topk import exact_top_k


def _brute(rows, k, asked):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if asked(i)}:
        ranked = sorted((-sum(a * b for a, b in zip(v, u)), i) for i, u in good if i != q and len(u) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("bins, block", [(4, 3), (1024, 2048)])
def test_top_k(spark, bins, block):
    pick = random.Random(1)
    vector = lambda n=6: [pick.uniform(-1, 1) for _ in range(n)]
    same = vector()
    rows = [(i, same if i % 3 == 0 else vector()) for i in range(120)] + [(200, None), (201, [1.0, None, 1.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, vector()), (210, []), (220, vector(3)), (230, vector(3)), (240, [0.0] * 6), (1, vector())]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rank string").repartition(3)
    got = exact_top_k(table, F.col("vec_id") % 10 == 0, 5, bins=bins, block=block)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == _brute(rows, 5, lambda i: i % 10 == 0)
    assert exact_top_k(table.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0
    assert exact_top_k(table.filter("vec_id = 10"), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_top_k_among_many_near_copies(spark):
    """A refined interval narrower than its bins ends where the bin it refines does."""
    pick = random.Random(3)
    rows = []
    for g in range(3):
        centre = [pick.uniform(-0.3, 0.3) for _ in range(16)]
        rows += [(len(rows) + i, [(1.02 if i < 4 else 1) * x + pick.uniform(-0.0002, 0.0002) for x in centre]) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = exact_top_k(table, F.col("vec_id") % 15 == 0, 5, bins=1024)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == _brute(rows, 5, lambda i: i % 15 == 0)


def _graded(seed, n):
    """Grade 0..3 by how many of six marked words a text has."""
    pick = random.Random(seed)
    bad = [f"bad{i}" for i in range(6)]
    texts, grades = [], []
    for _ in range(n):
        held = pick.sample(bad, pick.randrange(0, 7))
        words = held + [f"w{pick.randrange(300)}" for _ in range(40)]
        pick.shuffle(words)
        texts.append(" ".join(words).capitalize() + ".")
        grades.append(min(3, len(held) // 2))
    return texts, np.array(grades)


def test_cumulative_link_on_held_out_texts():
    texts, grades = _graded(1, 900)
    model = ordinal.fit(*ordinal.word_features(pa.array(texts)), grades)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    more, want = _graded(2, 400)
    tails = model.tails(model.scores(pa.array(more), ordinal.word_features))
    expected = model.expected(tails)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.abs(expected - want).mean() < 0.25
    assert ((model.tail_from(tails, 2) >= 0.5) == (want >= 2)).mean() > 0.95
    assert model.tail_from(tails, -1).min() == 1 and model.tail_from(tails, 9).max() == 0


def test_gradient_is_the_slope():
    """The fitted loss has no downhill direction left: thresholds moved either way are worse."""
    texts, grades = _graded(3, 200)
    rows, hashes = ordinal.word_features(pa.array(texts))
    model = ordinal.fit(rows, hashes, grades, rounds=3000)

    def loss(thresholds):
        s = model.scores(pa.array(texts), ordinal.word_features)
        p = np.column_stack([np.ones(len(s)), 1 / (1 + np.exp(thresholds[None, :] - s[:, None])), np.zeros(len(s))])
        return -np.log(p[np.arange(len(s)), grades] - p[np.arange(len(s)), grades + 1]).mean()

    best = loss(model.thresholds)
    for j in range(3):
        for d in (-0.3, 0.3):
            moved = model.thresholds.copy()
            moved[j] += d
            assert loss(moved) > best - 1e-4


def test_toxicity_and_quality_tables(spark):
    pick = random.Random(5)
    words = lambda n: " ".join(f"w{pick.randrange(400)}" for _ in range(n))
    rows = [(i, words(30) + (" vile, nasty" if i % 4 == 0 else ""), i) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1000, None, 0), (1001, "", 0), (1002, words(20_000) + " VILE! nasty", 0), (None, "vile nasty", 0), (4, rows[4][1], 4)], "doc_id long, text string, tail long")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), int(i % 4 != 0)) for i in range(200)] + [(7000, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, toxic int, quality int")
    got = {r["doc_id"]: r for r in score_toxicity(docs, labels).collect()}
    assert len(got) == 404 and all(got[i]["toxic"] == (i % 4 == 0) for i in range(400))
    assert got[1002]["toxic"] and got[None]["toxic"] and not got[1000]["toxic"] and not got[1001]["toxic"]
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1000, 1001} | {i for i in range(400) if i % 4}
    assert all(r["keep"] == (r["doc_id"] % 4 != 0) for r in classify_quality(docs.filter("doc_id < 400"), labels).collect())
    none = score_toxicity(docs, labels.limit(0)).collect()
    assert len(none) == 405 and not any(r["toxic"] for r in none)
    assert score_toxicity(docs.limit(0), labels).count() == 0
    one = classify_quality(docs, labels.filter("quality = 1"))
    assert all(r["keep"] for r in one.collect())


def test_junk_is_told_from_prose(spark):
    pick = random.Random(8)
    prose = lambda: " ".join(f"word{pick.randrange(900)}" for _ in range(60)).capitalize() + "."
    junk = [lambda: " ".join(["same"] * 60), lambda: " ".join(f"W{pick.randrange(900)}!!" for _ in range(60)), lambda: " | ".join(f"cell{pick.randrange(90)}" for _ in range(40))]
    texts = [prose() if i % 2 else junk[i // 2 % 3]() for i in range(300)]
    grades = np.array([i % 2 for i in range(300)])
    model = ordinal.fit(*ordinal.quality_features(pa.array(texts[:150])), grades[:150])
    tails = model.tails(model.scores(pa.array(texts[150:]), ordinal.quality_features))[:, 0]
    assert ((tails >= 0.5) == grades[150:]).mean() > 0.97


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    pick = random.Random(3)
    words = lambda n: " ".join(f"w{pick.randrange(2000)}" for _ in range(n))
    clean = [words(60) for _ in range(40)]
    leak = words(14)
    rows = [(i, t) for i, t in enumerate(clean)] + [(100 + i, f"{words(30)} vile {words(5)} nasty") for i in range(20)]
    near = clean[0].split()
    near[3] = "changed"
    rows += [(200, f"{words(20)} {leak} {words(20)}"), (201, "\n".join([words(12), clean[1]])), (202, " ".join(near[:30]) + "\n" + " ".join(near[30:])), (203, None), (204, "")]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 100)) for i, _ in rows[:60]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        ids = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(range(40)) <= ids, name
        assert ids & set(range(100, 120)) == set()
        if name == "line_dedup":
            assert docs.filter("doc_id = 201").first()["text"] == rows[61][1].split("\n")[0]
        if name == "jaccard_join":
            assert 202 not in ids
        if name == "decontamination":
            assert 200 not in ids
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == ids and "ids" in out.columns
