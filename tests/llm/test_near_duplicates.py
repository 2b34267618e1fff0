"""Jaccard join, passages, lines and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from kithlink.llm.decontaminate import contamination
from kithlink.llm.jaccard import keep_one_of_each, near_duplicate_groups, signatures
from kithlink.llm.lines import dedup_lines, drop_repeated_lines
from kithlink.llm.linking import components
from kithlink.llm.passages import Fenwick, chains, passages_of, repeated_passages, winnow
from kithlink.llm.shingles import mix, shingles, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _corpus(seed=1, groups=6, words=80):
    pick = random.Random(seed)
    vocabulary = [f"w{i}x" for i in range(400)]
    texts, common = [], " ".join(pick.choice(vocabulary) for _ in range(60))
    for _ in range(groups):
        base = [pick.choice(vocabulary) for _ in range(words)]
        for _ in range(pick.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 3, 6])):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [f"{common} {' '.join(pick.choice(vocabulary) for _ in range(30))}" for _ in range(5)]
    texts += ["one two", "One TWO", "one two three four five six", "one two three four five", "", "   ", None, "É b c d e f", "é b c d e f"]
    pick.shuffle(texts)
    return texts


def _set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _components(n, linked):
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def test_jaccard_groups(spark):
    for seed in (1, 2):
        texts = _corpus(seed)
        docs = spark.createDataFrame([(i, t, i, "k") for i, t in enumerate(texts)], "doc_id long, text string, node int, key string").repartition(3)
        sets = [_set(t) for t in texts]
        linked = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
        want = _components(len(sets), linked)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_groups(docs).collect()}
        assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, want))}
        kept = [r["doc_id"] for r in keep_one_of_each(docs).collect()]
        assert sorted(kept) == sorted(i for i, c in enumerate(want) if i == c)


def test_jaccard_odd_tables(spark):
    kind = "doc_id long, text string, n int"
    docs = spark.createDataFrame([(1, "a b c d e", 0), (1, "a b c d e", 0), (None, "a b c d e", 0), (2, "a b c d e", 0)], kind)
    rows = sorted(((r["doc_id"] or 0, r["component_id"] or 0, r["n_shingles"]) for r in near_duplicate_groups(docs).collect()))
    assert rows == [(0, 0, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert near_duplicate_groups(docs.limit(0)).count() == 0


def test_a_null_id_does_not_take_the_signatures_of_an_equal_text(spark):
    text = [f"w{i}" for i in range(60)]
    near = [*text[:59], "other"]
    docs = spark.createDataFrame([(None, " ".join(text)), (1, " ".join(text)), (2, " ".join(near))], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicate_groups(docs).collect()}
    assert got == {None: None, 1: 1, 2: 1}


def test_signatures_meet_for_every_similar_pair():
    """Whatever tokens count as frequent, sets that reach the bound share a signature."""
    pick = random.Random(5)
    for _ in range(300):
        n = pick.choice([2, 4, 7, 12, 17, 20, 25, 60, 150])
        pool = mix(np.arange(1, 3 * n + 2, dtype=np.uint64) * np.uint64(pick.randrange(1, 10**6)))
        base = pick.sample(range(len(pool)), n)
        drop = pick.randrange(0, max(1, n // 7 + 1))
        other = base[drop:] + [i for i in range(len(pool)) if i not in base][:pick.randrange(0, max(1, n // 7 + 1))]
        a, b = (np.sort(pool[x]) for x in (base, other))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        share = pick.choice([0, 0.3, 0.9, 1])
        frequent = lambda x: (mix(x) % np.uint64(1000)) < share * 1000  # noqa: E731, B023
        (x, least), (y, other_least) = signatures(a, frequent(a)), signatures(b, frequent(b))
        assert len(set(x.tolist()) & set(y.tolist())) >= min(least, other_least) >= 1, (n, drop, share)


def test_components(spark):
    pick = random.Random(2)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _components(200, edges)
    assert got == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _words(n, pick):
    return [f"v{pick.randrange(3000)}" for _ in range(n)]


def test_passages(spark):
    pick = random.Random(4)
    passage = _words(70, pick)
    fuzzy = list(passage)
    fuzzy[20], fuzzy[45:46] = "changed", ["two", "more"]
    texts = [
        _words(40, pick) + passage + _words(30, pick), _words(100, pick), _words(5, pick) + passage, fuzzy + _words(60, pick), _words(30, pick) + passage[:30] + _words(30, pick), passage + _words(9, pick) + passage, ["only"] * 300, _words(3, pick),
    ]
    rows = [(i, " ".join(t), i) for i, t in enumerate(texts)] + [(20, None, 0), (21, "", 0), (None, " ".join(passage), 0), (5, " ".join(texts[5]), 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source_id int").repartition(3)
    got = [r.asDict() for r in repeated_passages(docs).collect()]
    flagged = {r["doc_id"] for r in got}
    assert flagged == {2, 3, 5}
    two = next(r for r in got if r["doc_id"] == 2 and r["source_id"] == 0)
    assert (two["start_word"], two["end_word"], two["source_start"], two["source_end"], two["similarity"]) == (5, 75, 40, 110, 1.0)
    three = next(r for r in got if r["doc_id"] == 3 and r["source_id"] == 0)
    assert three["start_word"] == 0 and three["end_word"] == 71 and three["matched_words"] == 68
    covered = {i for r in got if r["doc_id"] == 5 for i in range(r["start_word"], r["end_word"])}
    assert set(range(70)) | set(range(79, 149)) <= covered
    assert repeated_passages(docs.limit(0)).count() == 0


def test_every_shared_window_of_fifty_words_is_found(spark):
    pick = random.Random(9)
    pieces = [_words(pick.randrange(50, 90), pick) for _ in range(6)]
    texts = []
    for _ in range(25):
        parts = [pick.choice(pieces) if pick.random() < 0.4 else _words(pick.randrange(1, 60), pick) for _ in range(pick.randrange(1, 6))]
        texts.append([w for p in parts for w in p])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    first, need = {}, set()
    for d, t in enumerate(texts):
        for i in range(len(t) - 49):
            if first.setdefault(tuple(t[i:i + 50]), d) != d:
                need |= {(d, k) for k in range(i, i + 50)}
    got = {(r["doc_id"], k) for r in repeated_passages(docs).collect() for k in range(r["start_word"], r["end_word"])}
    assert need <= got


def test_a_whole_passage_is_found_whoever_holds_its_parts(spark):
    for seed in range(3):
        pick = random.Random(seed)
        whole, rows = _words(80, pick), []
        for i, part in enumerate((whole[:40], whole[40:], whole, whole[:40], whole[40:], whole), 1):
            rows.append((i, " ".join(_words(30, pick) + part + _words(30, pick))))
        got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert [(r["doc_id"], r["source_id"], r["start_word"], r["end_word"]) for r in got] == [(6, 3, 30, 110)]


@pytest.mark.parametrize("few", [16, 3, 2])
def test_a_changed_passage_is_found_whoever_holds_its_seeds_first_and_before(spark, monkeypatch, few):
    """Every seed of the passage has other holders first and in between; with `few` below their number it is a frequent one."""
    monkeypatch.setattr("kithlink.llm.passages.FEW", few)
    pick = random.Random(few)
    passage = _words(60, pick)
    copy = [w + "x" if k in (15, 30, 45) else w for k, w in enumerate(passage)]
    parts = [passage[k:k + 14] for k in range(0, 47, 5)]
    texts = [*parts, passage, *parts, copy, _words(20, pick)]
    rows = [(i, " ".join(_words(30, pick) + part + _words(30, pick))) for i, part in enumerate(texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert [(r["doc_id"], r["source_id"], r["start_word"], r["end_word"], r["matched_words"]) for r in got] == [(21, 10, 30, 90, 57)]


@pytest.mark.parametrize("words, changed, least", [(50, 4, 0.95), (50, 5, 0.95), (60, 9, 0.75), (100, 15, 0.95)])
def test_recall_of_changed_passages(spark, words, changed, least):
    pick, rows, n = random.Random(words + changed), [], 60
    for i in range(n):
        passage = _words(words, pick)
        copy = list(passage)
        for k in pick.sample(range(3, words - 3), changed):
            copy[k] += "x"
        rows += [(j, " ".join(_words(30, pick) + part + _words(30, pick))) for j, part in ((i, passage), (n + i, copy))]
    got = {(r["doc_id"], r["source_id"]) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got & {(n + i, i) for i in range(n)}) >= least * n and all(a - b == n for a, b in got)


@pytest.mark.parametrize("gap", range(10, 61, 5))
def test_exact_passages_on_both_sides_of_a_gap(gap):
    """Whatever stands between them, every word of two exact passages of fifty words is in a passage that holds its bound."""
    pick = random.Random(gap)
    for _ in range(20):
        one, two = (np.array([pick.randrange(1 << 30) for _ in range(50)], "<u4") for _ in range(2))
        between = [np.array([pick.randrange(1 << 30) for _ in range(gap + d)], "<u4") for d in (0, pick.choice([0, 3]))]
        a, b = (np.concatenate((one, x, two)) for x in between)
        anchors = [(i, i) for i in range(pick.randrange(16), 43, 16)] + [(50 + gap + i, 50 + len(between[1]) + i) for i in range(pick.randrange(16), 43, 16)]
        found = passages_of(a, b, np.array(anchors))
        covered = {k for p in found for k in range(p[0], p[1])}
        assert set(range(50)) | set(range(50 + gap, 100 + gap)) <= covered
        assert all(min(p[1] - p[0], p[3] - p[2]) >= 50 and p[5] >= 0.8 and p[4] <= p[1] - p[0] for p in found)


def test_winnowing_leaves_a_seed_in_every_window():
    import pyarrow as pa

    words, bounds = word_hashes(pa.array([" ".join(_words(200, random.Random(1))), "a b c", " ".join(_words(30, random.Random(2)))]))
    runs, run_bounds = shingles(words, bounds, 8)
    chosen = winnow(runs, run_bounds, 16)
    for a, b in zip(run_bounds, run_bounds[1:]):
        for s in range(a, max(a, b - 15)):
            assert any(s <= c < s + 16 for c in chosen)


def test_fenwick_and_chains():
    tree, values, pick = Fenwick(50), {}, random.Random(8)
    for n in range(200):
        place, value = pick.randrange(50), pick.random()
        tree.raise_to(place, value, n)
        values[place] = max(values.get(place, (-1, -1)), (value, n))
        end = pick.randrange(51)
        assert tree.greatest(end) == max([v for p, v in values.items() if p < end], default=(-1e18, -1))
    segs = np.array([[0, 0, 20], [25, 24, 20], [30, 500, 20], [50, 47, 30], [300, 3, 9]])
    assert chains(segs)[0] == [0, 1, 3]
    a = np.arange(100, dtype="<u4")
    assert passages_of(a, a, np.array([[0, 0], [60, 60]]), 50) == [(0, 100, 0, 100, 100, 1.0)]


def _form(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lines(spark):
    base = "The committee shall publish every annual report before the second monday of march"
    texts = [
        f"{base}\nfirst document has another line here today\nshort line", f"Something else entirely written for document two\n{base.upper()}!!\nshort line",
        base.replace("march", "March.") + "\n" + base, None, "", "short line", f"an unrelated opening line of this text\n{base.replace('annual', 'annuall')}",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x")], "doc_id long, text string, line string")
    got = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    assert got[0]["text"] == texts[0] and got[0]["n_dropped"] == 0
    assert got[1]["text"] == "Something else entirely written for document two\nshort line" and got[1]["n_dropped"] == 1
    assert got[2]["text"] == "" and got[2]["n_dropped"] == 2
    assert got[3]["text"] is None and got[3]["n_lines"] == 0 and got[4]["n_lines"] == 1 and got[5]["text"] == "short line"
    assert dedup_lines(docs.limit(0)).count() == 0
    left = drop_repeated_lines(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 0, 1, 3, 4, 5, 6]


def test_fuzzy_lines_go_as_brute_force_says(spark):
    """Of every group by edit similarity all lines but the first go, and no other line does."""
    pick = random.Random(6)
    lines = []
    for n in range(30):
        base = ["".join(pick.choice("abcdefghiklmnoprstu") for _ in range(pick.randrange(3, 9))) for _ in range(pick.choice([4, 8, 15, 40, 90]))]
        for k in range(4):
            copy = list(base)
            for _ in range(k * len(copy) // 30 + (k > 0)):
                i = pick.randrange(len(copy))
                kind = pick.randrange(4)
                copy[i:i + 1] = [copy[i] + "x"] if kind == 0 else [copy[i][1:]] if kind == 1 else [copy[i], "zu"] if kind == 2 else ["ku"]
            lines.append(" ".join(copy).upper() if k == 2 else " ".join(copy) + ".")
    lines += ["word " * 5000, "word " * 5001, "a" * 70_000, "a" * 69_999 + "b"]  # very long lines
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    dropped = {r["doc_id"] for r in dedup_lines(docs, min_words=1).collect() if r["n_dropped"]}
    forms = [_form(x) for x in lines[:-4]]
    alike = [(a, b) for a in range(len(forms)) for b in range(a) if abs(len(forms[a]) - len(forms[b])) <= 0.1 * max(len(forms[a]), len(forms[b])) and a // 4 == b // 4 and _distance(forms[a], forms[b]) <= 0.1 * max(len(forms[a]), len(forms[b])) + 1e-9]
    groups = _components(len(forms), alike)
    first = {min(i for i, g in enumerate(groups) if g == c) for c in set(groups)}
    want = (set(range(len(forms))) - first) | {len(lines) - 3}
    assert len(want) > 60 and want - {len(lines) - 1} == dropped - {len(lines) - 1}


def test_hot_lines_and_repeats_of_lines_with_nulls(spark):
    """A line in every document stays once, near copies of it go, and rows that repeat or lack an id are taken as dedup_lines says."""
    hot = "This very line stands in every one of the documents here"
    rows = [(i, f"{hot}\nown line number {i} {'pqrstuvw'[i % 8] * 9} {i * 7919}") for i in range(1, 60)] + [(None, hot), (7, f"{hot}\nown line number 7 {'pqrstuvw'[7] * 9} {7 * 7919}"), (80, hot + "s"), (81, None), (82, "")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = [r["doc_id"] for r in got if r["text"] and "very line" in r["text"]]
    assert kept == [1]
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (None, 80, 81, 82)} == {None: "", 80: "", 81: None, 82: ""}


def test_registered_query_and_pipeline_drop_short_lines(spark, tmp_path):
    import corpus_pipeline
    from kithlink.llm.queries import op9_lines

    texts = ["Share this page\nHome\n\n今日は天気がとても良いので散歩に行きました", "HOME.\nother\n\n***", "share this  page\n今日は天気がとても良いので散歩に行きました\nlast", "***\nnumber 7\nNumber 8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {0: texts[0], 1: "other\n\n***", 2: "last", 3: texts[3]}
    assert {r["doc_id"]: r["text"] for r in op9_lines(spark, str(tmp_path)).collect()} == want
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()} == want


def test_recall_of_like_lines(spark):
    """Of lines with a tenth of their characters changed, in whole words or anywhere, nearly all meet the line they come from."""
    pick, lines, n = random.Random(7), [], 150
    for i in range(n):
        line = " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randrange(2, 10))) for _ in range(pick.choice([5, 8, 15, 40])))
        most, copy = int(0.1 * len(line)), list(line)
        if i % 2:
            at = pick.randrange(len(line) - most)
            copy[at:at + most] = ["z" if x != " " else x for x in copy[at:at + most]]
        else:
            for k in pick.sample(range(len(line)), int(0.6 * most)):
                copy[k] = "z" if copy[k] != " " else copy[k]
        lines.append((line, "".join(copy)))
    docs = spark.createDataFrame([(n * k + i, pair[k]) for i, pair in enumerate(lines) for k in (0, 1)], "doc_id long, text string")
    dropped = {r["doc_id"] for r in dedup_lines(docs).collect() if r["n_dropped"]}
    assert dropped <= set(range(n, 2 * n)) and len(dropped) >= 0.97 * n


def test_like_lines_that_share_frequent_windows_only(spark):
    """Two windows of ten in common, both in more than 32 lines; everything else has a letter changed."""
    pick = random.Random(4)
    word = lambda n=10: "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    start = f"{word()} {word()}"
    lines = [f"{start} abc{word(7)} {' '.join(word() for _ in range(8))}" for _ in range(60)]
    words = lines[7].split(" ")
    lines.append(" ".join(words[:2] + [w[:6] + "0" + w[7:] for w in words[2:]]))
    assert 0.9 <= 1 - _distance(lines[7], lines[60]) / len(lines[7]) < 0.95
    rows = dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in rows if r["n_dropped"]) == [60]


def test_lines_of_other_letters_are_not_compared(spark, monkeypatch):
    """All lines share a window; most have so many other letters that no edits within the bound make up for it. Letters saturate at 255."""
    from kithlink.llm import lines as module

    pick, compared = random.Random(9), []
    word = lambda letters: "".join(pick.choice(letters) for _ in range(9))
    texts = [f"abcdefghij bcdefghijk {' '.join(word(letters) for _ in range(9))}" for letters in ["eta", "noi", "rhx", "exo", "tir", "ahn", "xyz", "enh"] for _ in range(6)]
    texts += [texts[5][:60] + "xyzxyz" + texts[5][66:], "e" * 600 + "tn" * 30, "e" * 540 + "tn" * 30]
    real = module._alike_in_tiles

    def spy(strays, *rest):
        compared.extend((r["node"], other) for r in strays.collect() for other in r["others"])
        return real(strays, *rest)

    monkeypatch.setattr(module, "_alike_in_tiles", spy)
    rows = dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=1).collect()
    assert sorted(r["doc_id"] for r in rows if r["n_dropped"]) == [48, 50]
    assert len(compared) < 49 * 48 / 2 / 3


def test_letter_counts_reject_no_line_within_the_bound(spark):
    from pyspark.sql import functions as F

    from kithlink.llm.lines import _counts, _may_be_like

    pick, pairs = random.Random(3), []
    for _ in range(400):
        line = [pick.choice("etanoirhsdlu é") for _ in range(pick.choice([10, 30, 100, 900]))]
        copy = list(line)
        for _ in range(int(0.1 * len(line))):
            at, kind = pick.randrange(len(copy)), pick.randrange(3)
            copy[at:at + 1] = [[], ["e"], [copy[at], pick.choice("et\u0436")]][kind]
        pairs.append(("".join(line), "".join(copy)))
    met = spark.createDataFrame(pairs, "x string, y string")
    length, most = F.greatest(F.length("x"), F.length("y")), F.levenshtein("x", "y")
    met = met.filter(most <= 0.1 * length).select(_may_be_like(F.length("x"), _counts(F.col("x")), F.length("y"), _counts(F.col("y")), 0.9).alias("may"))
    assert met.count() > 300 and met.filter("not may").isEmpty()


def _hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, names = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w and item is not None else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == w[k:k + n]:
                    hit |= set(range(i, i + n))
                    names.add(str(item))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_contamination_of_capital_sigmas_and_very_long_texts(spark):
    """A sigma at the end of a word has a small form of its own, which must not tell a document from an item."""
    passage = "\u0391\u03a3'\u0391 b c d e f g h i j"
    texts = [passage, f"x {passage}. y", "\u0391\u03a3 b c d e f g h i j", ("z " * 300_000) + passage, "\u0391\u03c2'\u0391 b c d e f g h i j"]
    items = [(1, passage), (2, "\u0391\u03a3 b c d e f g h i j")]
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got[0][2] == 11 and got[2][2] == 10 and got[3][2] == 11
    assert [g for g in got if g[0] != 3] == sorted((i, *_hits(t, items)) for i, t in enumerate(texts) if i != 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, seed):
    pick = random.Random(seed)
    vocabulary = [*"the of É é a".split(), *(f"q{i}" for i in range(40)), "x-y", "3", "don't"]
    some = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    items = [(i, some(pick.choice([1, 2, 3, 6, 10, 14, 30]))) for i in range(12)] + [(40, None), (41, "!!"), (None, some(12)), (3, some(12))]
    texts = [some(pick.randrange(0, 60)) + " " + (pick.choice(items)[1] or "").upper() + " " + some(pick.randrange(0, 30)) for _ in range(25)] + [None, "", "É " * 30]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (0, "other text", "again")], "doc_id long, text string, item string").repartition(3)
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, start int")
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in contamination(docs, bench).collect())
    want = sorted((i, *_hits(t, items)) for i, t in [*enumerate(texts), (0, texts[0]), (0, "other text")])
    assert got == want
    none = contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(want) and not any(r["contaminated"] for r in none)
    assert contamination(docs.limit(0), bench).count() == 0
