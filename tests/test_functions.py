"""Scalar functions: values worked out by hand, and properties."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kithlink.functions import address as A
from kithlink.functions import phonetic as P
from kithlink.functions import similarity as S
from kithlink.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def run(build, *texts):
        row = spark.createDataFrame([texts], ", ".join(f"c{i} string" for i in range(len(texts))))
        return row.select(build(*(F.col(f"c{i}") for i in range(len(texts)))).alias("v")).first()["v"]

    return run


def test_normal_forms(value):
    assert value(T.normalize_name, "Acme Robotics, Incorporated") == "acme robotics inc"
    assert value(T.normalize_name, "Foo Limited Liability Company") == "foo ltd liability co"
    assert value(T.normalize_address, "123 Main St, Seattle, WA 98101-1234") == "123 main st seattle wa 98101 1234"
    assert value(T.normalize_name, None) == "" and value(T.normalize_name, "  ") == ""
    assert value(T.normalize_name, "Café ﬁnÅ co.") == "cafe fina co"
    assert value(lambda c: T.normalize_name(c, "evaluate"), "A_b—c Services") == "a_b c svc"
    assert value(lambda c: T.normalize_name(c, "main"), "A_b Services") == "a b svcs"
    assert value(T.normalize_address, "No 5 Centre Road") == "# 5 ctr rd"


def test_tokens_and_grams(value):
    assert value(T.tokens, "a bc the def bc") == ["bc", "the", "def", "bc"]
    assert value(lambda c: T.tokens(c, profile="evaluate"), "a bc the def") == ["the", "def"]
    assert value(T.ngrams, "ab cd") == ["abc", "bcd"] and value(T.ngrams, "a b") == ["ab"] and value(T.ngrams, " ") == []
    assert sorted(value(T.landmark_tokens, "12 main st near old mill")) == ["12", "main", "mill", "old"]
    assert value(T.remove_punctuation, "a.b-c!") == "abc" and value(lambda c: T.remove_punctuation(c, "-"), "a.b-c!") == "ab-c"
    assert value(lambda c: T.expand_abbreviations(c, {"st": "street"}), "main st  x") == "main street x"


def test_address_parts(value):
    part = lambda text: tuple(value(A.address_components, text)[k] for k in ("house_number", "postal_code", "street", "city", "state"))
    assert part("123 main st seattle wa 98101") == ("123", "98101", "main st seattle wa", "123 main st seattle wa", "")
    assert part("1234 oak ave") == ("", "1234", "oak ave", "oak ave", "")
    assert part("12 a rd, town, ks 66044") == ("12", "66044", "a rd, town, ks", "town", "ks")
    assert value(A.postal_code, "v6b 1a1") == "V6B1A1" and value(lambda c: A.postal_code(c, "evaluate"), "v6b 1a1") == ""
    assert value(A.postal_code, "sw1a 1aa london") == "SW1A1AA"
    assert value(lambda c: A.postal_code(c, "evaluate"), "98101-1234") == "98101"
    assert value(lambda c: A.comma_part(c, -2), "a, b,, c") == "b" and value(lambda c: A.comma_part(c, -2), "a") == ""


def test_soundex(value):
    for text, main, evaluate in [("tymczak", "T520", "TY52"), ("pfister", "P236", "P1I2"), ("acme robotics", "A256", "A25E"), ("", "0000", "0000")]:
        assert (value(P.soundex, text), value(lambda c: P.soundex(c, "evaluate"), text)) == (main, evaluate)
    assert value(P.soundex, "7 eleven") == "7415"


def test_metaphone_and_nysiis():
    words = {"KNIGHT": "NKT", "": "", "xylo": "SL", "whale": "WHL", "thumb": "0M", "church": "XRX", "edge": "EJ", "nation": "NXN", "pizza": "PS", "phone": "FN", "accent": "AKSNT"}
    assert {w: P.metaphone_code(w) for w in words} == words
    words = {"KNIGHT": "NAGT", "": "", "macdonald": "MCDANA", "queen": "QAN", "phil": "FAL", "a": ""}
    assert {w: P.nysiis_code(w) for w in words} == words


def test_similarities(value):
    jw = S.jaro_winkler_score
    assert jw("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert jw("acme robotics", "acme robotics inc") == pytest.approx(0.952941, abs=1e-6)
    assert jw("abcd", "azzz") == pytest.approx(0.55) and jw("abcxxx", "bcaxxx") == pytest.approx(0.916667, abs=1e-6)
    assert jw("", "") == 1 and jw("", "a") == 0
    assert value(S.levenshtein_similarity, "acme robotics", "acme robotics inc") == pytest.approx(0.764706, abs=1e-6)
    assert value(S.levenshtein_similarity, "café", "cafe") == 0.75 and value(S.levenshtein_similarity, "", "") == 1
    sets = lambda f: lambda a, b: f(T.words(a), T.words(b))
    for text, jaccard, low, high in [(("acme robotics", "acme robotics inc"), 2 / 3, 1.0, 2 / 3), (("", ""), 1.0, 1.0, 0.0), (("", "a"), 0.0, 0.0, 0.0)]:
        assert value(sets(S.jaccard), *text) == pytest.approx(jaccard)
        assert value(sets(S.overlap_ratio), *text) == pytest.approx(low)
        assert value(sets(lambda a, b: S.overlap_ratio(a, b, "evaluate")), *text) == pytest.approx(high)
    assert value(sets(S.count_ratio), "a a b", "c") == pytest.approx(1 / 3) and value(sets(lambda a, b: S.count_ratio(a, b, "evaluate")), "a a b", "c") == 0.5
    assert value(S.abbreviation_match, "j smith", "john smith") == 1 and value(S.abbreviation_match, "j smith", "jon") == 0


@given(st.text("abcé ", max_size=12), st.text("abcé ", max_size=12))
def test_jaro_winkler_properties(a, b):
    score = S.jaro_winkler_score(a, b)
    assert 0 <= score <= 1 and S.jaro_winkler_score(a, a) == 1
    assert len(P.metaphone_code(a)) <= 10 and len(P.nysiis_code(b)) <= 6


def test_scrub_and_sigmoid(spark):
    rows = spark.createDataFrame([(1.5,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r["x"] for r in rows.select(S.scrub(F.col("x")).alias("x")).collect()] == [1.5, 0, 0, 0, 0]
    assert spark.range(1).select(S.sigmoid(F.lit(0.0)).alias("x")).first()["x"] == 0.5


def test_sql_names(spark):
    S.register(spark)
    row = spark.sql("select kl_jaro_winkler('martha', 'marhta') as a, kl_metaphone('knight') as b, kl_nysiis('knight') as c").first()
    assert (round(row["a"], 4), row["b"], row["c"]) == (0.9611, "NKT", "NAGT")


def test_fold_takes_every_letter(spark):
    import unicodedata

    pick = random.Random(1)
    texts = ["".join(chr(pick.choice([*range(0x20, 0x250), *range(0x300, 0x310), *range(0x1E00, 0x1F00), 0xFB01, 0x2460, 0x3041])) for _ in range(12)) for _ in range(300)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.fold(F.col("t")).alias("m"), T.fold(F.col("t"), "evaluate").alias("e")).collect()
    for t, r in zip(texts, got):
        n = unicodedata.normalize("NFKC", t)
        assert r["m"] == "".join(c for c in unicodedata.normalize("NFKD", n) if not unicodedata.combining(c))
        assert r["e"] == "".join(c for c in unicodedata.normalize("NFD", n) if unicodedata.category(c) != "Mn")


def test_jaro_winkler_of_bytes_equals_that_of_letters():
    import random

    from kithlink.functions import similarity

    pick = random.Random(4)
    for _ in range(3000):
        a, b = ("".join(pick.choice("abc d1") for _ in range(pick.randint(1, 14))) for _ in "xy")
        for reach in (0, 1, 3, 6):
            assert similarity._matches_of_bytes(a, b, reach) == tuple([x if isinstance(x, int) else ord(x) for x in found] for found in similarity._matches(a, b, reach))
    assert similarity._matches_of_bytes("\u00e9", "e", 1) is None and similarity._matches_of_bytes("a\0", "a", 1) is None
