"""Normal forms, tokens and n-grams as column expressions.

profile: "main" or "evaluate"; the two differ in what counts as punctuation, in the dictionaries and in the tokens.
Null texts count as empty throughout.
"""

from __future__ import annotations

import string
import unicodedata
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kithlink.functions.dictionaries import ADDRESS, COMMON_ADDRESS_TOKENS, SUFFIXES

PUNCTUATION = string.punctuation
SPACES = r"(?U)\s+"


def _folded(c: str) -> str:
    parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", c))
    return "".join(p for p in parts if not unicodedata.combining(p))


#: Latin letters, by rule: those that fold to one character; marks that fold to none.
_LATIN = [chr(c) for c in chain(range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0x300, 0x370))]
_SINGLE = [(c, _folded(c)) for c in _LATIN if len(_folded(c)) == 1 and _folded(c) != c]
_GONE = [c for c in _LATIN if _folded(c) == ""]
_FROM, _TO = "".join(c for c, _ in _SINGLE) + "".join(_GONE), "".join(t for _, t in _SINGLE)
#: What translate() folds rightly; a text with anything else goes through Python.
_KNOWN = "[^\\x00-\\x7F" + "".join(c for c in _LATIN if len(_folded(c)) <= 1) + "]"


@F.pandas_udf(StringType())
def _fold_main(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", t)) if not unicodedata.combining(c)))


@F.pandas_udf(StringType())
def _fold_evaluate(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", t)) if unicodedata.category(c) != "Mn"))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalize_unicode(text: Column) -> Column:
    """NFKC; ASCII texts don't leave the JVM as strings."""
    other = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(F.when(other, _nfkc(F.when(other, text))).otherwise(text), F.lit(""))


def fold(text: Column, profile: str = "main") -> Column:
    """NFKC without accents: by translate() where the text is Latin, else in Python (those rows only are sent as strings)."""
    text = F.coalesce(text, F.lit(""))
    other = text.rlike(_KNOWN)
    udf = _fold_main if profile == "main" else _fold_evaluate
    return F.when(other, udf(F.when(other, text))).otherwise(F.translate(text, _FROM, _TO))


remove_accents = fold


def lowercase(text: Column) -> Column:
    return F.lower(text)


def remove_punctuation(text: Column, keep: str = "") -> Column:
    return F.translate(text, "".join(c for c in PUNCTUATION if c not in keep), "")


def punctuation_to_space(text: Column, profile: str = "main") -> Column:
    """main: the ASCII marks; evaluate: everything but Unicode word characters and spaces (so the underscore stays)."""
    return F.translate(text, PUNCTUATION, " " * len(PUNCTUATION)) if profile == "main" else F.regexp_replace(text, r"(?U)[^\w\s]", " ")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


remove_extra_spaces = collapse_whitespace


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """df with these columns computed once a row: generated ones aren't pasted into the expressions that use them."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def words(text: Column) -> Column:
    """Words between white space; an empty text has none."""
    return F.filter(F.split(collapse_whitespace(text), " "), lambda w: w != "")


def _lookup(word: Column, table: dict[str, str]) -> Column:
    entries = F.create_map(*(F.lit(x) for pair in sorted(table.items()) for x in pair))
    return F.coalesce(F.try_element_at(entries, F.lower(F.rtrim(word, F.lit(".,")))), word)


def expand_abbreviations(text: Column, table: dict[str, str]) -> Column:
    entries = F.create_map(*(F.lit(x) for pair in sorted(table.items()) for x in pair))
    return F.array_join(F.transform(words(text), lambda w: F.coalesce(F.try_element_at(entries, w), w)), " ")


def standardize_business_suffixes(text: Column, profile: str = "main") -> Column:
    """Only the last three words may be suffixes."""
    table = SUFFIXES[profile]

    def of(all_: Column) -> Column:
        head = F.slice(all_, 1, F.greatest(F.size(all_) - 3, F.lit(0)))
        tail = F.slice(all_, F.greatest(F.size(all_) - 2, F.lit(1)), 3)
        return F.array_join(F.concat(head, F.transform(tail, lambda w: _lookup(w, table))), " ")

    return let(words(text), of)


def standardize_address_abbreviations(text: Column, profile: str = "main") -> Column:
    table = ADDRESS[profile]
    return F.array_join(F.transform(words(text), lambda w: _lookup(w, table)), " ")


def _plain(text: Column, profile: str) -> Column:
    return punctuation_to_space(F.lower(fold(text, profile)), profile)


def normalize_name(text: Column, profile: str = "main") -> Column:
    """The normal form of a name; '' for null."""
    return standardize_business_suffixes(_plain(text, profile), profile)


def normalize_address(text: Column, profile: str = "main") -> Column:
    return standardize_address_abbreviations(_plain(text, profile), profile)


def tokens(text: Column, min_length: int | None = None, stopwords: list[str] | None = None, profile: str = "main") -> Column:
    """Tokens in order, repeats kept. main: marks are spaces, lower case, at least 2 letters; evaluate: words of at least 3."""
    least = min_length if min_length is not None else 2 if profile == "main" else 3
    found = words(F.lower(punctuation_to_space(text)) if profile == "main" else text)
    drop = F.array(*map(F.lit, stopwords)) if stopwords else None
    return F.filter(found, lambda t: (F.length(t) >= least) & ~F.array_contains(drop, t) if drop is not None else F.length(t) >= least)


def ngrams(text: Column, n: int = 3) -> Column:
    """Runs of n characters without white space; a shorter text is one, an empty one none."""
    def of(bare: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.length(bare) - n + 1), lambda i: F.substring(bare, i, F.lit(n)))
        return F.when(F.length(bare) >= n, many).when(bare == "", F.array().cast("array<string>")).otherwise(F.array(bare))

    return let(F.regexp_replace(F.lower(text), SPACES, ""), of)


def landmark_tokens(address: Column) -> Column:
    return F.array_except(F.array_distinct(tokens(address)), F.array(*map(F.lit, COMMON_ADDRESS_TOKENS)))
