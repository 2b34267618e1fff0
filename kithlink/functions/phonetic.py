"""Phonetic codes: Soundex of both profiles as column expressions, simplified Metaphone and NYSIIS as Arrow UDFs."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters with a Soundex code.
CODED, CODES = "BFPVCGJKQSXZDTLMNR", "111122222222334556"


def soundex(text: Column, profile: str = "main") -> Column:
    """Code of the whole text, not of its first word; '0000' for ''.

    main: the first character stays whatever it is; letters without a code vanish and don't part equal codes.
    evaluate: characters without a code stay, and equal neighbours become one, letters and digits alike.
    """
    upper = F.upper(F.coalesce(text, F.lit("")))
    first, rest = F.substring(upper, 1, 1), F.substring(upper, F.lit(2), F.length(upper))
    if profile == "main":
        own = F.translate(F.regexp_replace(first, f"[^{CODED}]", ""), CODED, CODES)
        coded = F.concat(own, F.translate(F.regexp_replace(rest, f"[^{CODED}]", ""), CODED, CODES))
        once = F.regexp_replace(coded, r"(.)\1+", "$1")
        body = F.substring(once, F.length(own) + 1, F.length(once))
        code = F.rpad(F.concat(first, body), 4, "0")
    else:
        coded = F.concat(first, F.translate(rest, CODED + "0", CODES))
        code = F.rpad(F.regexp_replace(coded, r"(?s)(.)\1+", "$1"), 4, "0")
    return F.when(upper == "", F.lit("0000")).otherwise(code)


# What each context turns into, the first fitting rule wins. '' says nothing.
METAPHONE_RULES = [
    (r"\A[AEIOUY]", None), (r"[AEIOUY]", ""),
    (r"(?<=M)B\Z", ""), (r"B", "B"),
    (r"C(?=[EIY])", "S"), (r"CH", "X"), (r"C", "K"),
    (r"D[GE]", "J"), (r"D", "T"),
    (r"G(?=[EIY])", "J"), (r"GH(?=[^AEIOU])", "K"), (r"G(?=N\Z)", ""), (r"G", "K"),
    (r"(?<![AEIOU])H(?=[AEIOU])", "H"), (r"H", ""),
    (r"(?<!C)K", "K"), (r"K", ""),
    (r"PH", "F"), (r"Q", "K"), (r"S[CH]", "X"), (r"TI(?=[AO])", "X"), (r"TH", "0"),
    (r"V", "F"), (r"W(?=[AEIOU])", "W"), (r"W", ""), (r"X", "KS"), (r"Z", "S"),
    (r"[FJLMNPRST]", None), (r".", ""),
]
METAPHONE_STARTS = [("KN", ""), ("GN", ""), ("PN", ""), ("AE", ""), ("WR", ""), ("X", "S"), ("WH", "W")]
NYSIIS_STARTS = [("MAC", "MCC"), ("KN", "N"), ("K", "C"), ("PH", "FF"), ("PF", "FF"), ("SCH", "SSS")]
NYSIIS_ENDS = [("EE", "Y"), ("IE", "Y"), ("DT", "D"), ("RT", "RD"), ("RD", "RD"), ("NT", "ND"), ("ND", "ND")]

# The end of the code, a letter and the one after it, and what the end of the code becomes; the first fitting rule wins.
NYSIIS_RULES = [
    (r"A[AEIOU].", r"A"), (r"(.)[AEIOU].", r"\1A"),
    (r"([^AEIOU])H[AEIOU]", r"\1\1"), (r"(.)H.", r"\1"),
    (r"([AEIOU])W.", r"\1W"), (r"(.)W.", r"\1"),
    (r"HP.", r"F"), (r"CK.", r"CC"),
    (r"(.)Q.", r"\1G"), (r"(.)Z.", r"\1S"), (r"(.)M.", r"\1N"),
    (r"(.)([KSP]).", r"\1\2"),
    (r"(.)\1.", r"\1"), (r"(.)(.).", r"\1\2"),
]

_METAPHONE = re.compile("|".join(f"(?P<r{n}>{p})" for n, (p, _) in enumerate(METAPHONE_RULES)), re.DOTALL)
_NYSIIS = [(re.compile(p, re.DOTALL), said) for p, said in NYSIIS_RULES]


def metaphone_code(text: str | None) -> str:
    text = (text or "").upper()
    at, said = next(((1, said) for head, said in METAPHONE_STARTS if text.startswith(head)), (0, ""))
    out = [said]
    while at < len(text):
        if at and text[at] == text[at - 1] != "C":  # a doubled letter is said once
            at += 1
            continue
        hit = _METAPHONE.match(text, at)
        said = METAPHONE_RULES[int(hit.lastgroup[1:])][1]
        out.append(hit.group() if said is None else said)
        at = hit.end()
    return "".join(out)[:10]


@lru_cache(maxsize=1 << 15)
def _rewritten(end: str, letter: str, following: str) -> str:
    """What the end of a NYSIIS code becomes with the next letter."""
    return next(hit.expand(said) for rule, said in _NYSIIS if (hit := rule.fullmatch(end + letter + following)))


def nysiis_code(text: str | None) -> str:
    text = (text or "").upper()
    if not text:
        return ""
    text = next((said + text[len(head):] for head, said in NYSIIS_STARTS if text.startswith(head)), text)
    text = next((text[:-len(tail)] + said for tail, said in NYSIIS_ENDS if text.endswith(tail)), text)
    code, end = "", text[0]
    for letter, following in zip(text[1:], text[2:] + " "):
        new = _rewritten(end, letter, following)
        code, end = code + new[:-1], new[-1]
    return (code + end).removesuffix("S").removesuffix("A")[:6]


@F.pandas_udf(StringType())
def metaphone(texts: pd.Series) -> pd.Series:
    return texts.map(metaphone_code)


@F.pandas_udf(StringType())
def nysiis(texts: pd.Series) -> pd.Series:
    return texts.map(nysiis_code)
