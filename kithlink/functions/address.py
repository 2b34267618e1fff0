"""Parts of addresses as column expressions: '' where there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kithlink.functions.text import let

# Patterns of postal codes, house numbers and units.
US_CODE = r"(?U)\b\d{5}(?:-\d{4})?\b"
CA_CODE = r"(?U)\b[A-Za-z]\d[A-Za-z]\s?\d[A-Za-z]\d\b"
UK_CODE = r"(?U)\b[A-Za-z]{1,2}\d[A-Za-z\d]?\s?\d[A-Za-z]{2}\b"
ANY_CODE = r"(?U)\b\d{4,6}\b"
HOUSE = {"main": r"(?U)\b(\d+[A-Za-z]?(?:-\d+)?)\b", "evaluate": r"(?U)\b(\d+[A-Za-z]?)\b"}
LEADING_HOUSE = r"(?U)^\d+[A-Za-z]?(?:-\d+)?\s+"
FIVE_DIGITS = r"(?U)\b(\d{5})(?:-\d{4})?\b"
UNIT = r"(?Ui)\s+(?:ste|suite|unit|apt|apartment|#)\s+[\w-]+"


def _hit(text: Column, pattern: str, group: int = 0) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def postal_code(text: Column, profile: str = "main") -> Column:
    """First US code, else (main) Canadian, else British, both closed up in capitals, else four to six digits."""
    if profile == "evaluate":
        return F.coalesce(_hit(text, FIVE_DIGITS, 1), _hit(text, ANY_CODE), F.lit(""))
    closed = [F.upper(F.replace(_hit(text, p), F.lit(" "), F.lit(""))) for p in (CA_CODE, UK_CODE)]
    return F.coalesce(_hit(text, US_CODE), *closed, _hit(text, ANY_CODE), F.lit(""))


def house_number(text: Column, profile: str = "main") -> Column:
    return F.coalesce(_hit(text, HOUSE[profile], 1), F.lit(""))


def street_name(text: Column) -> Column:
    """What is left without a leading house number and units: city and state words too."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, LEADING_HOUSE, ""), UNIT, ""))


def comma_part(text: Column, index: int) -> Column:
    """Part `index` (negative: from the end) of the non-empty parts between commas, '' if there is none."""
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.coalesce(F.try_element_at(parts, F.lit(index)), F.lit(""))


def address_components(text: Column) -> Column:
    """struct(house_number, street, city, state, postal_code, raw); every occurrence of the postal code is taken out before the rest is read."""

    def of(read: Column) -> Column:
        rest, last, before = read["rest"], comma_part(read["rest"], -1), comma_part(read["rest"], -2)
        return F.struct(
            house_number(rest).alias("house_number"), street_name(rest).alias("street"), F.when(before != "", before).otherwise(last).alias("city"),
            F.when(before != "", last).otherwise(F.lit("")).alias("state"), read["code"].alias("postal_code"), text.alias("raw"),
        )

    rest = lambda code: F.when(code != "", F.replace(text, code, F.lit(""))).otherwise(text)
    return let(let(postal_code(text), lambda code: F.struct(code.alias("code"), rest(code).alias("rest"))), of)
