"""Column expressions that several queries share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tiers of document types, confidence by source field and target kind, Roman numerals, ordinals, months.
TIERS = {"constitution": 1, "code": 2, "law": 3, "decree": 4, "resolution": 5, "order": 6}
CONFIDENCE = {
    ("text", "article"): 0.95, ("text", "chapter"): 0.85, ("text", "act"): 0.75,
    ("note", "article"): 0.9, ("note", "chapter"): 0.8, ("note", "act"): 0.7,
}
MONTHS = ("yanv", "fevr", "mart", "apre", "may", "iyun", "iyul", "avgu", "sent", "okta", "noya", "deka")
APOSTROPHES = "ʻʼ’‘`´ʹ′"


def tier(kind: Column) -> Column:
    out = F
    for name, value in TIERS.items():
        out = out.when(kind == name, value)
    return out.otherwise(9)


def collapse(text: Column) -> Column:
    """Runs of white space (Unicode's) as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def norm_title(text: Column) -> Column:
    """Lower case, one apostrophe, single spaces, no punctuation at the ends."""
    return F.btrim(collapse(F.translate(F.lower(text), APOSTROPHES, "'" * len(APOSTROPHES))), F.lit(" .,;:\"'"))


def roman(n: Column) -> Column:
    """1 to 89 in Roman numerals."""
    tens = F.element_at(F.array(*map(F.lit, ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX"))), (F.floor(n / 10) + 1).cast("int"))
    ones = F.element_at(F.array(*map(F.lit, ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"))), (n % 10 + 1).cast("int"))
    return F.concat(tens, ones)


def month_number(word: Column) -> Column:
    """The month that a word begins with, null if none."""
    out = F
    for i, m in enumerate(MONTHS, 1):
        out = out.when(F.lower(word).startswith(m), i)
    return out.otherwise(F.lit(None).cast("int"))


def hierarchy(src: Column, dst: Column, own: Column) -> Column:
    """How a source of one tier stands to a target: the conditions are asked in this order."""
    return F.when(own, "internal").when(src == 9, "unknown").when(src > dst, "below").when(src == dst, "same").otherwise("above")


def crop(text: Column, start: Column, size: int) -> Column:
    """`size` characters from `start` (1 or what is below counts as 1)."""
    return F.substr(text, F.greatest(start, F.lit(1)), F.lit(size))
