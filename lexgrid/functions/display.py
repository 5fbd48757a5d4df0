"""Expressions for what a reader is shown: excerpts, highlights, numbers, badges, the age of a snapshot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an excerpt falls back to, how much of a needle counts, thresholds of badges, years that make a snapshot old.
FALLBACK, NEEDLE, PAD = "fuqarolik kodeksi", 40, 400
HIGH, MIDDLE = 0.9, 0.8
OLD_YEARS = 3.0
RAISED = "⁰¹²³⁴⁵⁶⁷⁸⁹"


def first_hit(text: Column, around: Column, fallback: str = FALLBACK) -> Column:
    """Where (from 1) the first NEEDLE characters of `around`, else the fallback, stand in the text, in any case; 0 if nowhere."""
    low = F.lower(text)
    needle = F.lower(F.substr(around, F.lit(1), F.lit(NEEDLE)))
    own = F.when(F.coalesce(F.length(around), F.lit(0)) > 0, F.call_function("locate", needle, low)).otherwise(0)
    return F.when(own > 0, own).otherwise(F.locate(fallback, low))


def excerpt(text: Column, around: Column, pad: int = PAD, fallback: str = FALLBACK) -> Column:
    """`pad` characters to either side of the first hit, marked as cut; the head of the text where there is none; empty for no text."""
    at = first_hit(text, around, fallback)
    begin = F.greatest(at - pad, F.lit(1))
    cut = F.concat(F.when(at - 1 > pad, "…").otherwise(""), F.substr(text, begin, at + pad - begin), F.lit("…"))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "").when(at > 0, cut).otherwise(F.substr(text, F.lit(1), F.lit(pad)))


def highlight(text: Column, start: Column, end: Column, mark: str = "**") -> Column:
    """The text with [start, end) (from 0) between marks; as it is where that is no span of it."""
    good = F.coalesce((start >= 0) & (start < end) & (end <= F.length(text)), F.lit(False))
    return F.when(good, F.concat(F.substr(text, F.lit(1), start), F.lit(mark), F.substr(text, start + 1, end - start), F.lit(mark), F.substr(text, end + 1))).otherwise(text)


def display_number(number: Column, superscript: Column, shown: Column) -> Column:
    """How an article's number is written: as given, else with its superscript raised."""
    tail = superscript.cast("string")
    base = F.substr(number, F.lit(1), F.length(number) - F.length(tail))
    return F.when(F.length(shown) > 0, shown).when(superscript != 0, F.concat(F.lit("Article "), base, F.translate(tail, "0123456789", RAISED))).otherwise(F.concat(F.lit("Article "), number))


def badge(confidence: Column) -> Column:
    return F.when(confidence >= HIGH, "high").when(confidence >= MIDDLE, "middle").otherwise("low")


def days_between(earlier: Column, later: Column) -> Column:
    """Days from one written date to another, as a long; null where one is no date."""
    day = lambda c: F.try_to_date(c.cast("string"), "yyyy-MM-dd")
    return F.datediff(day(later), day(earlier)).cast("long")


def snapshot_note(version_date: Column, today: Column | None = None, years: float = OLD_YEARS) -> Column:
    """What to say of a snapshot that is so many years old or older; empty for a younger one and for what is no date."""
    age = days_between(version_date, F.current_date() if today is None else today) / 365.25
    return F.when(age >= years, F.concat(F.lit("snapshot of "), version_date, F.lit(", about "), F.bround(age, 0).cast("int").cast("string"), F.lit(" years old"))).otherwise("")


def evidence_kind(field: Column) -> Column:
    """What a citation in a field is worth: the act's own words, an editor's pointer, or a note of change."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in (("article_text", "normative"), ("cross_references", "editorial"), ("amendment_note", "amendment")) for x in pair]), field)


def unless(switch: bool, condition: Column) -> Column:
    """(switch OR condition): a filter that a reader turns off. A null condition passes only where it is off."""
    return F.lit(True) if switch else condition
