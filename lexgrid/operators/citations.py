"""Citations of one code mined from free text: a windowed grammar as a Python table function, resolved by joins afterwards."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

# --- Fixed values of the grammar: bounds, words and patterns that a right result depends on. ---
GENERAL, SPECIAL = -111189, -180552
LAST_GENERAL, LAST_ARTICLE = 385, 1199
WINDOW, TAIL, AHEAD, AROUND, WIDEST = 260, 60, 150, 90, 200
ORDINALS = ("birinchi", "ikkinchi", "uchinchi", "toʻrtinchi", "beshinchi", "oltinchi", "yettinchi", "sakkizinchi", "toʻqqizinchi", "oʻninchi", "oʻn birinchi", "oʻn ikkinchi")
CODE_NAME = r"Fuqarolik\s+kodeks(?:i[^\W0-9]*|ning)"
OLD_CODE = r"19\d\d\s*-\s*yilgi\s*$"
ALIAS = r"(?<![A-Za-zА-Яа-я0-9ʻʼ'-])FK(?:ning|ga|da|ni)?(?=\s+\d|\s+boshqa)"
SELF = r"(?:ushbu|shu|mazkur)\s+Kodeks[^\W0-9]*"
NAMING = r"\([^()]*\bdeb\s+(?:yuritiladi|ataladi)\b[^()]*\)"
PUBLICATION = r"^\s*\([^()]*(?:[Aa]xborotnoma|[Vv]edomosti|to[ʻ']?plam|№)[^()]*\)"
OTHER_ACT = (
    r"(?i:qonuni|qonunning|kodeksi|farmoni|qarori|nizom|konstitutsiya|buyrugʻi|buyrugi|reglament|yo[ʻʼ']?riqnoma"
    r"|axborotnoma|vedomosti|toʻplam|toplam|№|-songa ilova|qonun\s*\()|Qonun\b"
)
OTHER_CODE = r"\b[A-Z]{2,4}K(?:ning|ga|da|dagi|ni|dan)?\b"
ABOUT = r"to[ʻʼ']?g[ʻʼ']?risida"
NUMBER = r"\d+(?:\s*\([^()]{0,100}\))?"
UNIT_GAP = r"(?:\s*[-–—]\s*|\s+)"
CLAUSE = rf"(?P<numbers>{NUMBER}(?:\s*(?:,|va|hamda|[-–—]+)\s*{NUMBER})*){UNIT_GAP}(?P<unit>modda|bob|paragraf)(?P<ending>\w*)"
SECTIONS = rf"\s*,?\s*(?P<numbers>{NUMBER}(?:\s*(?:,|va)\s*{NUMBER})*)(?:\s*-\s*|\s+)paragr[ai]f"
SECTION_MARK = r"\s*,?\s*§\s*(?P<number>\d+)"
ROMAN_CHAPTER = r"(?<![A-Za-z])(?P<first>[IVXL]{1,6})(?:\s*(?:,|va)\s*(?P<second>[IVXL]{1,6}))?\s*bob\w*"
ROMAN_PART = r"(?<![A-Za-z])(?P<first>[IVXL]{1,6})(?:\s*-\s*|\s+)bo[ʻʼ']?lim\w*"
ARABIC_PART = r"(?<!\d)(?P<number>\d+)(?:\s*-\s*|\s+)bo[ʻʼ']?lim\w*"
# --- End of the fixed values. ---

ordinal = "(?:" + "|".join(sorted((o.replace("ʻ", "[ʻʼ']") for o in ORDINALS), key=len, reverse=True)) + ")"
inner = rf"(?:\d+(?!\s*-?\s*(?:modda|bob))|{ordinal})"
FOLDED = re.IGNORECASE
find_name, find_alias, find_self = re.compile(CODE_NAME, FOLDED), re.compile(ALIAS), re.compile(SELF, FOLDED)
find_clause, find_sections, find_mark = re.compile(CLAUSE, FOLDED), re.compile(SECTIONS), re.compile(SECTION_MARK)
find_unit = re.compile(rf"(?P<token>\d+|{ordinal})\s*-?\s*(?P<unit>qism|band)", FOLDED)
find_units = re.compile(rf"\s*,?\s*(?P<tokens>{inner}(?:\s*,\s*{inner})*(?:\s+va\s+{inner})?)\s*-?\s*(?P<unit>qism|band)", FOLDED)
find_unit_span = re.compile(rf"\s*,?\s*(?P<low>{ordinal})\s*[-–—]\s*(?P<high>{ordinal})\s*-?\s*(?P<unit>qism|band)", FOLDED)
next_item = re.compile(r",|\d+\s*-\s*(?:modda|bob)", FOLDED)
roman_chapter, roman_part, arabic_part = re.compile(ROMAN_CHAPTER), re.compile(ROMAN_PART, FOLDED), re.compile(ARABIC_PART, FOLDED)
naming, publication, old_code = re.compile(NAMING, FOLDED), re.compile(PUBLICATION), re.compile(OLD_CODE, FOLDED)
other_act, other_code, about = re.compile(OTHER_ACT), re.compile(OTHER_CODE), re.compile(ABOUT, FOLDED)


class Citation(NamedTuple):
    target_kind: str  # article, chapter, section, part or act
    article: str | None
    struct_number: int | None
    section_number: int | None
    qism: str | None
    anchor: str  # fuqarolik_kodeksi, fk_alias or self_reference
    listing: str  # single, list or range
    start: int
    end: int
    evidence: str


def blank(text: str, pattern: re.Pattern) -> str:
    """Matches become spaces, so that offsets stay."""
    return pattern.sub(lambda m: " " * len(m[0]), text)


def roman(s: str) -> int:
    """I, V, X, L numerals, subtractive."""
    values = [{"I": 1, "V": 5, "X": 10, "L": 50}[c] for c in s.upper()]
    return sum(-v if any(w > v for w in values[i + 1 : i + 2]) else v for i, v in enumerate(values))


def expand(numbers: str) -> tuple[list[str], str]:
    """The numbers that a list stands for, and whether it is a single number, a list or one range.

    A sub-range of up to WIDEST steps is filled; a wider or falling one keeps its two ends.
    """
    items = [x for x in re.split(r"\s*(?:,|va|hamda)\s*", re.sub(r"\s*\([^()]{0,100}\)", "", numbers)) if x.strip()]
    out: list[str] = []
    ranged = False
    for item in items:
        ends = re.findall(r"\d+", item)
        if len(ends) == 2 and 0 < int(ends[1]) - int(ends[0]) <= WIDEST:
            out += map(str, range(int(ends[0]), int(ends[1]) + 1))
            ranged = len(items) == 1
        else:
            out += ends
    return out, "range" if ranged else "list" if len(out) > 1 else "single"


def position(word: str) -> int:
    return ORDINALS.index(word.lower().replace("ʼ", "ʻ").replace("'", "ʻ"))


def sub_units(tail: str, every: bool) -> list[str | None]:
    """The qism or band of an article from what follows it; every: also past a comma or another number's unit."""
    if m := find_unit_span.match(tail):
        low, high = position(m["low"]), position(m["high"])
        if low <= high:
            return [f"{ORDINALS[i]} {m['unit'].lower()}" for i in range(low, high + 1)]
    if m := find_units.match(tail):
        tokens = re.findall(rf"\d+|{ordinal}", m["tokens"], FOLDED)
        if len(tokens) > 1:
            return [f"{t} {m['unit'].lower()}" for t in tokens]
    m = find_unit.search(tail)
    if m and (every or not next_item.search(tail[: m.start()])):
        return [m[0]]
    return [None]


def stops(gap: str, doc_type: str | None) -> bool:
    """Whether another act begins between what was read and what comes next."""
    if other_act.search(gap) or other_code.search(gap):
        return True
    m = re.search("kodeksning", gap, FOLDED)
    return bool(m) and (bool(about.search(gap[: m.start()])) or doc_type in (None, "code"))


def anchors(text: str, alias: bool, own: bool) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "fuqarolik_kodeksi") for m in find_name.finditer(text) if not old_code.search(text[max(0, m.start() - 14) : m.start()])]
    if alias:
        out += [(m.start(), m.end(), "fk_alias") for m in find_alias.finditer(text)]
    if own:
        out += [(m.start(), m.end(), "self_reference") for m in find_self.finditer(text)]
    return sorted(out)


class Window:
    """What one anchor governs: its text, up to the next anchor at most."""

    def __init__(self, text: str, scanned: str, anchor: tuple[int, int, str], limit: int, doc_type: str | None):
        self.text, self.scanned, self.doc_type, self.limit = text, scanned, doc_type, limit
        self.start, self.at, self.kind = anchor
        self.body = blank(scanned[self.at : min(self.at + WINDOW, limit)], publication)

    def cite(self, kind: str, a: int, b: int, listing: str = "single", article=None, number=None, section=None, qism=None) -> Citation:
        a, b = a + self.at, b + self.at
        near = " ".join(self.text[max(0, a - AROUND) : b + AROUND].split())
        return Citation(kind, article, number, section, qism, self.kind, listing, a, b, near)

    def articles(self, m: re.Match) -> Iterator[Citation]:
        numbers, listing = expand(m["numbers"])
        end = self.at + m.end()
        tail = self.scanned[end : min(end + TAIL, self.limit)]
        genitive = m["ending"].lower().startswith("sining")
        units = sub_units(tail, genitive) if genitive or len(numbers) == 1 else [None]
        for n in numbers:
            for unit in units:
                yield self.cite("article", m.start(), m.end(), listing, article=n, qism=unit)

    def chapters(self, numbers: list[int], listing: str, m: re.Match, look: bool = True) -> Iterator[Citation]:
        """Chapters, or the sections named right after them."""
        ahead = self.body[m.end() : m.end() + AHEAD]
        sections, of = [], listing
        if look and (found := find_sections.match(ahead)):
            values, of = expand(found["numbers"])
            sections = list(map(int, values))
        elif look and (found := find_mark.match(ahead)):
            sections = [int(found["number"])]
        for n in numbers:
            if sections:
                yield from (self.cite("section", m.start(), m.end(), of, number=n, section=s) for s in sections)
            else:
                yield self.cite("chapter", m.start(), m.end(), listing, number=n)

    def citations(self) -> Iterator[Citation]:
        read, clauses, any_ = 0, 0, False
        for m in find_clause.finditer(self.body):
            if stops(self.body[read : m.start()], self.doc_type):
                break
            if m["unit"].lower() == "paragraf":
                continue
            if m["unit"].lower() == "modda":
                yield from self.articles(m)
            else:
                numbers, listing = expand(m["numbers"])
                yield from self.chapters([int(n) for n in numbers], listing, m)
            read, clauses, any_ = m.end(), clauses + 1, True
        for pattern, kind, value in ((roman_part, "part", lambda m: roman(m["first"])), (arabic_part, "chapter", lambda m: int(m["number"]))):
            for m in pattern.finditer(self.body):
                if stops(self.body[: m.start()], self.doc_type):
                    break
                any_ = True
                yield self.cite(kind, m.start(), m.end(), number=value(m))
        if not clauses and (m := roman_chapter.search(self.body)) and not (other_act.search(self.body[: m.start()]) or other_code.search(self.body[: m.start()])):
            numbers = [roman(x) for x in (m["first"], m["second"]) if x]
            any_ = True
            yield from self.chapters(numbers, "list" if len(numbers) > 1 else "single", m, look=len(numbers) == 1)
        if not any_ and self.kind == "fuqarolik_kodeksi":
            yield self.cite("act", self.start - self.at, 0)


def extract(text: str | None, allow_fk_alias: bool = False, is_the_code: bool = False, doc_type: str | None = None) -> list[Citation]:
    """All citations in a text, anchor by anchor: clauses, then parts, then chapters written as parts or in Roman numerals."""
    if not text:
        return []
    scanned = blank(text, naming)
    found = anchors(scanned, allow_fk_alias, is_the_code)
    limits = [*(a for a, _, _ in found[1:]), len(text)][: len(found)]
    return [c for anchor, limit in zip(found, limits, strict=True) for c in Window(text, scanned, anchor, limit, doc_type).citations()]


FIELDS = "target_kind string, article string, struct_number int, section_number int, qism string, anchor string, listing string, start int, end int, evidence string, emit_ord int"


@udtf(returnType=FIELDS)
class ExtractCitations:
    def eval(self, text: str, allow_fk_alias: bool, is_the_code: bool, doc_type: str):
        for i, c in enumerate(extract(text, bool(allow_fk_alias), bool(is_the_code), doc_type)):
            yield (*c, i)


SHORT = 1000  # characters of the texts that are remembered


@lru_cache(4096)
def lately(text: str, allow_fk_alias: bool, is_the_code: bool, doc_type: str | None) -> list[Citation]:
    """What extract() found; texts come again as clauses are formulas."""
    return extract(text, allow_fk_alias, is_the_code, doc_type)


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row_id, field_ord, source_field, text, allow_fk_alias, is_the_code, doc_type) to their citations; a text is read once for all rows of a batch that bear it."""
    kinds = [pa.int32() if t == "int" else pa.string() for t in (f.split()[1] for f in FIELDS.split(", "))]
    names = [f.split()[0] for f in FIELDS.split(", ")]
    for batch in batches:
        seen: dict[tuple, int] = {}
        text, alias, own, kind = (batch.column(i).to_pylist() for i in range(3, 7))
        code = np.array([seen.setdefault(k, len(seen)) for k in zip(text, map(bool, alias), map(bool, own), kind, strict=True)], np.int64)
        found = [(lately if len(k[0]) <= SHORT else extract)(*k) for k in seen]
        size = np.array([*map(len, found)], np.int64)
        cells = list(zip(*((*c, i) for cs in found for i, c in enumerate(cs)), strict=True)) or [()] * len(names)
        each = size[code]
        at = np.repeat((np.cumsum(size) - size)[code] - np.cumsum(each) + each, each) + np.arange(each.sum())
        rows, own_cells = pa.array(np.repeat(np.arange(len(code)), each)), pa.array(at)
        columns = [batch.column(i).take(rows) for i in range(3)] + [pa.array(c, t).take(own_cells) for c, t in zip(cells, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:3], *names])


def citations(spark: SparkSession, provisions: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Citations of each text field of provisions (row_id, allow_fk_alias, is_the_code, doc_type, *fields).

    A cheap pattern on the JVM side keeps texts that can hold an anchor from crossing to Python needlessly; it loses none.
    Provisions are read in the tasks that they come in, so narrow tables that a scan gives in few should be dealt() before.
    """
    may = "(?i)kodeks|(?<![0-9A-Za-z_])fk"
    long = provisions.select("row_id", "allow_fk_alias", "is_the_code", "doc_type", F.posexplode(F.array(*[F.struct(F.lit(f).alias("source_field"), F.col(f).alias("text")) for f in fields])).alias("field_ord", "f"))
    long = long.select("row_id", "field_ord", "f.source_field", F.col("f.text").cast("string").alias("text"), "allow_fk_alias", "is_the_code", F.col("doc_type").cast("string").alias("doc_type")).where(F.col("text").rlike(may))
    return long.mapInArrow(read, StructType([*long.schema.fields[:3], *StructType.fromDDL(FIELDS).fields]))


def target_doc(article: Column) -> Column:
    """The document that holds an article: superscripts are written as one more digit."""
    n = article.try_cast("int")
    base = F.when(n > LAST_ARTICLE, F.floor(n / 10)).otherwise(n)
    return F.when(base <= LAST_GENERAL, F.lit(GENERAL)).when(base <= LAST_ARTICLE, F.lit(SPECIAL)).cast("long")
