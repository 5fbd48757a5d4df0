"""Repeal clauses and amendment notes as events, and what they leave current."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import collapse, month_number, norm_title
from .citations import ORDINALS
from .windows import latest, top1

# --- Fixed values: how clauses, notes and verbs are written. ---
TRIGGER = r"(?isU)kuchini\s+yo\wqotgan\s+deb\s+topilsin(.{0,8000})"
ITEM = r"(?isU)(\d{4})-yil\s+(\d{1,2})-([a-zʻʼ]+)\w*\s+qabul\s+qilingan[^“”\"]{0,120}?[“\"]([^“”\"]{6,300})[”\"](?=(.{0,60}))(?:\s*\w*\s*([\dA-ZIVX\-]{2,14})-sonli)?(?=(.{0,400}))"
NOT_STATUTE = r"(?iU)^\s*(?:g[ai]\s+)?(?:\S+\s+){0,4}?(?:Qaror|Farmon)"
LOCATOR = (
    r"(?iU)^[\s\w\-]{0,80}?(?:\([^()]{0,300}\)\s*)?((?:\d+[\d\-]*\s*(?:,\s*|\s+va\s+)\s*){0,6}\d+[\d\-]*\s*-\s*(?:modda|qism|band|bob|paragraf)\w*"
    r"|[IVXL]{1,6}(?:\s*-\s*|\s+)(?:modda|qism|band|bob|paragraf|bo[ʻʼ']?lim)\w*)"
)
NOTE = r"\((?:[^()]|\([^()]*\))*\)"
EVENT = (
    r"(?isU)^(.*?)O\wzbekiston\s+Respublikasi\w*\s+(\d{4})-yil\s+(\d{1,2})-([a-z]+)\w*\s+"
    r"(?:O\wRQ-(\d+)-sonli|(\d+)[-–](?:([IVX]+)-)?son(?:li)?)\s+Qonun\w*\s+(.*?)(?:\s*—\s*(.*?))?\)$"
)
ANY_DATE = r"(?iU)(\d{4}-yil\s+\d{1,2}-[a-z]+)"
AFTER_SOURCE = r"(?isU)asosan\s+(.+?)\s+(?:o\wz\s+kuchini\s+yo\wqot\w*|chiqaril\w*)\s+sanasi"
VERBS = (
    ("tahririda", "restated"), (r"to\wldirilgan", "supplemented"), (r"to\wldirib", "supplemented"), ("chiqarib tashlangan", "removed"), ("chiqaril", "removed"),
    ("almashtirilgan", "replaced"), ("kiritilgan", "inserted"), (r"kuchini yo\wqot", "voided"), ("kuchga ega emas", "voided"),
)
ARTICLES = r"(?iU)((?:\d+(?:\s*(?:,|va|hamda|[-–—]+)\s*)?)+)(?:\s*[-–—]\s*|\s+)(modda|bob|paragraf)"
UNIT_LOCATOR = r"(?iU)^(\d+)-moddaning\s+(.+?)\s+qismi(?:ning)?$"
UNIT_DIGITS, UNIT_WORD = r"(?iU)^(\d+)\s*-?\s*(?:qism|band)$", r"(?iU)^(.+?)\s+(?:qism|band)$"
FOOTNOTE = r"(?is)in\s+accordance\s+with\s+the\s+Laws?\s+of\s+the\s+Republic\s+of\s+Uzbekistan\s+dated(.*?)\)_"
FOOTNOTE_ACT = r"(?i)Z\s*R\s*U\s*-\s*(\d+)"
AFTER = 460  # characters after an item that its groups look at: 60 and 400
# --- End of the fixed values. ---


def iso(year: Column, day: Column, month: Column) -> Column:
    return F.concat_ws("-", year, F.lpad(month_number(month).cast("string"), 2, "0"), F.lpad(day, 2, "0"))


def verb(text: Column) -> Column:
    """The first of the verbs, in their order."""
    out = F
    for pattern, name in VERBS:
        out = out.when(text.rlike(f"(?iU){pattern}"), name)
    return out.otherwise("other")


def expanded(numbers: Column) -> Column:
    """The numbers that a written list with ranges stands for."""
    items = F.filter(F.split(numbers, r"\s*(?:,|va|hamda)\s*"), lambda x: x.rlike(r"\d"))
    ends = lambda x: F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1)).cast("array<int>")
    span = lambda e: F.element_at(e, -1) - F.element_at(e, 1)
    return F.flatten(F.transform(items, lambda x: F.when((F.size(ends(x)) == 2) & (span(ends(x)) > 0) & (span(ends(x)) <= 200), F.sequence(F.element_at(ends(x), 1), F.element_at(ends(x), -1))).otherwise(ends(x))))


def repeal_items(provisions: DataFrame) -> DataFrame:
    """(row_id, doc_id, item_no, cited_date, iso_date, title, cited_number, locator, non_statute) of provisions (row_id, doc_id, text).

    Read is what follows the first clause that repeals, up to 8,000 characters; a locator right after an item means
    that only a part is repealed. The tail is searched once; an item's groups are then read from its own stretch.
    """
    rows = provisions.where(F.col("text").rlike("(?i)topilsin")).select("row_id", "doc_id", F.regexp_extract("text", TRIGGER, 1).alias("tail"))
    matches = rows.withColumn("m", F.regexp_extract_all("tail", F.lit(ITEM), F.lit(0)))  # no filter on them: it would run in the scan, and on what they are joined with
    step = lambda a, x: F.struct((F.call_function("locate", x, F.col("tail"), a["next"]) + F.length(x)).alias("next"), F.array_append(a["at"], F.call_function("locate", x, F.col("tail"), a["next"])).alias("at"))
    places = F.aggregate("m", F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("at")), step, lambda a: a["at"])
    stretch = F.substr("tail", F.col("i.at"), F.length("i.m") + AFTER)
    mark = "\u0001"
    cells = F.split(F.regexp_replace(stretch, f"(?s)^{ITEM}.*$", mark.join(f"${k}" for k in range(1, 8))), mark)
    found = matches.select("row_id", "doc_id", "tail", F.posexplode(F.arrays_zip(F.col("m").alias("m"), places.alias("at"))).alias("item_no", "i"))
    found = found.select("row_id", "doc_id", "item_no", cells.alias("g"))
    g = lambda k: F.element_at("g", k)
    return found.select(
        "row_id", "doc_id", (F.col("item_no") + 1).alias("item_no"), F.concat(g(1), F.lit("-yil "), g(2), F.lit("-"), g(3)).alias("cited_date"), iso(g(1), g(2), g(3)).alias("iso_date"),
        norm_title(g(4)).alias("title"), F.nullif(F.upper(F.trim(g(6))), F.lit("")).alias("cited_number"), F.nullif(collapse(F.regexp_extract(g(7), LOCATOR, 1)), F.lit("")).alias("locator"), g(5).rlike(NOT_STATUTE).alias("non_statute"),
    )


def amendments(notes: DataFrame) -> DataFrame:
    """Events of notes (row_id, doc_id, host_article, note): one for each article that a parenthesised clause names, else one for the host.

    row_id, doc_id, host_article, clause_no, target_article, locator, change_type, amend_date, act_number, effective_date, evidence.
    """
    clauses = notes.select("row_id", "doc_id", "host_article", F.posexplode(F.regexp_extract_all("note", F.lit(NOTE), F.lit(0))).alias("clause_no", "evidence"))
    mark = "\u0001"  # all groups by one match of the clause
    cells = F.split(F.regexp_replace("evidence", EVENT, mark.join(f"${k}" for k in range(1, 10))), mark)
    clauses = clauses.withColumn("g", cells).where(F.size("g") == 9)
    g = lambda k: F.element_at("g", k)
    number = F.when(g(5) != "", F.concat(F.lit("OʻRQ-"), g(5))).otherwise(F.concat(g(6), F.when(g(7) != "", F.concat(F.lit("-"), g(7))).otherwise(""), F.lit("-son")))
    dates = F.transform(F.regexp_extract_all("evidence", F.lit(ANY_DATE), F.lit(1)), lambda x: iso(F.substring(x, 1, 4), F.regexp_extract(x, r"\s(\d{1,2})-", 1), F.regexp_extract(x, r"-([^-\s]+)$", 1)))
    scope = F.concat_ws(" ", g(1), g(8))
    listed = F.when(F.lower(F.regexp_extract(scope, ARTICLES, 2)) == "modda", expanded(F.regexp_extract(scope, ARTICLES, 1)))
    own = F.btrim(g(1), F.lit(" ("))
    late = F.trim(F.regexp_extract("evidence", AFTER_SOURCE, 1))
    read = clauses.select(
        "row_id", "doc_id", "host_article", (F.col("clause_no") + 1).alias("clause_no"), "evidence", F.when(F.size(listed) > 0, listed).alias("targets"),
        F.when(own != "", own).when(~late.rlike(r"(?i)^\d+\s*-\s*modda(?:ning)?$"), late).otherwise("").alias("locator"), verb(g(8)).alias("change_type"),
        iso(g(2), g(3), g(4)).alias("amend_date"), number.alias("act_number"), dates.alias("dates"),
    )
    read = read.withColumn("effective_date", F.try_element_at(F.filter("dates", lambda x: x != F.col("amend_date")), F.lit(1)))
    return read.select("row_id", "doc_id", "host_article", "clause_no", F.explode_outer(F.col("targets").cast("array<string>")).alias("target_article"), "locator", "change_type", "amend_date", "act_number", "effective_date", "evidence")


def article_currency(events: DataFrame) -> DataFrame:
    """(doc_id, article, n_events, last_date, last_type, any_voided) over events with event_id; ties of date go to the smaller id."""
    own = events.withColumn("article", F.coalesce("target_article", "host_article"))
    return own.groupBy("doc_id", "article").agg(
        F.count("*").alias("n_events"), F.max("amend_date").alias("last_date"), F.max_by("change_type", F.struct("amend_date", -F.col("event_id"))).alias("last_type"), F.bool_or(F.col("change_type") == "voided").alias("any_voided")
    )


def locator_status(events: DataFrame) -> DataFrame:
    """events with is_stale: a removal or voiding of a place that a later event has touched again."""
    own = events.withColumn("_place", F.coalesce(F.lower(F.trim("locator")), F.lit("")))
    out = latest(own, ["doc_id", "host_article", "_place"], ["amend_date", "event_id"], F.col("change_type"), "_last")
    gone = F.col("change_type").isin("removed", "voided")
    return out.withColumn("is_stale", gone & ~F.col("_last").isin("removed", "voided")).drop("_place", "_last")


def act_currency(acts: DataFrame, clauses: DataFrame) -> DataFrame:
    """acts (doc_id) with status and repealed_by: superseded by the whole-act repeal whose date, as written, is first; ties to the smaller clause_id."""
    whole = top1(clauses.where("locator IS NULL AND dst_doc_id IS NOT NULL"), ["dst_doc_id"], ["cited_date", "clause_id"]).select(F.col("dst_doc_id").alias("doc_id"), F.col("src_doc_id").alias("repealed_by"))
    return acts.join(whole, "doc_id", "left").withColumn("status", F.when(F.col("repealed_by").isNotNull(), "superseded").otherwise("in-force"))


def partial_repeals(clauses: DataFrame) -> DataFrame:
    """(doc_id, n_partial, locators, last_by) of acts of which parts are repealed."""
    part = clauses.where("locator IS NOT NULL AND dst_doc_id IS NOT NULL").groupBy(F.col("dst_doc_id").alias("doc_id"))
    return part.agg(F.count("*").alias("n_partial"), F.array_join(F.array_sort(F.collect_set("locator")), ", ").alias("locators"), F.max_by("src_doc_id", F.struct("cited_date", "clause_id")).alias("last_by"))


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, block_no, block): a text cut before each "N-modda." marker; one block without any."""
    return docs.select(key, F.posexplode(F.split(text, r"(?<=\s|^)(?=\d+-modda\. )")).alias("block_no", "block")).where("block <> ''")


def sequence_numbers(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """rows with event_id: dense numbers in order, within the key."""
    return rows.withColumn("event_id", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def ordinal(word: Column) -> Column:
    """The number that an ordinal word stands for, whatever its apostrophe and case; null for other words."""
    place = F.array_position(F.array(*map(F.lit, ORDINALS)), F.translate(F.lower(word), "ʼ'", "ʻʻ"))
    return F.when(place > 0, place.cast("int"))


def unit_number(text: Column) -> Column:
    """The number of a part or item, written in digits or as an ordinal word."""
    own = F.regexp_replace(F.trim(text), r"\.+$", "")
    return F.coalesce(F.nullif(F.regexp_extract(own, UNIT_DIGITS, 1), F.lit("")).try_cast("int"), ordinal(F.regexp_extract(own, UNIT_WORD, 1)))


def void_citations(edges: DataFrame, events: DataFrame) -> DataFrame:
    """(edge_id, amend_event_id): edges (edge_id, dst_doc_id, dst_article_number, dst_qism) to a sub-unit that is removed or voided, and not since touched again.

    events: as locator_status() takes them. Document, article and ordinal agree; of several events the last. Edges meet
    the units of their document's article first, so that only those that have any are read.
    """
    gone = locator_status(events).where(F.col("change_type").isin("removed", "voided") & ~F.col("is_stale"))
    part = lambda g: F.regexp_extract(F.trim("locator"), UNIT_LOCATOR, g)
    units = gone.select(F.col("doc_id").alias("dst_doc_id"), part(1).alias("dst_article_number"), ordinal(part(2)).alias("_unit"), "event_id").where("_unit IS NOT NULL")
    last = units.groupBy("dst_doc_id", "dst_article_number", "_unit").agg(F.max("event_id").alias("_event"))
    places = last.groupBy("dst_doc_id", "dst_article_number").agg(F.map_from_entries(F.collect_list(F.struct("_unit", "_event"))).alias("_units"))
    met = edges.where("dst_qism IS NOT NULL").join(places, ["dst_doc_id", "dst_article_number"])
    return met.select("edge_id", F.try_element_at("_units", unit_number(F.col("dst_qism"))).alias("amend_event_id")).where("amend_event_id IS NOT NULL")


def footnote_acts(texts: DataFrame, text: str) -> DataFrame:
    """(norm_id, act_number): the acts that the footnotes of a translated text (norm_id, text) name."""
    notes = F.flatten(F.transform(F.regexp_extract_all(F.col(text), F.lit(FOOTNOTE), F.lit(1)), lambda x: F.regexp_extract_all(x, F.lit(FOOTNOTE_ACT), F.lit(1))))
    return texts.select("norm_id", F.explode(notes.cast("array<bigint>")).alias("act_number")).distinct()


def translation_staleness(footnotes: DataFrame, amendments: DataFrame) -> DataFrame:
    """(norm_id, en_latest, uz_latest, types, stale) of norms that both know: the latest act by number, what it did, and whether the translation lags.

    footnotes: norm_id, act_number; amendments: norm_id, act_number (the digits at its end count), change_type.
    """
    en = footnotes.groupBy("norm_id").agg(F.max("act_number").alias("en_latest"))
    n = F.regexp_extract(F.col("act_number").cast("string"), r"(\d+)$", 1).try_cast("long").alias("n")
    by = amendments.select("norm_id", n, "change_type").where("n IS NOT NULL").groupBy("norm_id", "n").agg(F.array_join(F.array_sort(F.collect_set("change_type")), ",").alias("types"))
    uz = by.groupBy("norm_id").agg(F.max("n").alias("uz_latest"), F.max_by("types", "n").alias("types"))
    return en.join(uz, "norm_id").select("norm_id", "en_latest", "uz_latest", "types", (F.col("en_latest") < F.col("uz_latest")).alias("stale"))


def mentions(rows: DataFrame, pattern: str, around: int = 110) -> DataFrame:
    """(doc_id, n_hits, evidence): how many rows (doc_id, row_id, text) of a document match, and the surroundings of the first match of its first such row."""
    hit = rows.where(F.col("text").rlike(pattern)).withColumn("m", F.regexp_extract("text", pattern, 0))
    at = F.call_function("locate", F.col("m"), F.col("text"))
    begin = F.greatest(at - around, F.lit(1))
    shown = collapse(F.substr("text", begin, at + F.length("m") + around - begin))
    return hit.select("doc_id", F.struct("row_id", shown.alias("evidence")).alias("s")).groupBy("doc_id").agg(F.count("*").alias("n_hits"), F.min("s").alias("s")).select("doc_id", "n_hits", "s.evidence")
