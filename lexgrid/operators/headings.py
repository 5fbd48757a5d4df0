"""Headed documents: lines to sections and articles, by windows over line numbers instead of a state machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .windows import carry


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 1, line)."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def markdown_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no from 1, line) of a text file, each line from its place in the whole file."""
    return lines(spark.read.text(path, wholetext=True).select(F.lit(path).alias("path"), "value"), "path", "value").select("line_no", "line")


def parts_of(rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """rows (key, line_no, line) with part: front (between a first line of three hyphens and the next such line), and body.

    Several documents are told apart by `key`; each is one window.
    """
    w = Window.partitionBy(*(key or [F.lit(0)])).orderBy("line_no")
    fence = F.trim("line") == "---"
    opens = F.max((fence & (F.col("line_no") == 1)).cast("int")).over(w)
    closed = F.sum(((fence & (F.col("line_no") > 1)).cast("int"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("part", F.when((opens == 1) & (F.coalesce(closed, F.lit(0)) == 0), "front").otherwise("body"))


def body(rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The lines after a document's front matter, under their own numbers."""
    return parts_of(rows, key).where("part = 'body'").drop("part")


def sections(rows: DataFrame, key: str, heading: Column) -> DataFrame:
    """(key, section_no, heading, first_line, last_line, n_lines, n_chars): a section runs from its heading to the line before the next.

    Lines before the first heading are section 0.
    """
    w = Window.partitionBy(key).orderBy("line_no")
    flagged = rows.withColumn("_h", F.coalesce(heading, F.lit(False)).cast("int")).withColumn("section_no", F.sum("_h").over(w))
    out = flagged.groupBy(key, "section_no").agg(
        F.min_by("line", "line_no").alias("heading"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars")
    )
    return out.withColumn("heading", F.when(F.col("section_no") > 0, F.col("heading")))


#: Numbers of articles whose heading says "Section" or bears a section mark, and what headings look like.
AS_SECTION, AS_MARK = (144, 255, 273, 302, 304, 305, 320, 349), (268, 309)
SUPERSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"
HEADING = r"(?i)^(?:#{1,3}\s+)?\*\*\s*(Article|Section|§)\s+(\d+)([⁰¹²³⁴⁵⁶⁷⁸⁹]*)\s*\.?(.*)$"


def articles(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(*by, ordinal, number, superscript, key, title, start_line, end_line, body, repealed) of codes' markdown lines (*by, line_no, line).

    A bold "Article n" line opens an article, and so do "Section n" and "§ n" for the known numbers that are written so;
    whatever stands between two headings is the body, and a body that tells of lost force is repealed. Documents are told
    apart by the columns `by`; each is one window.
    """
    word, n = F.lower(F.regexp_extract("line", HEADING, 1)), F.regexp_extract("line", HEADING, 2)
    own = (word == "article") | ((word == "section") & n.isin(*map(str, AS_SECTION))) | ((word == "§") & n.isin(*map(str, AS_MARK)))
    head = rows.withColumns({
        "_n": n, "_is": own, "_s": F.translate(F.regexp_extract("line", HEADING, 3), SUPERSCRIPTS, DIGITS),
        "_t": F.btrim(F.regexp_replace(F.regexp_extract("line", HEADING, 4), r"\*+", ""), F.lit(" .")),
    })
    by = by or []
    one = by or ["_d"]
    numbered = carry(head.withColumn("_d", F.lit(0)), one, ["line_no"], _start=F.when(F.col("_is"), F.col("line_no"))).where("_start IS NOT NULL")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("_is"), F.struct("line_no", "line")))), lambda x: x["line"]), "\n")
    out = numbered.groupBy(*one, "_start").agg(*[F.max(F.when(F.col("_is"), F.col(c))).alias(c) for c in ("_n", "_s", "_t")], F.max("line_no").alias("end_line"), body.alias("body"))
    return out.select(
        *by, F.row_number().over(Window.partitionBy(*one).orderBy("_start")).alias("ordinal"), F.col("_n").cast("int").alias("number"), F.nullif("_s", F.lit("")).alias("superscript"), F.concat("_n", "_s").alias("key"),
        F.trim("_t").alias("title"), F.col("_start").alias("start_line"), "end_line", F.trim("body").alias("body"), F.lower("body").contains("lost force").alias("repealed"),
    )


def structure(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(*by, line_no, kind, number, label, art_from, art_to, part, subsection, chapter): the outlines' nodes and what they stand under; documents are told apart by the columns `by`."""
    rules = {
        "part": r"^\*\*Part ([IVX]+)\. (.*?)\*\*", "document": r"^\*\*Part (Two)()\*\*", "subsection": r"^\*\*Subsection (\d+)\. (.*?)\*\*",
        "chapter": r"^\*\*Chapter (\d+)\.\*\* (.*?)\s*(?:\(Articles? |$)", "section": r"^§ ?(\d+)\. (.*?)\s*(?:\(Articles? |$)",
    }
    kind = F
    for name, rule in rules.items():
        kind = kind.when(F.trim("line").rlike(rule), name)
    named = rows.withColumn("kind", kind.otherwise(None)).where("kind IS NOT NULL")
    pick = lambda g: F.coalesce(*[F.when(F.col("kind") == k, F.regexp_extract(F.trim("line"), r, g)) for k, r in rules.items()])
    span = r"\(Articles? (\d+)(?:\s*[–—-]\s*(\d+)(?:-\d+)?)?\)"
    a, b = (F.nullif(F.regexp_extract("line", span, g), F.lit("")).cast("int") for g in (1, 2))
    out = named.withColumns({"number": pick(1), "label": pick(2), "art_from": a, "art_to": F.coalesce(b, a), "_d": F.lit(0)})
    up = {k: F.when(F.col("kind") == k, F.struct("line_no", "number")) for k in ("part", "subsection", "chapter")}
    above = carry(out, by or ["_d"], ["line_no"], **up)
    under = lambda k, *of: F.when(F.greatest(F.lit(0), F.lit(0), *[F.coalesce(F.col(o)["line_no"], F.lit(0)) for o in of]) < F.col(k)["line_no"], F.col(k)["number"])
    return above.select(
        *(by or []), "line_no", "kind", "number", "label", "art_from", "art_to", under("part").alias("part"), under("subsection", "part").alias("subsection"), under("chapter", "part", "subsection").alias("chapter")
    )


def classifier(rows: DataFrame) -> DataFrame:
    """(line_no, code, level, parent_code, label, see_also): a dotted classifier; level and parent come from the code alone, whose fourth pair may be left out."""
    rule = r"^[^0-9]*?(\d{2}\.\d{2}\.\d{2})(?:\.(\d{2}))?\.?(?!\d)\s*[-–—:*]*\s*(.*)$"
    last = F.regexp_extract("line", rule, 2)
    found = rows.where(F.col("line").rlike(rule)).withColumn("code", F.concat_ws(".", F.regexp_extract("line", rule, 1), F.when(last == "", "00").otherwise(last)))
    parts = F.split("code", r"\.")
    level = F.when(F.element_at(parts, 4) != "00", 4).when(F.element_at(parts, 3) != "00", 3).when(F.element_at(parts, 2) != "00", 2).otherwise(1)
    found = found.withColumns({"level": level, "_rest": F.regexp_extract("line", rule, 3)})
    parent = F.when(F.col("level") == 4, F.concat(F.substring("code", 1, 8), F.lit(".00"))).when(F.col("level") == 3, F.concat(F.substring("code", 1, 5), F.lit(".00.00"))).when(F.col("level") == 2, F.concat(F.substring("code", 1, 2), F.lit(".00.00.00")))
    see = F.regexp_extract_all("_rest", F.lit(r"(\d{2}\.\d{2}\.\d{2}\.\d{2})"), F.lit(1))
    return found.select("line_no", "code", "level", parent.alias("parent_code"), F.trim(F.regexp_replace(F.regexp_replace("_rest", r"(?i)\(?see also.*$", ""), r"\*+", "")).alias("label"), see.alias("see_also"))
