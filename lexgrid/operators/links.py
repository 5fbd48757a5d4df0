"""From citations to edges of the reference graph."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .citations import target_doc

#: Base confidence by (field, target kind), and the caps (normative field, other field).
BASE = {
    ("article_text", "article"): 0.95, ("article_text", "section"): 0.9, ("article_text", "chapter"): 0.9, ("article_text", "part"): 0.85, ("article_text", "act"): 0.8,
    ("amendment_note", "article"): 0.75, ("amendment_note", "section"): 0.7, ("amendment_note", "chapter"): 0.7, ("amendment_note", "part"): 0.65, ("amendment_note", "act"): 0.6,
    ("cross_references", "article"): 0.85, ("cross_references", "section"): 0.8, ("cross_references", "chapter"): 0.8, ("cross_references", "part"): 0.75, ("cross_references", "act"): 0.7,
}
AMBIGUOUS, DANGLING, ALIAS = (0.85, 0.60), (0.88, 0.70), 0.95
APPARATUS = r"(Oldingi tahrirga qarang\.?|LexUZ sharhi|Batafsil maʼlumot uchun|Qarang:|Мазкур|\(Qarang:.*?\))"
apparatus = re.compile(APPARATUS, re.IGNORECASE)


def clean(text: str) -> str:
    return clean_span(text, 0, 0)[0]


def clean_span(text: str, start: int, end: int) -> tuple[str, int | None, int | None]:
    """Text without editorial apparatus and with single spaces, and where [start, end) lies in it; None where the span isn't the same text any more.

    Each character that stays remembers its place; a span is found again by its first and last character.
    """
    kept: list[tuple[str, int]] = []
    gone = [m.span() for m in apparatus.finditer(text)]
    at = 0
    for i, c in enumerate(text):
        while at < len(gone) and i >= gone[at][1]:
            at += 1
        if c.isspace() or at < len(gone) and gone[at][0] <= i:
            if kept and kept[-1][0] != " ":
                kept.append((" ", i))
        else:
            kept.append((c, i))
    low, high = 0, len(kept)
    while low < high and kept[low][0] in " .;,":
        low += 1
    while high > low and kept[high - 1][0] in " .;,":
        high -= 1
    kept = kept[low:high]
    out = "".join(c for c, _ in kept)
    inside = [k for k, (_, i) in enumerate(kept) if start <= i < end]
    if not inside or out[inside[0] : inside[-1] + 1].strip() != " ".join(text[start:end].split()):
        return out, None, None
    return out, inside[0], inside[-1] + 1


def edges(found: DataFrame, rows: DataFrame, norms: DataFrame, structure: DataFrame) -> DataFrame:
    """The resolved citations, with relation and confidence.

    found: citations() of rows (row_id, doc_id, tier, is_the_code); norms: (norm_id, doc_id, article_number, occurrence);
    structure: (node_id). An article that its document lacks dangles; of a repeated number the first is taken and marked.
    A section falls back to its chapter. What has no target, not even the act, is dropped.
    """
    w = Window.partitionBy("doc_id", "article_number")
    first = norms.withColumns({"_n": F.count("*").over(w), "_k": F.row_number().over(w.orderBy("occurrence"))}).where("_k = 1").select(
        F.col("doc_id").alias("dst_doc_id"), F.col("article_number").alias("article"), F.col("norm_id").alias("dst_norm_id"), (F.col("_n") > 1).alias("dst_ambiguous")
    )
    known = structure.select(F.col("node_id").alias("dst_struct_node_id"), F.lit(True).alias("_there"))
    chapter = F.concat(F.lit("C"), F.col("struct_number"))
    node = F.when(F.col("target_kind") == "section", F.concat(chapter, F.lit(".S"), F.col("section_number"))).when(F.col("target_kind") == "chapter", chapter)
    both = found.join(rows, "row_id").withColumn("dst_doc_id", F.when(F.col("target_kind") == "article", target_doc(F.col("article"))))
    both = both.join(first, ["dst_doc_id", "article"], "left").withColumn("dst_struct_node_id", node).join(known, "dst_struct_node_id", "left")
    back = structure.select(F.col("node_id").alias("_chapter"), F.lit(True).alias("_chapter_there"))
    both = both.withColumn("_chapter", chapter).join(back, "_chapter", "left")
    both = both.withColumn("dst_struct_node_id", F.when(F.col("_there"), F.col("dst_struct_node_id")).when(F.col("_chapter_there") & F.col("target_kind").isin("section", "chapter"), F.col("_chapter")))
    article = F.col("target_kind") == "article"
    both = both.withColumns({"dst_ambiguous": F.coalesce("dst_ambiguous", F.lit(False)), "dst_dangling": article & F.col("dst_doc_id").isNotNull() & F.col("dst_norm_id").isNull()})
    both = both.where((article & F.col("dst_doc_id").isNotNull()) | F.col("target_kind").isin("act", "part") | F.col("dst_struct_node_id").isNotNull())
    own, high = F.col("is_the_code"), F.col("tier")
    relation = F.when(own, F.array(F.lit("internal"), F.lit("self"))).when(high == 9, F.array(F.lit("cites"), F.lit("unknown"))).when(high > 2, F.array(F.lit("realizes"), F.lit("below"))).when(high == 2, F.array(F.lit("cites"), F.lit("same"))).otherwise(F.array(F.lit("cites"), F.lit("above")))
    cells = F.create_map(*[F.lit(x) for (f, k), v in BASE.items() for x in (f"{f}/{k}", v)])
    normative = F.col("source_field") == "article_text"
    cap = lambda c, pair: F.when(c, F.when(normative, pair[0]).otherwise(pair[1])).otherwise(1.0)
    base = F.coalesce(F.element_at(cells, F.concat_ws("/", "source_field", "target_kind")), F.lit(0.5)) * F.when(F.col("anchor") == "fk_alias", ALIAS).otherwise(1.0)
    confidence = F.round(F.least(base, cap(F.col("dst_ambiguous"), AMBIGUOUS), cap(F.col("dst_dangling"), DANGLING)), 3)
    out = both.withColumns({"relation": relation[0], "hierarchy_rel": relation[1], "confidence": confidence, "method": F.concat(F.lit("explicit_citation_uz/"), "anchor")})
    return out.drop("_there", "_chapter", "_chapter_there")
