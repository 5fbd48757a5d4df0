"""The verifier: assertions over the derived tables, as rows (area, check, ok, detail). detail counts what is wrong.

Every area is a function of the tables that it reads, so that one can be run alone; report() joins them. Tables and columns bear
the names of the derived data model: norm_unit, struct_node, link_edge, corpus_row, src_provision, act, repeal_clause,
article_amendment, okoz_node, okoz_assignment, llc_stage, llc_norm and the transfer report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import breadth_problems
from .quality import none, refers, unique
from .structure import range_problems

#: Apparatus that shown evidence must not hold, kinds of evidence by field, how a gazette's record is written, the sphere of civil law.
APPARATUS = ("Oldingi tahrirga qarang", "LexUZ sharhi")
KINDS = {"article_text": "normative", "cross_references": "editorial", "amendment_note": "amendment"}
RECORD = r"(?iU)\([^()]*(?:axborotnomasi|vedomosti|to[ʻ']?plam|№)[^()]*\)"
GAZETTE = r"(?s)^(?=.*axborotnomasi, [0-9]{4}-yil)(?=.*№)"
SPHERE = "03."


def differ(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


def equal_counts(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Two one-number frames (n) agree; detail is how far apart they are."""
    both = a.select(F.col("n").alias("a")).join(b.select(F.col("n").alias("b")))
    return both.select(F.lit(name).alias("check"), (F.col("a") == F.col("b")).alias("ok"), F.abs(F.col("a") - F.col("b")).cast("long").alias("detail"))


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def empty(text: str) -> Column:
    return F.trim(F.coalesce(F.col(text), F.lit(""))) == ""


def same_set(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Both hold the same keys; detail counts those that one lacks."""
    sides = a.select(key).distinct().withColumn("_s", F.lit(1)).unionByName(b.select(key).distinct().withColumn("_s", F.lit(1)))
    return none(sides.groupBy(key).agg(F.count("*").alias("_n")).where("_n = 1"), name)


def transfer(norm: DataFrame, reported: DataFrame, articles: DataFrame) -> list[DataFrame]:
    """Landed and reported rows add up, on either side. reported: kind; articles: one row each of the source."""
    landed = norm.where("article_text_en IS NOT NULL")
    kinds = lambda *k: reported.where(F.col("kind").isin(*k)).select(F.lit(1).alias("x"))
    one = landed.select(F.lit(1).alias("x"))
    return [
        equal_counts(count(one.union(kinds("md_only", "md_only_occurrence"))), count(articles), "source articles landed or reported"),
        equal_counts(count(one.union(kinds("db_only", "db_only_occurrence"))), count(norm), "norms translated or reported"),
        none(landed.where(empty("article_text_en")), "no landed text is empty"), unique(norm, ["norm_id"], "norm_id is unique"),
        none(landed.where("en_align_status IS NULL"), "landed texts have a status"),
    ]


def slices(norm: DataFrame, lines: DataFrame) -> list[DataFrame]:
    """Each landed text is its lines of the source again. lines: line_no, line. Lines meet texts by number, not by range."""
    landed = norm.where("article_text_en IS NOT NULL AND en_line_start IS NOT NULL").select("norm_id", "article_text_en", F.explode(F.sequence("en_line_start", "en_line_end")).alias("line_no"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    cut = landed.join(lines, "line_no", "left").groupBy("norm_id").agg(F.any_value("article_text_en").alias("t"), F.trim(body).alias("again"), F.count_if(F.col("line").isNull()).alias("gone"))
    return [none(cut.where(differ(F.trim("t"), F.col("again"))), "landed texts equal their source lines"), none(cut.where("gone > 0"), "source lines exist"), none(landed.where("line_no < 1"), "line numbers begin at 1")]


def raw_layer(raw: DataFrame, norm: DataFrame, rows: int, columns: int) -> list[DataFrame]:
    """The source table is as it was, and what was derived from it is the same. raw: src_row, article_number, article_title, article_text."""
    both = raw.join(norm.select("src_row", F.col("article_number").alias("_n"), "article_title_uz", "article_text_uz"), "src_row")
    off = differ(F.col("article_number"), F.col("_n")) | differ(F.col("article_title"), F.col("article_title_uz")) | differ(F.col("article_text"), F.col("article_text_uz"))
    width = count(raw.limit(0)).select(F.lit(abs(len(raw.columns) - columns)).cast("long").alias("n"))
    return [
        equal_counts(count(raw), count(raw.limit(0)).select(F.lit(rows).alias("n")), "row count unchanged"), width.select(F.lit("column count unchanged").alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").alias("detail")),
        none(both.where(off), "derived texts equal the source"),
    ]


def tree(nodes: DataFrame, norm: DataFrame, superscripts: DataFrame, crumbs: DataFrame) -> list[DataFrame]:
    """nodes: also doc_id and n_units; superscripts: article_number, as the source has them; crumbs: node_id, breadcrumb."""
    placed = norm.join(nodes.select(F.col("node_id").alias("struct_node_id"), "art_from", "art_to"), "struct_node_id")
    told = norm.join(crumbs.select(F.col("node_id").alias("struct_node_id"), "breadcrumb"), "struct_node_id", "left")
    return [
        none(range_problems(nodes), "ranges are contiguous"), none(norm.where("struct_node_id IS NULL"), "norms are attached"), none(placed.where("article_base NOT BETWEEN art_from AND art_to"), "bases lie in their node's range"),
        equal_counts(nodes.agg(F.coalesce(F.sum("n_units"), F.lit(0)).alias("n")), count(norm), "unit counts add up"), same_set(norm.where("superscript IS NOT NULL"), superscripts, "article_number", "superscripts agree with the source"),
        none(told.where("breadcrumb IS NULL"), "norms have a breadcrumb"),
    ]


def edges(edge: DataFrame, norm: DataFrame, rows: DataFrame, doc: int) -> list[DataFrame]:
    """The reference graph resolves. doc: the document whose norms are known."""
    mined = edge.where((F.col("dst_kind") == "article") & F.lower("evidence").rlike(GAZETTE))
    bare = F.regexp_replace("evidence", RECORD, " ")
    named = F.exists(F.regexp_extract_all(bare, F.lit(r"(?iU)\b(\d+)\s*-?\s*modda"), F.lit(1)), lambda x: x == F.col("dst_article_number"))
    return [
        none(edge.where(empty("evidence")), "edges have evidence"),
        none(edge.where((F.col("dst_kind") == "article") & (F.col("dst_doc_id") == doc) & F.col("dst_norm_id").isNull() & ~F.col("dst_dangling")), "articles resolve or dangle"),
        refers(edge, "dst_norm_id", norm, "norm_id", "edges point at norms"), refers(edge, "src_row_id", rows, "row_id", "citing rows exist"),
        none(edge.where("hierarchy_rel = 'below' AND src_tier <= 2"), "nothing at the Code's tier realizes it"), none(mined.where(~named), "no edge from a gazette's record"),
    ]


def classifier(nodes: DataFrame, parsed: DataFrame, assigned: DataFrame, struct: DataFrame, norm: DataFrame, placed: DataFrame) -> list[DataFrame]:
    """nodes, parsed: code, parent_code, label_en; assigned: okoz_code, struct_node_id; placed: norm_id, breadcrumb (what each norm inherits)."""
    as_tree = parsed.select(F.col("code").alias("node_id"), F.col("parent_code").alias("parent_id"), F.col("label_en").alias("label"))
    lost = assigned.join(nodes.select(F.col("code").alias("okoz_code"), F.lit(1).alias("_k")).distinct(), "okoz_code", "left")
    lost = lost.join(struct.select(F.col("node_id").alias("struct_node_id"), F.lit(1).alias("_s")).distinct(), "struct_node_id", "left").where("_k IS NULL OR _s IS NULL")
    return [
        none(breadth_problems(as_tree), "the classifier parses"), equal_counts(count(nodes), count(parsed), "classifier rows match its source"), refers(nodes, "parent_code", nodes, "code", "parents exist"),
        none(lost, "assignments resolve"), none(norm.join(placed.select("norm_id").distinct(), "norm_id", "left_anti"), "all norms are classified"), none(placed.where("breadcrumb IS NULL"), "classes have a breadcrumb"),
        none(assigned.where(~F.col("okoz_code").startswith(SPHERE)), "assignments stay in their sphere"),
    ]


def provenance(edge: DataFrame, provision: DataFrame) -> list[DataFrame]:
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    shown = F.lower("evidence_clean")
    span = F.col("ev_clean_start").isNotNull() & ~F.coalesce((F.col("ev_clean_start") >= 0) & (F.col("ev_clean_start") < F.col("ev_clean_end")) & (F.col("ev_clean_end") <= F.length("evidence_clean")), F.lit(False))
    by = edge.groupBy("dst_kind").agg(F.min(F.when(F.col("evidence_kind") == "normative", F.col("confidence"))).alias("low"), F.max(F.when(F.col("evidence_kind") == "editorial", F.col("confidence"))).alias("high"))
    return [
        none(edge.where(~F.col("evidence_kind").isin(*KINDS.values())), "evidence kinds are known"), none(edge.where(F.element_at(kind, F.col("source_field")) != F.col("evidence_kind")), "evidence kinds agree with fields"),
        none(by.where("low < high"), "own words outrank pointers"), none(edge.where(F.col("evidence_clean").isNull() | shown.contains(APPARATUS[0].lower()) | shown.contains(APPARATUS[1].lower())), "shown evidence is clean"),
        none(edge.where(span), "spans are valid"), refers(edge, "src_row_id", provision, "row_id", "provisions are stored"), none(provision.where(empty("article_text")), "no stored provision is empty"),
    ]


def currency(clause: DataFrame, act: DataFrame, event: DataFrame) -> list[DataFrame]:
    dates = lambda key, name: act.select(F.col("doc_id").alias(key), F.col("doc_date").alias(name))
    both = clause.join(dates("src_doc_id", "_s"), "src_doc_id").join(dates("dst_doc_id", "_d"), "dst_doc_id")
    article = F.coalesce("target_article_number", "host_article_number").alias("article_number")
    return [
        refers(clause, "dst_doc_id", act, "doc_id", "repeals point at acts"), none(both.where("_d > _s"), "nothing repeals what came after it"),
        none(event.groupBy("doc_id", article).agg(F.countDistinct("norm_id").alias("n")).where("n > 1"), "no article number joins two norms"),
    ]


def slice_of_law(stage: DataFrame, item: DataFrame, norm: DataFrame, status: DataFrame, stages: int, law: int, former: int) -> list[DataFrame]:
    """A law's stages and norms. status: doc_id, derived_status; law: the document in force; former: the one it repealed."""
    base = item.where("layer = 'foundation'")
    gone = status.where((F.col("doc_id") == former) & (F.col("derived_status") == "superseded"))
    one = count(stage.limit(0))
    return [
        equal_counts(count(stage), one.select(F.lit(stages).alias("n")), "the law has its stages"), none(base.join(norm.select(F.col("norm_id").alias("cc_norm_id")), "cc_norm_id", "left_anti"), "foundations resolve"),
        none(base.where(empty("rationale")), "foundations give reasons"), none(stage.join(item.where("layer = 'special'"), "stage_no", "left_anti"), "stages have articles"),
        none(item.where((F.col("layer") == "special") & (F.col("doc_id") != law)), "stages are of the law in force"), equal_counts(count(gone.select("doc_id").distinct()), one.select(F.lit(1).alias("n")), "the former law is superseded"),
    ]


def report(areas: dict[str, list[DataFrame]]) -> DataFrame:
    """(area, check, ok, detail) of all areas."""
    return reduce(DataFrame.unionByName, [c.select(F.lit(area).alias("area"), "check", "ok", "detail") for area, checks in areas.items() for c in checks])
