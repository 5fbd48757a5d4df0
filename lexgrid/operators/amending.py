"""Which act made an amendment, and which norm it changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .citations import GENERAL

# --- Fixed values: how acts name the Code, its abbreviation and their own articles. ---
CODE = r"(?iU)fuqarolik kodeks"
DEFINES_ALIAS = "bundan buyon matnda FK deb"
OWN_ARTICLE = r"(?U)(?<![-\d])(?=\d{1,3}\s*-\s*modda\.\s)"
NAMED_ARTICLE = r"(?iU)\b(\d+)\s*-\s*modda"
# --- End of the fixed values. ---


def alias_acts(provisions: DataFrame, text: str = "article_text") -> DataFrame:
    """(doc_id) of the acts that define the Code's abbreviation; only there it is an anchor."""
    return provisions.where(F.col(text).contains(DEFINES_ALIAS)).select("doc_id").distinct()


def with_alias(provisions: DataFrame, text: str = "article_text") -> DataFrame:
    """provisions with allow_fk_alias, as citations() expects it."""
    known = alias_acts(provisions, text).withColumn("_known", F.lit(True))
    return provisions.join(known, "doc_id", "left").withColumn("allow_fk_alias", F.coalesce("_known", F.lit(False))).drop("_known")


def sole(candidates: DataFrame, key: list[str], name: str) -> DataFrame:
    """(*key, name): the doc_id of each key that has only one."""
    return candidates.groupBy(*key).agg(F.min("doc_id").alias(name), F.max("doc_id").alias("_last")).where(F.col(name) == F.col("_last")).drop("_last")


def amending_acts(events: DataFrame, acts: DataFrame, bodies: DataFrame) -> DataFrame:
    """events with amending_doc_id and match_method.

    events: amend_date, probe_article (the first target, else the host) and any other columns; acts: doc_id, doc_date,
    doc_type, title; bodies: doc_id, body. Of the acts of the event's date: the only one whose title names the Code; else the
    only one with a block (cut at its own article markers) that names the Code and the article; else the only law whose
    text names the Code. Each step is a grouped frame of candidates met by an equi-join, never events against acts.
    """
    dated = acts.where("doc_date IS NOT NULL").select("doc_id", F.col("doc_date").alias("amend_date"), "doc_type", "title")
    titled = sole(dated.where(F.col("title").rlike(CODE)), ["amend_date"], "_title")
    texts = dated.select("doc_id", "amend_date", "doc_type").join(bodies.where(F.col("body").rlike(CODE)), "doc_id")
    blocks = texts.select("doc_id", "amend_date", F.explode(F.split("body", OWN_ARTICLE)).alias("block")).where(F.col("block").rlike(CODE))
    named = blocks.select("doc_id", "amend_date", F.explode(F.regexp_extract_all("block", F.lit(NAMED_ARTICLE), F.lit(1))).alias("probe_article"))
    blocked = sole(named, ["amend_date", "probe_article"], "_block")
    law = sole(texts.where("doc_type = 'law'"), ["amend_date"], "_law")
    out = events.join(titled, "amend_date", "left").join(blocked, ["amend_date", "probe_article"], "left").join(law, "amend_date", "left")
    method = F.when(F.col("_title").isNotNull(), "date+civil-code-title").when(F.col("_block").isNotNull(), "date+cc-clause-match").when(F.col("_law").isNotNull(), "date+sole-law-cc-mention")
    return out.withColumns({"amending_doc_id": F.coalesce("_title", "_block", "_law"), "match_method": method.otherwise("unresolved")}).drop("_title", "_block", "_law")


def amended_norms(events: DataFrame, norms: DataFrame, doc: int = GENERAL) -> DataFrame:
    """events (row_id, doc_id, host_article, target_article, any others) with norm_id.

    norms: norm_id, doc_id, src_row, article_number. Events of other documents than `doc` have none. One that names its host, or
    nothing, is the norm of its own row, whatever else bears that number; another is the norm of that number, of several
    the one with the last row.
    """
    own = norms.where(F.col("doc_id") == doc)
    by_row = own.groupBy(F.col("src_row").alias("row_id")).agg(F.max("norm_id").alias("_row"))
    by_number = own.groupBy(F.col("article_number").alias("target_article")).agg(F.max_by("norm_id", "src_row").alias("_number"))
    itself = F.coalesce(F.col("target_article"), F.col("host_article")).eqNullSafe(F.col("host_article"))
    out = events.join(by_row, "row_id", "left").join(by_number, "target_article", "left")
    return out.withColumn("norm_id", F.when(F.col("doc_id") == doc, F.when(itself, F.col("_row")).otherwise(F.col("_number")))).drop("_row", "_number")


def bodies(provisions: DataFrame) -> DataFrame:
    """(doc_id, body): each document's rows (doc_id, row_id, article_text) in order, as one text."""
    rows = F.sort_array(F.collect_list(F.struct("row_id", "article_text")))
    return provisions.where("article_text IS NOT NULL").groupBy("doc_id").agg(F.array_join(F.transform(rows, lambda x: x["article_text"]), " ").alias("body"))
