"""Queries over who amended what, and which acts define the Code's abbreviation, on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import amending as A
from ..operators import events as E
from ..operators.citations import GENERAL, citations
from ..sources.tables import dealt, table
from .catalog import query

ACTS = """acts AS (SELECT c_custkey AS doc_id, CAST('2001-01-01' AS DATE) + CAST(c_custkey % 700 AS INT) AS doc_date, CASE WHEN c_custkey % 3 = 0 THEN 'law' ELSE 'decree' END AS doc_type, c_custkey % 10 = 1 AS titled,
 c_custkey % 4 = 0 AS names, c_custkey % 300 AS art FROM customer)"""


def _acts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Acts of 700 days, and their bodies of three articles of their own: the second may name the Code and one of its articles."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer")
    acts = c.select(k.alias("doc_id"), F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (k % 700).cast("int")), "yyyy-MM-dd").alias("doc_date"), F.when(k % 3 == 0, "law").otherwise("decree").alias("doc_type"), F.when(k % 10 == 1, "Fuqarolik kodeksiga oʻzgartirishlar kiritish toʻgʻrisida").otherwise("Boshqa akt").alias("title"))
    body = F.concat(F.lit("1-modda. Umumiy "), k, F.lit(" 2-modda. "), F.when(k % 4 == 0, "Fuqarolik kodeksining ").otherwise("Boshqa qonunning "), k % 300, F.lit("-moddasi oʻzgartirilsin 3-modda. Kuchga kirish 900-modda haqida"))
    return acts, c.select(k.alias("doc_id"), body.alias("body"))


@query(f"""
WITH {ACTS}, e AS (SELECT o_orderkey AS event_id, strftime(CAST('2001-01-01' AS DATE) + CAST(o_custkey % 720 AS INT), '%Y-%m-%d') AS amend_date, CAST(o_custkey % 720 % 300 AS VARCHAR) AS probe FROM orders),
one AS (SELECT strftime(doc_date, '%Y-%m-%d') AS day, * FROM acts),
t AS (SELECT day, min(doc_id) AS d FROM one WHERE titled GROUP BY 1 HAVING count(*) = 1), b AS (SELECT day, CAST(art AS VARCHAR) AS art, min(doc_id) AS d FROM one WHERE names GROUP BY 1, 2 HAVING count(*) = 1), l AS (SELECT day, min(doc_id) AS d FROM one WHERE names AND doc_type = 'law' GROUP BY 1 HAVING count(*) = 1)
SELECT event_id, coalesce(t.d, b.d, l.d) AS amending_doc_id, CASE WHEN t.d IS NOT NULL THEN 'date+civil-code-title' WHEN b.d IS NOT NULL THEN 'date+cc-clause-match' WHEN l.d IS NOT NULL THEN 'date+sole-law-cc-mention' ELSE 'unresolved' END AS match_method
FROM e LEFT JOIN t ON t.day = amend_date LEFT JOIN b ON b.day = amend_date AND b.art = probe LEFT JOIN l ON l.day = amend_date
""")
def amending_act(spark, d):
    """The act that made an amendment: by its title, by a block that names the Code and the article, or as the day's only law that names it."""
    acts, bodies = _acts(spark, d)
    k = F.col("o_custkey") % 720
    events = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd").alias("amend_date"), (k % 300).cast("string").alias("probe_article"))
    return A.amending_acts(events, acts, bodies).select("event_id", "amending_doc_id", "match_method")


@query(f"""
WITH n AS (SELECT 'n' || p_partkey AS norm_id, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE {GENERAL} END AS doc_id, p_partkey AS src_row, CAST(p_partkey % 150 AS VARCHAR) AS art FROM part),
e AS (SELECT o_orderkey AS event_id, o_custkey AS row_id, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE {GENERAL} END AS doc_id, CAST(o_custkey % 150 AS VARCHAR) AS host, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey % 150 AS VARCHAR) ELSE CAST((o_custkey + 1) % 160 AS VARCHAR) END AS target FROM orders),
r AS (SELECT src_row, norm_id FROM n WHERE doc_id = {GENERAL}), a AS (SELECT art, arg_max(norm_id, src_row) AS norm_id FROM n WHERE doc_id = {GENERAL} GROUP BY 1)
SELECT event_id, CASE WHEN doc_id <> {GENERAL} THEN NULL WHEN coalesce(target, host) = host THEN r.norm_id ELSE a.norm_id END AS norm_id FROM e LEFT JOIN r ON r.src_row = e.row_id LEFT JOIN a ON a.art = e.target
""")
def amended_norm(spark, d):
    """The norm that an event changed: its own row's if it names its host, else the one that bears the number."""
    k = F.col("p_partkey")
    norms = table(spark, d, "part").select(F.concat(F.lit("n"), k).alias("norm_id"), F.when(k % 5 == 0, 0).otherwise(GENERAL).alias("doc_id"), k.alias("src_row"), (k % 150).cast("string").alias("article_number"))
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    target = F.when(o % 3 == 1, c % 150).when(o % 3 == 2, (c + 1) % 160).cast("string")
    events = table(spark, d, "orders").select(o.alias("event_id"), c.alias("row_id"), F.when(o % 7 == 0, 0).otherwise(GENERAL).alias("doc_id"), (c % 150).cast("string").alias("host_article"), target.alias("target_article"))
    return A.amended_norms(events, norms).select("event_id", "norm_id")


@query("""
SELECT o_orderkey AS row_id, CAST(o_orderkey % 380 + 1 AS VARCHAR) AS article, 'fk_alias' AS anchor FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 0)
""")
def alias_citations(spark, d):
    """Citations by the abbreviation, in acts that define it somewhere."""
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 50 == 0, "Kodeks (bundan buyon matnda FK deb yuritiladi). ").otherwise(""), F.lit("FK "), k % 380 + 1, F.lit("-moddasi"))
    rows = dealt(table(spark, d, "orders"), "o_orderkey").select(k.alias("row_id"), F.col("o_custkey").alias("doc_id"), F.lit(False).alias("is_the_code"), F.lit("law").alias("doc_type"), text.alias("article_text"))
    return citations(spark, A.with_alias(rows), ("article_text",)).select("row_id", "article", "anchor")


@query("""
SELECT o_orderkey AS row_id, article_kind AS target_kind, CASE WHEN article_kind = 'article' THEN CAST(o_custkey % 300 + 1 AS VARCHAR) END AS article, CASE WHEN article_kind <> 'article' THEN CAST(o_custkey % 60 + 1 AS INT) END AS struct_number,
 CASE WHEN article_kind = 'section' THEN CAST(o_custkey % 9 + 1 AS INT) END AS section_number, CASE WHEN article_kind = 'article' THEN ['birinchi', 'ikkinchi', 'uchinchi', 'toʻrtinchi'][CAST(u AS INT)] || ' qism' END AS qism
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [1, 2] WHEN o_orderkey % 4 = 1 THEN [2, 3, 4] ELSE [1] END) AS u, CASE WHEN o_orderkey % 4 < 2 THEN 'article' WHEN o_orderkey % 4 = 2 THEN 'section' ELSE 'chapter' END AS article_kind FROM orders)
""")
def cited_units(spark, d):
    """Parts of articles as lists and as spans of ordinals, chapters, and their sections."""
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    article, chapter = F.concat(c % 300 + 1, F.lit("-moddasining ")), F.concat(c % 60 + 1, F.lit("-bobi"))
    own = (
        F.when(k == 0, F.concat(article, F.lit("birinchi va ikkinchi qismlari"))).when(k == 1, F.concat(article, F.lit("ikkinchi — toʻrtinchi qismlari")))
        .when(k == 2, F.concat(chapter, F.lit(", "), c % 9 + 1, F.lit("-paragrafi"))).otherwise(chapter)
    )
    rows = dealt(table(spark, d, "orders"), "o_orderkey").select(F.col("o_orderkey").alias("row_id"), F.lit(False).alias("allow_fk_alias"), F.lit(True).alias("is_the_code"), F.lit("code").alias("doc_type"), F.concat(F.lit("ushbu Kodeksning "), own).alias("article_text"))
    return citations(spark, rows, ("article_text",)).select("row_id", "target_kind", "article", "struct_number", "section_number", "qism")


@query("""
SELECT o_orderkey AS row_id, target_kind, CAST(CASE WHEN o_orderkey % 3 = 2 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_custkey % 30 + 1 ELSE o_custkey % 70 + 1 END AS INT) AS struct_number
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'part' WHEN 1 THEN 'chapter' ELSE 'act' END AS target_kind FROM orders)
""")
def cited_parts(spark, d):
    """Parts in Roman numerals, chapters called parts, and the act itself where nothing else is named."""
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey")
    own = F.when(k == 0, F.concat(X.roman(c % 30 + 1), F.lit("-boʻlimi"))).when(k == 1, F.concat(c % 70 + 1, F.lit("-boʻlimi"))).otherwise("talablari (bundan buyon Kodeks deb yuritiladi)")
    rows = dealt(table(spark, d, "orders"), "o_orderkey").select(F.col("o_orderkey").alias("row_id"), F.lit(False).alias("allow_fk_alias"), F.lit(False).alias("is_the_code"), F.lit("law").alias("doc_type"), F.concat(F.lit("Fuqarolik kodeksining "), own).alias("article_text"))
    return citations(spark, rows, ("article_text",)).select("row_id", "target_kind", "struct_number")


@query("""
SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 300 + 1 AS VARCHAR) || '-moddasining ' || o_custkey % 6 || '-qismi' ELSE '' END AS locator,
 'removed' AS change_type, o_orderkey % 2 = 1 AS non_statute FROM orders
""")
def late_locators(spark, d):
    """Places named after an amendment's source, and titles that are no statute's."""
    o, k = dealt(table(spark, d, "orders"), "o_orderkey"), F.col("o_orderkey") % 2
    place = F.when(k == 0, F.concat(F.col("o_custkey") % 300 + 1, F.lit("-moddasining "), F.col("o_custkey") % 6, F.lit("-qismi"))).otherwise(F.concat(F.col("o_custkey") % 300 + 1, F.lit("-modda")))
    note = F.concat(F.lit("(Oʻzbekiston Respublikasining 2001-yil 3-maydagi OʻRQ-1-sonli Qonuniga asosan "), place, F.lit(" chiqarilgan sanasi 2001-yil)"))
    events = E.amendments(o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("doc_id"), F.lit("1").alias("host_article"), note.alias("note")))
    clause = F.concat(F.lit("oʻz kuchini yoʻqotgan deb topilsin: 2001-yil 3-mayda qabul qilingan “Akt nomi bor”gi "), F.when(k == 1, "Qarori").otherwise("5-II-sonli Qonuni"))
    items = E.repeal_items(o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("doc_id"), clause.alias("text")))
    return events.select("row_id", "locator", "change_type").join(items.select("row_id", "non_statute"), "row_id")
