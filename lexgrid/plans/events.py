"""Queries over events and links: repeals, amendments, currency, edges, updates, samples and scores on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import events as E
from ..operators import links as L
from ..operators import windows as W
from ..operators.citations import citations
from ..sources.tables import dealt, table, with_row_id
from .catalog import query


@query("""
SELECT o_orderkey AS row_id, CAST(1 AS BIGINT) AS item_no, strftime(o_orderdate, '%Y-%m-%d') AS iso_date, 'akt raqami ' || o_custkey AS title, (o_orderkey % 900) || '-II' AS cited_number,
 CASE WHEN o_orderstatus = 'F' THEN (o_custkey % 50 + 1) || '-moddasi' END AS locator FROM orders
UNION ALL SELECT o_orderkey, 2, strftime(o_orderdate, '%Y-%m-%d'), 'ikkinchi', NULL, NULL FROM orders WHERE o_orderstatus = 'P'
""")
def repeal_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of repealing clauses read back from their sentences."""
    o = dealt(table(spark, d, "orders"), "o_orderkey")
    date = F.concat(F.year("o_orderdate"), F.lit("-yil "), F.day("o_orderdate"), F.lit("-"), F.element_at(F.array(*map(F.lit, X.MONTHS)), F.month("o_orderdate")), F.lit("da qabul qilingan “"))
    one = F.concat(date, F.lit("Akt raqami "), "o_custkey", F.lit("”gi "), F.col("o_orderkey") % 900, F.lit("-II-sonli Qonuni "), F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_custkey") % 50 + 1, F.lit("-moddasi"))).otherwise(""))
    two = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("; 2) "), date, F.lit("Ikkinchi”gi Qarori"))).otherwise("")
    text = F.concat(F.lit("oʻz kuchini yoʻqotgan deb topilsin: 1) "), one, two)
    items = E.repeal_items(o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("doc_id"), text.alias("text")))
    return items.select("row_id", F.col("item_no").cast("long").alias("item_no"), "iso_date", "title", "cited_number", "locator")


@query("""
SELECT o_orderkey AS row_id, CAST(unnest(CASE WHEN o_custkey % 3 = 0 THEN [o_custkey % 300 + 1, o_custkey % 300 + 2] WHEN o_custkey % 3 = 1 THEN generate_series(o_custkey % 300 + 1, o_custkey % 300 + 4) ELSE [NULL] END) AS VARCHAR) AS target_article,
 ['restated', 'removed', 'inserted', 'other'][CAST(o_orderkey % 4 + 1 AS INT)] AS change_type, strftime(o_orderdate, '%Y-%m-%d') AS amend_date, 'OʻRQ-' || o_custkey AS act_number FROM orders
""")
def amendment_targets(spark, d):
    """Amendment notes to one event for each article that they name."""
    o = dealt(table(spark, d, "orders"), "o_orderkey")
    n, kind = F.col("o_custkey") % 300 + 1, F.col("o_custkey") % 3
    scope = F.when(kind == 0, F.concat(n, F.lit(" va "), n + 1, F.lit("-moddalar "))).when(kind == 1, F.concat(n, F.lit(" — "), n + 3, F.lit("-moddalar "))).otherwise("birinchi qismi ")
    verbs = F.element_at(F.array(*map(F.lit, ("tahririda", "asosan chiqarib tashlangan", "bilan kiritilgan", "eʼlon qilingan"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    month = F.element_at(F.array(*map(F.lit, X.MONTHS)), F.month("o_orderdate"))
    note = F.concat(F.lit("("), scope, F.lit("Oʻzbekiston Respublikasining "), F.year("o_orderdate"), F.lit("-yil "), F.day("o_orderdate"), F.lit("-"), month, F.lit("dagi OʻRQ-"), "o_custkey", F.lit("-sonli Qonuni "), verbs, F.lit(" — manba)"))
    events = E.amendments(o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("doc_id"), F.lit("1").alias("host_article"), note.alias("note")))
    return events.select("row_id", "target_article", "change_type", "amend_date", "act_number")


def _log(spark, d) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("removed", "voided", "inserted", "restated"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select(
        "event_id", (F.col("user_id") % 5).alias("doc_id"), F.col("user_id").cast("string").alias("host_article"), F.when(F.col("event_id") % 6 == 0, F.lit("7")).alias("target_article"), F.col("event_type").alias("locator"), kind.alias("change_type"),
        F.date_format("ts", "yyyy-MM-dd").alias("amend_date"),
    )


LOG = """(SELECT event_id, user_id % 5 AS doc_id, CAST(user_id AS VARCHAR) AS host_article, CASE WHEN event_id % 6 = 0 THEN '7' END AS target_article, event_type AS locator,
 ['removed','voided','inserted','restated'][CAST(event_id % 4 + 1 AS INT)] AS change_type, strftime(ts, '%Y-%m-%d') AS amend_date FROM events)"""


@query(f"SELECT doc_id, coalesce(target_article, host_article) AS article, CAST(count(*) AS BIGINT) AS n_events, max(amend_date) AS last_date, arg_max(change_type, amend_date || lpad(CAST(99999999 - event_id AS VARCHAR), 9, '0')) AS last_type, bool_or(change_type = 'voided') AS any_voided FROM {LOG} GROUP BY 1, 2")
def article_currency(spark, d):
    """What the latest event left of each article."""
    return E.article_currency(_log(spark, d))


@query(f"SELECT event_id, change_type IN ('removed','voided') AND last_value(change_type) OVER (PARTITION BY doc_id, host_article, locator ORDER BY amend_date, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) NOT IN ('removed','voided') AS is_stale FROM {LOG}")
def locator_status(spark, d):
    """Removals that a later event undid."""
    return E.locator_status(_log(spark, d)).select("event_id", "is_stale")


@query("""
WITH c AS (SELECT o_orderkey AS clause_id, o_custkey AS src_doc_id, o_custkey % 997 AS dst_doc_id, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS locator, strftime(o_orderdate, '%Y-%m-%d') AS cited_date FROM orders),
w AS (SELECT dst_doc_id, src_doc_id FROM c WHERE locator IS NULL QUALIFY row_number() OVER (PARTITION BY dst_doc_id ORDER BY cited_date, clause_id) = 1)
SELECT c_custkey AS doc_id, CASE WHEN src_doc_id IS NULL THEN 'in-force' ELSE 'superseded' END AS status, src_doc_id AS repealed_by FROM customer LEFT JOIN w ON dst_doc_id = c_custkey
""")
def act_currency(spark, d):
    """Which acts a whole-act repeal has superseded, and whose."""
    o = table(spark, d, "orders")
    clauses = o.select(F.col("o_orderkey").alias("clause_id"), F.col("o_custkey").alias("src_doc_id"), (F.col("o_custkey") % 997).alias("dst_doc_id"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("locator"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("cited_date"))
    return E.act_currency(table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id")), clauses).select("doc_id", "status", "repealed_by")


@query("""
WITH n AS (SELECT p_partkey, count(*) OVER (PARTITION BY p_partkey % 150) AS t, row_number() OVER (PARTITION BY p_partkey % 150 ORDER BY p_partkey) AS k, CAST(p_partkey % 150 AS VARCHAR) AS article FROM part),
s AS (SELECT o_orderkey, CAST(substr(o_orderpriority,1,1) AS INT) AS tier, CAST(o_custkey % 380 + 1 AS VARCHAR) AS article FROM orders)
SELECT o_orderkey AS row_id, s.article, n.p_partkey AS dst_norm_id, coalesce(t > 1, false) AS dst_ambiguous, n.p_partkey IS NULL AS dst_dangling, CASE WHEN tier > 2 THEN 'realizes' ELSE 'cites' END AS relation,
 CASE WHEN tier > 2 THEN 'below' WHEN tier = 2 THEN 'same' ELSE 'above' END AS hierarchy_rel, CASE WHEN n.p_partkey IS NULL THEN 0.88 WHEN t > 1 THEN 0.85 ELSE 0.95 END::DOUBLE AS confidence
FROM s LEFT JOIN n ON n.article = s.article AND k = 1
""")
def link_edges(spark, d):
    """Sentences to edges: grammar, target, ambiguity, relation and confidence."""
    o = dealt(table(spark, d, "orders"), "o_orderkey")
    rows = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("doc_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), F.lit(False).alias("is_the_code"), F.concat(F.lit("Fuqarolik kodeksining "), F.col("o_custkey") % 380 + 1, F.lit("-moddasi")).alias("article_text"))
    found = citations(spark, rows.select("row_id", F.lit(False).alias("allow_fk_alias"), "is_the_code", F.lit("law").alias("doc_type"), "article_text"), ("article_text",))
    norms = table(spark, d, "part").select(F.col("p_partkey").alias("norm_id"), F.lit(-111189).cast("long").alias("doc_id"), (F.col("p_partkey") % 150).cast("string").alias("article_number"), F.col("p_partkey").alias("occurrence"))
    edges = L.edges(found, rows.drop("article_text"), norms, spark.createDataFrame([("C1",)], "node_id string"))
    return edges.select("row_id", "article", "dst_norm_id", "dst_ambiguous", "dst_dangling", "relation", "hierarchy_rel", "confidence")


@query("""
WITH e AS (SELECT l_orderkey AS k, l_returnflag AS v, row_number() OVER (PARTITION BY l_orderkey, l_returnflag) AS n FROM lineitem WHERE l_quantity > 20), g AS (SELECT l_orderkey AS k, l_returnflag AS v, row_number() OVER (PARTITION BY l_orderkey, l_returnflag) AS n FROM lineitem WHERE l_discount < 0.06)
SELECT CAST(count(*) FILTER (WHERE e.k IS NOT NULL AND g.k IS NOT NULL) AS BIGINT) AS hits, CAST(count(*) FILTER (WHERE g.k IS NULL) AS BIGINT) AS missed, CAST(count(*) FILTER (WHERE e.k IS NULL) AS BIGINT) AS spurious FROM e FULL JOIN g ON e.k = g.k AND e.v = g.v AND e.n = g.n
""")
def multiset_score(spark, d):
    """Expected against found with repeats: per signature the smaller count hits. Counts meet, not rows."""
    x = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count_if(F.col("l_quantity") > 20).alias("e"), F.count_if(F.col("l_discount") < 0.06).alias("g"))
    both = F.least("e", "g")
    return x.agg(F.sum(both).alias("hits"), F.sum(F.col("e") - both).alias("missed"), F.sum(F.col("g") - both).alias("spurious"))


@query("SELECT doc_id, contains(text, '@') AS hit FROM documents QUALIFY row_number() OVER (PARTITION BY contains(text, '@') ORDER BY md5('7-' || doc_id), doc_id) <= 5")
def stratified_sample(spark, d):
    """A seeded sample, as many of either stratum. Each is a sorted limit, so no stratum meets in one task."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").contains("@").alias("hit"))
    draw = lambda df: df.orderBy(F.md5(F.concat(F.lit("7-"), "doc_id")), "doc_id").limit(5)
    return draw(docs.where("hit")).unionByName(draw(docs.where("NOT hit")))


@query("""
WITH n AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 2 THEN (event_id // 30) * 10 + event_id % 9 + 1 ELSE event_id // 3 + 1 END AS num FROM events),
b AS (SELECT *, max(CASE WHEN num <= 2000 THEN num END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior, max(CASE WHEN num <= 2000 THEN num END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base FROM n)
SELECT event_id, num, base, CASE WHEN num <= 2000 AND (prior IS NULL OR num > prior) THEN NULL WHEN starts_with(CAST(num AS VARCHAR), CAST(base AS VARCHAR)) THEN substr(CAST(num AS VARCHAR), length(CAST(base AS VARCHAR)) + 1) ELSE '?' END AS superscript FROM b
""")
def superscripts(spark, d):
    """Numbers that are a base of their own, and numbers that are a superscript of the base before them."""
    i = F.col("event_id")
    n = table(spark, d, "events").select("event_id", "user_id", F.when(i % 3 == 2, F.floor(i / 30) * 10 + i % 9 + 1).otherwise(F.floor(i / 3) + 1).alias("num"))
    out = W.running_base(n, ["user_id"], ["event_id"], F.col("num"), F.col("num") <= 2000)
    num, base = F.col("num").cast("string"), F.col("base").cast("string")
    tail = F.when(F.col("is_base"), F.lit(None)).when(num.startswith(base), F.substr(num, F.length(base) + 1)).otherwise("?")
    return out.select("event_id", "num", "base", tail.alias("superscript"))


@query("SELECT CAST(p_size AS INT) AS stage_no, CAST(min(p_partkey) AS BIGINT) AS art_from, CAST(max(p_partkey) AS BIGINT) AS art_to, CAST(count(*) AS BIGINT) AS n_articles FROM part GROUP BY 1")
def chapter_spans(spark, d):
    """Stages from the chapters that rows name in text, and what they span."""
    chapter = F.concat("p_size", F.lit("-bob. "), "p_name")
    stage = F.regexp_extract("chapter", r"^(\d+)-bob", 1).try_cast("int")
    return table(spark, d, "part").select("p_partkey", chapter.alias("chapter")).groupBy(stage.alias("stage_no")).agg(F.min("p_partkey").alias("art_from"), F.max("p_partkey").alias("art_to"), F.count("*").alias("n_articles"))


@query("WITH a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O') SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE b.l_orderkey IS NULL) AS BIGINT) AS n_only_first FROM a LEFT JOIN b ON a.l_orderkey = b.l_orderkey")
def disagreement(spark, d):
    """Keys that one field names and another doesn't: two flags of one grouped pass."""
    k = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("a"), F.bool_or(F.col("l_linestatus") == "O").alias("b"))
    return k.agg(F.count_if("a").alias("n"), F.count_if(F.col("a") & ~F.col("b")).alias("n_only_first"))


@query("""
WITH u AS (SELECT p_name FROM part GROUP BY 1 HAVING count(*) = 1), e AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS norm_id, p_name FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT p_partkey, CAST(count(*) AS BIGINT) AS n FROM (SELECT norm_id AS p_partkey FROM e WHERE norm_id IS NOT NULL UNION ALL SELECT part.p_partkey FROM e JOIN u ON u.p_name = e.p_name JOIN part ON part.p_name = e.p_name WHERE norm_id IS NULL) GROUP BY 1
""")
def null_tolerant_key(spark, d):
    """A join by id where there is one, else by name where the name is unambiguous: two keyed frames, not an OR."""
    part, lineitem = table(spark, d, "part"), table(spark, d, "lineitem")
    e = lineitem.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").select(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey")).alias("norm_id"), "p_name")
    only = part.groupBy("p_name").agg(F.count("*").alias("k"), F.min("p_partkey").alias("p_partkey")).where("k = 1")
    both = e.where("norm_id IS NOT NULL").select(F.col("norm_id").alias("p_partkey")).unionByName(e.where("norm_id IS NULL").join(only, "p_name").select("p_partkey"))
    return both.groupBy("p_partkey").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(unnest([1, 2, 3]) AS BIGINT) AS article FROM orders")
def block_split(spark, d):
    """Texts cut at article markers."""
    text = F.concat(F.lit("Kirish. 1-modda. Bir "), "o_custkey", F.lit(" 2-modda. Ikki\n3-modda. Uch 4-moddasi bilan"))
    cut = E.blocks(table(spark, d, "orders").select("o_orderkey", text.alias("t")), "o_orderkey", "t")
    return cut.select("o_orderkey", F.regexp_extract("block", r"^(\d+)-modda\. ", 1).try_cast("long").alias("article")).where("article IS NOT NULL")


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) - 1 AS BIGINT) AS last_row, CAST(count(*) AS BIGINT) AS n_ids FROM orders")
def row_ids(spark, d):
    """Physical row numbers as ids."""
    return with_row_id(spark, f"{d}/orders.parquet").agg(F.count("*").alias("n"), F.max("row_id").alias("last_row"), F.countDistinct("file_name", "row_id").alias("n_ids"))


@query("SELECT c_custkey, coalesce(p, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS p FROM orders WHERE o_totalprice > 480000 GROUP BY 1) ON o_custkey = c_custkey")
def keyed_update(spark, d):
    """Rows changed by keyed updates: a left join and a coalesce, written as a new snapshot."""
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    change = orders.where("o_totalprice > 480000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("p"))
    return customer.join(change, "c_custkey", "left").select("c_custkey", F.coalesce("p", "c_mktsegment").alias("c_mktsegment"))
