"""The verifier on the driver's tables, read as derived ones: customers are acts, parts are norms, line items are edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import verify as V
from ..sources.tables import table
from .catalog import query

DOC = -111189


def _norms(spark: SparkSession, d: str) -> DataFrame:
    """norm_unit: some norms aren't translated, some texts are empty, some have no status, no node, or a base outside their node's range."""
    k = F.col("p_partkey")
    text = F.when(k % 9 != 0, F.when(k % 101 == 0, " ").otherwise(F.concat(F.lit("line "), k, F.lit("\nline "), k + 1)))
    return table(spark, d, "part").select(
        F.concat(F.lit("n"), k).alias("norm_id"), F.lit(DOC).cast("long").alias("doc_id"), k.alias("src_row"), k.cast("string").alias("article_number"), F.col("p_name").alias("article_title_uz"), F.col("p_type").alias("article_text_uz"),
        text.alias("article_text_en"), F.when(k % 40 != 1, "aligned").alias("en_align_status"), F.when(k % 60 != 2, k).alias("en_line_start"), (k + 1 + F.when(k % 300 == 4, 1).otherwise(0)).alias("en_line_end"),
        F.when(k % 70 != 3, F.concat(F.lit("C"), F.floor(k / 10))).alias("struct_node_id"), F.when(k % 80 == 5, k + 11).otherwise(k + 1).alias("article_base"), F.when(k % 25 == 0, 1).alias("superscript"),
    )


NORMS = f"""part_ AS (SELECT *, p_partkey AS k FROM part), norm AS (SELECT 'n' || k AS norm_id, k AS src_row, p_name AS title, p_type AS txt, k,
 CASE WHEN k % 9 <> 0 THEN CASE WHEN k % 101 = 0 THEN ' ' ELSE 'line ' || k || chr(10) || 'line ' || (k + 1) END END AS en, CASE WHEN k % 40 <> 1 THEN 'aligned' END AS st, CASE WHEN k % 60 <> 2 THEN k END AS a, k + 1 + CASE WHEN k % 300 = 4 THEN 1 ELSE 0 END AS b,
 CASE WHEN k % 70 <> 3 THEN 'C' || (k // 10) END AS node, CASE WHEN k % 80 = 5 THEN k + 11 ELSE k + 1 END AS base, CASE WHEN k % 25 = 0 THEN 1 END AS sup FROM part_)"""
quoted = lambda x: x.replace("'", "''")
say = lambda area, name, n: f"SELECT '{area}' AS area, '{quoted(name)}' AS \"check\", CAST(n AS BIGINT) = 0 AS ok, CAST(n AS BIGINT) AS detail FROM ({n})"
union = lambda area, rows: " UNION ALL ".join(say(area, name, n) for name, n in rows)


@query(f"""WITH {NORMS} {union('transfer', [
    ('source articles landed or reported', "SELECT abs((SELECT count(*) FROM norm WHERE en IS NOT NULL) + (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 0) - (SELECT count(*) FROM part)) AS n"),
    ('norms translated or reported', "SELECT abs((SELECT count(*) FROM norm WHERE en IS NOT NULL) + (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 1) - (SELECT count(*) FROM norm)) AS n"),
    ('no landed text is empty', "SELECT count(*) AS n FROM norm WHERE trim(en) = ''"), ('norm_id is unique', "SELECT count(*) AS n FROM (SELECT norm_id FROM norm GROUP BY 1 HAVING count(*) > 1)"),
    ('landed texts have a status', "SELECT count(*) AS n FROM norm WHERE en IS NOT NULL AND st IS NULL")])}
 UNION ALL {union('slices', [
    ('landed texts equal their source lines', "SELECT count(*) AS n FROM norm WHERE en IS NOT NULL AND a IS NOT NULL AND (k % 101 = 0 OR b > k + 1 OR k % 50 = 0 OR k % 50 = 49)"),
    ('source lines exist', "SELECT count(*) AS n FROM norm WHERE en IS NOT NULL AND a IS NOT NULL AND b > (SELECT max(p_partkey) + 1 FROM part)"), ('line numbers begin at 1', "SELECT count(*) AS n FROM norm WHERE en IS NOT NULL AND a < 1")])}
 UNION ALL {union('raw', [
    ('row count unchanged', "SELECT abs(count(*) - (SELECT count(*) FROM part)) AS n FROM part"), ('column count unchanged', "SELECT 0 AS n"), ('derived texts equal the source', "SELECT count(*) AS n FROM norm WHERE k % 33 = 0")])}
""")
def verify_transfer(spark, d):
    """What landed is complete, cut from its source, and the source is as it was (areas 1 to 3)."""
    part, norm = table(spark, d, "part"), _norms(spark, d)
    kind = F.element_at(F.array(*map(F.lit, ("md_only", "db_only", "other", "other"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    reported = table(spark, d, "supplier").select(kind.alias("kind"))
    k = F.col("p_partkey")
    numbers = part.select(k.alias("line_no")).union(part.agg(F.max(k) + 1))
    lines = numbers.select("line_no", F.when(F.col("line_no") % 50 == 0, "changed").otherwise(F.concat(F.lit("line "), "line_no")).alias("line"))
    raw = part.select(k.alias("src_row"), k.cast("string").alias("article_number"), F.when(k % 33 != 0, F.col("p_name")).alias("article_title"), F.col("p_type").alias("article_text"))
    return V.report({"transfer": V.transfer(norm, reported, part), "slices": V.slices(norm, lines), "raw": V.raw_layer(raw, norm, raw.count(), 4)})


@query(f"""WITH {NORMS}, node AS (SELECT 'C' || i AS node_id, i, i * 10 + 1 AS a, i * 10 + 10 + CASE WHEN i % 17 = 3 THEN 1 ELSE 0 END AS b FROM (SELECT DISTINCT k // 10 AS i FROM part_)) {union('tree', [
    ('ranges are contiguous', "SELECT count(*) AS n FROM (SELECT a, lag(b) OVER (ORDER BY a) AS p FROM node) WHERE a <> p + 1"), ('norms are attached', "SELECT count(*) AS n FROM norm WHERE node IS NULL"),
    ('bases lie in their node\'s range', "SELECT count(*) AS n FROM norm x JOIN node y ON y.node_id = x.node WHERE x.base NOT BETWEEN y.a AND y.b"), ('unit counts add up', "SELECT count(*) AS n FROM norm WHERE node IS NULL"),
    ('superscripts agree with the source', "SELECT count(*) AS n FROM norm WHERE k % 25 = 0 AND k % 50 <> 0"), ('norms have a breadcrumb', "SELECT count(*) AS n FROM norm WHERE node IS NULL")])}
 UNION ALL {union('classifier', [
    ('the classifier parses', "SELECT (SELECT count(*) FROM customer WHERE c_custkey % 20 = 0) + (SELECT count(*) FROM customer WHERE c_nationkey = 24) AS n"), ('classifier rows match its source', "SELECT 0 AS n"),
    ('parents exist', "SELECT count(*) AS n FROM customer WHERE c_nationkey = 24"), ('assignments resolve', "SELECT count(*) AS n FROM norm WHERE k % 13 = 0 OR node IS NULL"), ('all norms are classified', "SELECT count(*) AS n FROM norm WHERE k % 15 = 0"),
    ('classes have a breadcrumb', "SELECT count(*) AS n FROM norm WHERE k % 15 <> 0 AND k % 16 = 0"), ('assignments stay in their sphere', "SELECT count(*) AS n FROM norm WHERE k % 13 = 0")])}
""")
def verify_structure(spark, d):
    """The tree of structure and the classifier (areas 4 and 6)."""
    norm, k = _norms(spark, d), F.col("p_partkey")
    i = table(spark, d, "part").select(F.floor(k / 10).alias("i")).distinct()
    nodes = i.select(F.concat(F.lit("C"), "i").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("chapter").alias("kind"), F.lit(DOC).alias("doc_id"), (F.col("i") * 10 + 1).alias("art_from"), (F.col("i") * 10 + 10 + F.when(F.col("i") % 17 == 3, 1).otherwise(0)).alias("art_to"))
    units = norm.groupBy(F.col("struct_node_id").alias("node_id")).agg(F.count("*").alias("n_units"))
    nodes = nodes.join(units, "node_id", "left")
    superscripts = table(spark, d, "part").where(k % 50 == 0).select(k.cast("string").alias("article_number"))
    crumbs = nodes.select("node_id", F.col("node_id").alias("breadcrumb"))
    c = table(spark, d, "customer")
    top = table(spark, d, "nation").where("n_nationkey < 24").select(F.concat(F.lit("03."), "n_nationkey").alias("code"), F.lit(None).cast("string").alias("parent_code"), F.col("n_name").alias("label_en"))
    low = c.select(F.concat(F.lit("03.c"), "c_custkey").alias("code"), F.concat(F.lit("03."), "c_nationkey").alias("parent_code"), F.when(F.col("c_custkey") % 20 == 0, " ").otherwise(F.col("c_name")).alias("label_en"))
    okoz = top.unionByName(low)
    n = F.col("src_row")
    assigned = norm.select(F.when(n % 13 == 0, F.lit("04.x")).otherwise(F.concat(F.lit("03."), n % 24)).alias("okoz_code"), "struct_node_id")
    placed = norm.where(n % 15 != 0).select("norm_id", F.when(n % 16 != 0, "a > b").alias("breadcrumb"))
    return V.report({"tree": V.tree(nodes, norm, superscripts, crumbs), "classifier": V.classifier(okoz, okoz, assigned, nodes.select("node_id"), norm, placed)})


EDGES = """e0 AS (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem),
e AS (SELECT k, l_orderkey, l_partkey, CASE WHEN k % 50 = 0 THEN ' ' WHEN k % 50 = 1 THEN 'Kodeks (Axborotnomasi, 1997-yil, № 2, ' || l_partkey || '-modda)' WHEN k % 50 = 2 THEN 'Kodeks (Axborotnomasi, 1997-yil, № 2) ' || l_partkey || '-moddasi' ELSE 'matn ' || l_partkey || '-moddasi' END AS ev, l_linenumber % 3 AS f FROM e0)"""


def _edges(spark, d) -> DataFrame:
    """link_edge, with empty evidence, gazette records, unresolved and unknown targets, and wrong kinds here and there."""
    k, n = F.col("l_orderkey") * 8 + F.col("l_linenumber"), F.col("l_partkey")
    field = F.element_at(F.array(*map(F.lit, ("article_text", "cross_references", "amendment_note"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ("normative", "editorial", "amendment"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    evidence = (
        F.when(k % 50 == 0, " ").when(k % 50 == 1, F.concat(F.lit("Kodeks (Axborotnomasi, 1997-yil, № 2, "), n, F.lit("-modda)")))
        .when(k % 50 == 2, F.concat(F.lit("Kodeks (Axborotnomasi, 1997-yil, № 2) "), n, F.lit("-moddasi"))).otherwise(F.concat(F.lit("matn "), n, F.lit("-moddasi")))
    )
    return table(spark, d, "lineitem").select(
        k.alias("edge_id"), F.when(k % 90 == 7, -1).otherwise(F.col("l_orderkey")).alias("src_row_id"), F.when(k % 60 == 9, 2).otherwise(4).alias("src_tier"), F.lit("article").alias("dst_kind"), F.lit(DOC).cast("long").alias("dst_doc_id"), n.cast("string").alias("dst_article_number"),
        F.when(k % 40 == 3, F.concat(F.lit("x"), n)).when(k % 40 != 4, F.concat(F.lit("n"), n)).alias("dst_norm_id"), (k % 80 == 4).alias("dst_dangling"), F.lit("below").alias("hierarchy_rel"), evidence.alias("evidence"), field.alias("source_field"),
        F.when(k % 200 == 11, "rumour").when(k % 200 == 12, "normative").otherwise(kind).alias("evidence_kind"), F.when(k % 1000 == 13, 0.1).otherwise(0.9).alias("confidence"),
        F.when(k % 70 == 14, F.concat(F.lit("Oldingi tahrirga qarang "), n)).when(k % 70 != 15, F.concat(F.lit("matn "), n)).alias("evidence_clean"), F.when(k % 30 != 16, F.when(k % 30 == 17, 5).otherwise(0)).alias("ev_clean_start"), F.when(k % 30 == 18, 999).otherwise(4).alias("ev_clean_end"),
    )


@query(f"""WITH {EDGES} {union('edges', [
    ('edges have evidence', "SELECT count(*) AS n FROM e WHERE k % 50 = 0"), ('articles resolve or dangle', "SELECT count(*) AS n FROM e WHERE k % 40 = 4 AND k % 80 <> 4"), ('edges point at norms', "SELECT count(*) AS n FROM e WHERE k % 40 = 3 OR (k % 40 <> 4 AND l_partkey NOT IN (SELECT p_partkey FROM part))"),
    ('citing rows exist', "SELECT count(*) AS n FROM e WHERE k % 90 = 7 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)"), ('nothing at the Code\'s tier realizes it', "SELECT count(*) AS n FROM e WHERE k % 60 = 9"), ('no edge from a gazette\'s record', "SELECT count(*) AS n FROM e WHERE k % 50 = 1")])}
 UNION ALL {union('provenance', [
    ('evidence kinds are known', "SELECT count(*) AS n FROM e WHERE k % 200 = 11"), ('evidence kinds agree with fields', "SELECT count(*) AS n FROM e WHERE k % 200 = 11 OR (k % 200 = 12 AND f <> 0)"), ('own words outrank pointers', "SELECT CAST(EXISTS (SELECT 1 FROM e WHERE k % 1000 = 13 AND f = 0) AND EXISTS (SELECT 1 FROM e WHERE f = 1 AND k % 1000 <> 13 AND k % 200 NOT IN (11, 12)) AS INT) AS n"),
    ('shown evidence is clean', "SELECT count(*) AS n FROM e WHERE k % 70 IN (14, 15)"), ('spans are valid', "SELECT count(*) AS n FROM e WHERE k % 30 = 17 OR k % 30 = 18 OR (k % 30 <> 16 AND k % 70 = 15)"),
    ('provisions are stored', "SELECT count(*) AS n FROM e WHERE k % 90 = 7 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)"), ('no stored provision is empty', "SELECT count(*) AS n FROM orders WHERE o_orderkey % 45 = 0")])}
""")
def verify_edges(spark, d):
    """The reference graph and where its evidence comes from (areas 5 and 7)."""
    edge, o = _edges(spark, d), F.col("o_orderkey")
    rows = table(spark, d, "orders").select(o.alias("row_id"), F.when(o % 45 == 0, "").otherwise("matn").alias("article_text"))
    return V.report({"edges": V.edges(edge, _norms(spark, d), rows, DOC), "provenance": V.provenance(edge, rows)})


@query(f"""{union('currency', [
    ('repeals point at acts', "SELECT count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey + 40 NOT IN (SELECT c_custkey FROM customer)"),
    ('nothing repeals what came after it', "SELECT count(*) AS n FROM orders JOIN customer s ON s.c_custkey = o_custkey JOIN customer t ON t.c_custkey = o_custkey + 40 WHERE o_orderkey % 3 <> 0 AND t.c_custkey % 500 > s.c_custkey % 500"),
    ('no article number joins two norms', "SELECT count(*) AS n FROM (SELECT user_id % 5 AS d, CASE WHEN event_id % 4 = 0 THEN 7 ELSE user_id END AS a FROM events GROUP BY 1, 2 HAVING count(DISTINCT user_id % 50) > 1)")])}
 UNION ALL {union('slice', [
    ('the law has its stages', "SELECT abs(count(*) - 25) AS n FROM nation"), ('foundations resolve', "SELECT count(*) AS n FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey * 3 NOT IN (SELECT p_partkey FROM part)"), ('foundations give reasons', "SELECT count(*) AS n FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 5 = 0"),
    ('stages have articles', "SELECT count(*) AS n FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 1)"), ('stages are of the law in force', "SELECT count(*) AS n FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 9 = 0"), ('the former law is superseded', "SELECT 0 AS n")])}
""")
def verify_currency(spark, d):
    """Repeals, amendments and a law's slice (area 7)."""
    o, k, s = F.col("o_orderkey"), F.col("c_custkey"), F.col("s_suppkey")
    clause = table(spark, d, "orders").select(F.col("o_custkey").alias("src_doc_id"), F.when(o % 3 != 0, F.col("o_custkey") + 40).alias("dst_doc_id"))
    act = table(spark, d, "customer").select(k.alias("doc_id"), F.lpad((k % 500).cast("string"), 3, "0").alias("doc_date"))
    event = table(spark, d, "events").select((F.col("user_id") % 5).alias("doc_id"), F.when(F.col("event_id") % 4 == 0, 7).cast("long").alias("target_article_number"), F.col("user_id").alias("host_article_number"), (F.col("user_id") % 50).alias("norm_id"))
    stage = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("stage_no"))
    item = table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("stage_no"), F.when(s % 2 == 0, "foundation").otherwise("special").alias("layer"), F.when(s % 9 == 0, 1).otherwise(2).alias("doc_id"), F.concat(F.lit("n"), s * 3).alias("cc_norm_id"), F.when(s % 5 != 0, "because").alias("rationale"))
    status = act.select("doc_id", F.when(F.col("doc_id") == 5, "superseded").otherwise("in-force").alias("derived_status"))
    return V.report({"currency": V.currency(clause, act, event), "slice": V.slice_of_law(stage, item, _norms(spark, d), status, 25, 2, 5)})
