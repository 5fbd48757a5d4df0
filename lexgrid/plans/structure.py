"""Queries over trees, ranges, numbers and curated mappings on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display as V
from ..operators import decisions as D
from ..operators import graph as G
from ..operators import structure as S
from ..operators import windows as W
from ..operators.align import positional, reviewed
from ..sources.tables import table
from .catalog import query
from .sequences import tree

TREE = """tree AS (SELECT 'R' || r_regionkey AS node_id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS label FROM region
 UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer)"""


@query(f"""
WITH RECURSIVE {TREE}, t AS (SELECT node_id, label, parent_id, 0 AS up FROM tree WHERE node_id = 'C7' UNION ALL SELECT n.node_id, n.label, n.parent_id, t.up + 1 FROM t JOIN tree n ON n.node_id = t.parent_id)
SELECT node_id, label, CAST(up AS INT) AS up FROM t
""")
def ancestor_chain(spark: SparkSession, d: str) -> DataFrame:
    """One node and all above it, by a bound parameter."""
    return S.ancestors(spark, tree(spark, d), "C7")


@query(f"""
WITH RECURSIVE {TREE}, t AS (SELECT node_id AS node_id, label, parent_id, 0 AS up FROM tree UNION ALL SELECT t.node_id, n.label, n.parent_id, t.up + 1 FROM t JOIN tree n ON n.node_id = t.parent_id)
SELECT node_id, string_agg(label, ' > ' ORDER BY up DESC) AS breadcrumb FROM t GROUP BY 1
""")
def breadcrumb_up(spark, d):
    """Breadcrumbs from the bottom up: every node climbs to its root."""
    return S.breadcrumbs(spark, tree(spark, d))


def _ranges(spark, d) -> DataFrame:
    """Nodes of documents with ranges: customers are chapters of their nation, ranges of ten with now and then a gap or an overlap."""
    k = F.col("c_custkey")
    own = table(spark, d, "customer").select(F.col("c_nationkey").alias("doc_id"), k, F.row_number().over(W.Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("i"))
    a = (F.col("i") - 1) * 10 + 1 + F.when(k % 11 == 0, 2).when(k % 13 == 0, -1).otherwise(0)
    hollow = k % 7 == 0
    return own.select("doc_id", F.concat(F.lit("C"), k).alias("node_id"), F.when(k % 3 == 0, F.concat(F.lit("C"), k - 1)).alias("parent_id"), F.lit("chapter").alias("kind"), F.when(~hollow, a).alias("art_from"), F.when(~hollow, F.col("i") * 10).alias("art_to"))


RANGES = """r0 AS (SELECT c_nationkey AS doc_id, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer),
r AS (SELECT doc_id, 'C' || k AS node_id, CASE WHEN k % 3 = 0 THEN 'C' || (k - 1) END AS parent_id, CASE WHEN k % 7 <> 0 THEN (i - 1) * 10 + 1 + (CASE WHEN k % 11 = 0 THEN 2 WHEN k % 13 = 0 THEN -1 ELSE 0 END) END AS art_from, CASE WHEN k % 7 <> 0 THEN i * 10 END AS art_to FROM r0)"""


@query(f"""
WITH {RANGES}, w AS (SELECT *, lag(art_to) OVER v AS b, row_number() OVER v AS n FROM r WHERE art_from IS NOT NULL WINDOW v AS (PARTITION BY doc_id ORDER BY art_from, art_to, node_id)),
p AS (SELECT doc_id, node_id, CASE WHEN n = 1 AND art_from <> 1 THEN 'start' WHEN art_from <= b THEN 'overlap' WHEN art_from <> b + 1 THEN 'gap' END AS "check", art_from, art_to, b FROM w)
SELECT doc_id, "check", node_id, CASE WHEN "check" = 'gap' THEN (b + 1) || '-' || (art_from - 1) ELSE art_from || '-' || art_to END AS detail FROM p WHERE "check" IS NOT NULL
UNION ALL SELECT doc_id, 'no range', node_id, '' FROM r WHERE art_from IS NULL AND NOT EXISTS (SELECT 1 FROM r c WHERE c.doc_id = r.doc_id AND c.parent_id = r.node_id)
""")
def range_coverage(spark, d):
    """Ranges that overlap, leave gaps, start late, or are missing, in each document by itself."""
    return S.range_problems(_ranges(spark, d))


@query(f"WITH {RANGES}, x AS (SELECT doc_id, node_id, unnest(generate_series(art_from, art_to)) AS n FROM r WHERE art_from IS NOT NULL), u AS (SELECT DISTINCT c_nationkey AS doc_id, c_custkey % 400 AS n FROM customer) SELECT node_id, CAST(count(*) AS BIGINT) AS n_missing, string_agg(CAST(n AS VARCHAR), ', ' ORDER BY n) AS missing FROM x ANTI JOIN u ON u.doc_id = x.doc_id AND u.n = x.n GROUP BY 1")
def missing_per_node(spark, d):
    """What each node's range lacks, node by node."""
    nodes = _ranges(spark, d)
    units = table(spark, d, "customer").select(F.col("c_nationkey").alias("doc_id"), (F.col("c_custkey") % 400).alias("number")).distinct()
    held = nodes.where("art_from IS NOT NULL").select("doc_id", "node_id", F.explode(F.sequence("art_from", "art_to")).alias("number")).join(units, ["doc_id", "number"])
    return S.missing_per_node(nodes, held)


@query("""
SELECT 'R' || r_regionkey AS root, CAST(min(n_nationkey * 10 + 1) AS BIGINT) AS art_from, CAST(max(n_nationkey * 10 + 10) AS BIGINT) AS art_to FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1
""")
def part_ranges(spark, d):
    """What the ranges below each root span."""
    k = F.substring("node_id", 2, 9).cast("long") * 10
    placed = G.paths(spark, tree(spark, d)).select("ids", F.when(F.col("node_id").startswith("N"), k + 1).alias("art_from"), F.when(F.col("node_id").startswith("N"), k + 10).alias("art_to"))
    return S.part_ranges(placed)


@query("""
WITH n AS (SELECT event_id, user_id, 1500 + user_id % 7 * 100 AS hi, CASE WHEN event_id % 3 = 2 THEN (event_id // 30) * 10 + event_id % 9 + 1 ELSE event_id // 3 + 1 END AS num FROM events),
b AS (SELECT *, max(CASE WHEN num <= hi THEN num END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior, max(CASE WHEN num <= hi THEN num END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base FROM n),
s AS (SELECT *, num <= hi AND (prior IS NULL OR num > prior) AS is_base FROM b), t AS (SELECT *, CASE WHEN NOT is_base AND starts_with(CAST(num AS VARCHAR), CAST(base AS VARCHAR)) THEN nullif(substr(CAST(num AS VARCHAR), length(CAST(base AS VARCHAR)) + 1), '') END AS tail FROM s)
SELECT event_id, num, base, TRY_CAST(tail AS INT) AS superscript, NOT is_base AND tail IS NULL AS unresolved FROM t
""")
def superscripts_by_part(spark, d):
    """Numbers that are bases within their own part's range, superscripts of the base before them, or neither."""
    i = F.col("event_id")
    n = table(spark, d, "events").select("event_id", "user_id", F.when(i % 3 == 2, F.floor(i / 30) * 10 + i % 9 + 1).otherwise(F.floor(i / 3) + 1).alias("num"))
    parts = table(spark, d, "events").select("user_id").distinct().select("user_id", (F.col("user_id") % 7 * 100 + 1500).alias("hi"))
    out = W.running_base(n.join(parts, "user_id"), ["user_id"], ["event_id"], F.col("num"), F.col("num") <= F.col("hi"))
    tail, unresolved = S.superscript(F.col("num"), F.col("base"), F.col("is_base"))
    return out.select("event_id", "num", "base", tail.alias("superscript"), unresolved.alias("unresolved"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey, o_custkey) AS edge_id FROM orders")
def edge_ids(spark, d):
    """Gapless ids in a given order without a global sort of rows."""
    return S.numbered(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", ["o_custkey"], "edge_id").select("o_orderkey", "edge_id")


@query("""
SELECT p_partkey, row_number() OVER (PARTITION BY p_size ORDER BY TRY_CAST(k AS INT) NULLS LAST, k) AS place FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 10 = 0 THEN 'x' || p_partkey ELSE CAST(p_partkey * 37 % 1000 AS VARCHAR) || CASE WHEN p_partkey % 10 = 1 THEN '-1' ELSE '' END END || '' AS k FROM part)
""")
def numeric_order(spark, d):
    """Rows in the order of a written number, those without one last; of one text by p_partkey, where the SQL leaves the order open."""
    k = F.col("p_partkey")
    text = F.when(k % 10 == 0, F.concat(F.lit("x"), k)).otherwise(F.concat(k * 37 % 1000, F.when(k % 10 == 1, "-1").otherwise("")))
    w = W.Window.partitionBy("p_size").orderBy(S.by_number(F.col("k")), "k", "p_partkey")
    return table(spark, d, "part").select("p_partkey", "p_size", text.alias("k")).select("p_partkey", F.row_number().over(w).cast("long").alias("place"))


@query("""
SELECT p_brand, p_type, p_partkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_size % 5 = 0, p_retailprice DESC NULLS LAST, p_partkey) AS rank FROM part) WHERE rank <= 3
""")
def status_first(spark, d):
    """The first three of each kind: those in force before others, then by weight, nulls last."""
    ranked = W.Window.partitionBy("p_type").orderBy(F.col("p_size") % 5 == 0, F.col("p_retailprice").desc_nulls_last(), "p_partkey")
    return table(spark, d, "part").withColumn("rank", F.row_number().over(ranked).cast("long")).where("rank <= 3").select("p_brand", "p_type", "p_partkey", "rank")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderpriority IN ('1-URGENT', '3-MEDIUM')")
def bound_parameters(spark, d):
    """A query with bound parameters, lists among them, and a condition that a switch turns off."""
    rows = table(spark, d, "orders").where(V.unless(False, F.col("o_orderstatus") != "F"))
    return spark.sql(
        "SELECT o_orderkey, o_orderstatus FROM {rows} WHERE o_totalprice BETWEEN :low AND :high AND array_contains(:kinds, o_orderpriority)",
        args={"low": 1000, "high": 200000, "kinds": F.array(F.lit("1-URGENT"), F.lit("3-MEDIUM"))}, rows=rows,
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Article ' || substr(CAST(o_custkey AS VARCHAR), 1, length(CAST(o_custkey AS VARCHAR)) - 1) || translate(right(CAST(o_custkey AS VARCHAR), 1), '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') WHEN o_orderkey % 3 = 1 THEN 'Article ' || o_custkey ELSE 'Section ' || o_custkey END AS shown,
 CASE WHEN o_totalprice / 600000 >= 0.9 THEN 'high' WHEN o_totalprice / 600000 >= 0.8 THEN 'middle' ELSE 'low' END AS badge, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS age_days,
 CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') / 365.25 >= 3 THEN 'old' ELSE '' END AS note,
 ['normative', 'editorial', 'amendment'][CAST(o_orderkey % 3 + 1 AS INT)] AS evidence_kind FROM orders WHERE o_custkey % 10 <> 0
""")
def display(spark, d):
    """Numbers with raised superscripts, badges, ages and kinds of evidence. A number's superscript isn't 0."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    day, today = F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("2000-01-01")
    note = V.snapshot_note(F.when(k % 10 == 0, "not a date").otherwise(day), today)
    field = F.element_at(F.array(*map(F.lit, ("article_text", "cross_references", "amendment_note"))), (k % 3 + 1).cast("int"))
    return table(spark, d, "orders").where("o_custkey % 10 <> 0").select(
        "o_orderkey", V.display_number(c, F.when(k % 3 == 0, F.right(c, F.lit(1)).cast("int")), F.when(k % 3 == 2, F.concat(F.lit("Section "), c))).alias("shown"),
        V.badge(F.col("o_totalprice") / 600000).alias("badge"), V.days_between(day, today).alias("age_days"), F.when(note.startswith("snapshot of"), "old").otherwise("").alias("note"), V.evidence_kind(field).alias("evidence_kind"),
    )


@query("""
WITH m AS (SELECT c_custkey % 30 AS k, 'R' || (c_custkey % 7) AS r, c_custkey FROM customer)
SELECT 'unknown left' AS "check", CAST(k AS VARCHAR) AS n_nationkey, r AS region_id FROM m WHERE k NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'unknown right', CAST(k AS VARCHAR), r FROM m WHERE r NOT IN (SELECT 'R' || r_regionkey FROM region)
UNION ALL SELECT 'repeated', CAST(k AS VARCHAR), r FROM m GROUP BY k, r HAVING count(*) > 1
UNION ALL SELECT 'no reason', CAST(k AS VARCHAR), r FROM m WHERE c_custkey % 4 = 0
""")
def curated_mapping(spark, d):
    """A curated mapping held against both of its sides."""
    k = F.col("c_custkey")
    mapping = table(spark, d, "customer").select((k % 30).alias("n_nationkey"), F.concat(F.lit("R"), k % 7).alias("region_id"), F.when(k % 4 > 0, "because").alias("rationale"))
    region = table(spark, d, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("region_id"))
    return S.mapping_problems(mapping, table(spark, d, "nation"), region, "n_nationkey", "region_id", "rationale")


@query("""
WITH c AS (SELECT DISTINCT substr(lpad(CAST(p_partkey % 97 AS VARCHAR), 2, '0'), 1, 2) || '.' || lpad(CAST(p_size % 4 AS VARCHAR), 2, '0') || '.' || lpad(CAST(p_partkey % 3 AS VARCHAR), 2, '0') || '.00' AS code FROM part)
SELECT c.code, k.code AS level2 FROM c LEFT JOIN c k ON k.code = substr(c.code, 1, 5) || '.00.00' AND substr(c.code, 4, 2) <> '00'
""")
def prefix_rollup(spark, d):
    """Codes with the code of their second level, where that exists: a join on a computed prefix."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    codes = table(spark, d, "part").select(F.concat_ws(".", two(F.col("p_partkey") % 97), two(F.col("p_size") % 4), two(F.col("p_partkey") % 3), F.lit("00")).alias("code")).distinct()
    at = F.concat(F.substring("code", 1, 5), F.lit(".00.00"))
    second = codes.where((F.col("code") == at) & (F.substring("code", 4, 2) != "00")).select(F.col("code").alias("level2"))
    return codes.withColumn("level2", at).join(second.withColumn("_known", F.lit(True)), "level2", "left").select("code", F.when(F.col("_known"), F.col("level2")).alias("level2"))


@query("SELECT p_partkey AS node_id, p_size * 5 AS target FROM part WHERE p_size * 5 NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT p_partkey, p_partkey * 2 FROM part WHERE p_partkey * 2 NOT IN (SELECT p_partkey FROM part)")
def dangling_references(spark, d):
    """References of nodes to nodes that aren't there."""
    k = F.col("p_partkey").cast("long")
    return G.dangling(table(spark, d, "part").select(k.alias("node_id"), F.array((F.col("p_size") * 5).cast("long"), k * 2).alias("see_also")))


@query("""
WITH a AS (SELECT c_custkey // 2 AS k, c_custkey, row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey) AS occ, count(*) OVER (PARTITION BY c_custkey // 2) AS t FROM customer),
b AS (SELECT s_suppkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY s_suppkey) AS occ, count(*) OVER (PARTITION BY s_suppkey) AS t FROM supplier),
ta AS (SELECT DISTINCT k, t FROM a), tb AS (SELECT DISTINCT k, t FROM b),
j AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.occ, b.occ) AS occurrence, a.k IS NOT NULL AS ina, b.k IS NOT NULL AS inb FROM a FULL JOIN b ON a.k = b.k AND a.occ = b.occ),
s AS (SELECT j.*, CASE WHEN ina AND inb THEN 'aligned' WHEN ina THEN (CASE WHEN tb.t IS NULL THEN 'left_only' ELSE 'left_only_occurrence' END) ELSE (CASE WHEN ta.t IS NULL THEN 'right_only' ELSE 'right_only_occurrence' END) END AS st, ta.t = 1 AND tb.t = 1 AS one FROM j LEFT JOIN ta ON ta.k = j.k LEFT JOIN tb ON tb.k = j.k)
SELECT k, CAST(occurrence AS BIGINT) AS occurrence, CASE WHEN k % 50 = 7 THEN 'suspect' ELSE st END AS status,
 CASE WHEN k % 50 = 7 THEN 'override' WHEN st <> 'aligned' THEN st WHEN NOT coalesce(one, false) THEN 'review_ambiguous_key' WHEN k % 4 = 1 THEN 'review_superscript' END AS report FROM s
""")
def alignment_review(spark, d):
    """What of an alignment a person must look at: rows that stand alone, ambiguous keys, superscripts, and decisions already made."""
    k = F.floor(F.col("c_custkey") / 2).alias("k")
    a, b = table(spark, d, "customer").select(k, "c_custkey"), table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("k"), "s_suppkey")
    both = a.select("k").unionByName(b.select("k")).where("k % 50 = 7").distinct()
    aligned = positional(a, b, "k", ["c_custkey"], ["s_suppkey"]).withColumn("superscript", F.when(F.col("k") % 4 == 1, 1))
    out = reviewed(aligned, both.select("k", F.lit("suspect").alias("status")), "k", "superscript")
    return out.select("k", F.col("occurrence").cast("long").alias("occurrence"), "status", "report")


@query("""
WITH a AS (SELECT c_custkey AS id, 'K' || (c_custkey % 90) AS code, (c_custkey % 100) / 100.0 AS conf FROM customer),
l AS (SELECT user_id AS id, event_type AS kind, ts, event_id, 'N' || (event_id % 9) AS code FROM events WHERE event_type IN ('purchase', 'click', 'view', 'signup')),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS n FROM l), b AS (SELECT max(ts) AS bulk FROM events WHERE event_id % 997 = 0)
SELECT a.id AS assignment_id, CASE WHEN kind = 'click' THEN r.code ELSE a.code END AS code, CAST(CASE WHEN kind = 'click' THEN 1.0 ELSE conf END AS DOUBLE) AS confidence,
 CASE WHEN kind = 'click' THEN 'override' WHEN kind = 'purchase' THEN 'approved' WHEN conf >= 0.9 AND bulk IS NOT NULL AND (kind IS NULL OR ts < bulk) THEN 'approved' WHEN kind IN ('view', 'signup') THEN 'withdrawn' ELSE 'pending' END AS status
FROM a LEFT JOIN r ON r.id = a.id AND n = 1 CROSS JOIN b
""")
def validation_state(spark, d):
    """Assignments after a log of decisions: approved, withdrawn, mapped anew, or approved in bulk for their confidence."""
    k = F.col("c_custkey")
    assigned = table(spark, d, "customer").select(k.alias("assignment_id"), F.concat(F.lit("K"), k % 90).alias("code"), ((k % 100) / 100).alias("confidence"))
    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "approve").when(F.col("event_type") == "click", "remap").when(F.col("event_type").isin("view", "signup"), "withdraw")
    log = e.select(F.col("user_id").alias("assignment_id"), kind.alias("kind"), F.concat(F.lit("N"), F.col("event_id") % 9).alias("new_code"), F.col("ts").alias("decided_at"), F.col("event_id").alias("decision_id")).where("kind IS NOT NULL")
    bulk = e.where("event_id % 997 = 0").select(F.lit(None).cast("long").alias("assignment_id"), F.lit("bulk").alias("kind"), F.lit(None).cast("string").alias("new_code"), F.col("ts").alias("decided_at"), F.col("event_id").alias("decision_id"))
    return D.current(assigned, log.unionByName(bulk))
