"""Relational queries: acts, pyramids, drift, joins, aggregates, windows and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import hierarchy, tier
from ..operators.amending import bodies
from ..operators.events import mentions
from ..operators.structure import containing
from ..sources.tables import parts, table
from .catalog import query


@query("""
SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS tier, p_partkey, count(*) AS n_citations,
       count(DISTINCT l_orderkey) AS n_acts, max(o_orderdate) AS last_date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2
""")
def pyramid(spark: SparkSession, d: str) -> DataFrame:
    """Citations and citing acts of each norm by tier.

    Both sides are dealt by act over as many tasks as the table needs, and counted there once for each act, tier and
    norm, so acts are told apart before norms meet and no task keeps more than its share of either.
    """
    lineitem, orders, part = (table(spark, d, t) for t in ("lineitem", "orders", "part"))
    n = parts(lineitem, 6 << 20)
    cited = lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")).repartition(n, "l_orderkey").groupBy("l_orderkey", "p_partkey").agg(F.count("*").alias("n"))
    acts = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), "o_orderdate").repartition(n, "l_orderkey")
    acts = acts.groupBy("l_orderkey", "tier").agg(F.count("*").alias("m"), F.max("o_orderdate").alias("last"))
    found = cited.join(acts, "l_orderkey").groupBy("tier", "p_partkey").agg(F.sum(F.col("n") * F.col("m")).alias("n_citations"), F.count("*").alias("n_acts"), F.max("last").alias("last_date"))
    return found.join(part.select("p_partkey"), "p_partkey", "left_semi").select("tier", "p_partkey", "n_citations", "n_acts", "last_date")


def _t(spark: SparkSession, d: str, *names: str):
    found = [table(spark, d, n) for n in names]
    return found[0] if len(found) == 1 else found


@query("""
SELECT o_custkey AS doc_id, arg_min(o_orderstatus, o_orderkey) AS status, arg_min(o_orderpriority, o_orderkey) AS doc_type,
       CAST(count(*) AS BIGINT) AS n_articles, CASE WHEN arg_min(o_orderpriority, o_orderkey) LIKE '5%' THEN 9
       ELSE CAST(substr(arg_min(o_orderpriority, o_orderkey), 1, 1) AS INT) END AS tier
FROM orders GROUP BY o_custkey
""")
def act_rollup(spark, d):
    """Rows to acts: the first row's attributes by row key (deterministic, and combined before the shuffle)."""
    acts = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("doc_id")).agg(
        F.min_by("o_orderstatus", "o_orderkey").alias("status"), F.min_by("o_orderpriority", "o_orderkey").alias("doc_type"), F.count("*").alias("n_articles")
    )
    return acts.withColumn("tier", F.when(F.col("doc_type").startswith("5"), 9).otherwise(F.substring("doc_type", 1, 1).cast("int")))


@query("""
SELECT p_partkey, CAST(CASE WHEN k = 0 AND NOT regexp_matches(p_name, '^(red|blue)') THEN 9 WHEN k = 6 THEN 9 ELSE k + 1 END AS BIGINT) AS tier,
       CASE WHEN k <> 0 THEN NULL WHEN regexp_matches(p_name, '^(red|blue)') THEN 'kept' ELSE 'retiered' END AS tier_note
FROM (SELECT *, p_partkey % 7 AS k FROM part)
""")
def retier_override(spark, d):
    """A tier with its override and the reason for it, computed in the projection."""
    kind = F.element_at(F.array(*map(F.lit, ("constitution", "code", "law", "decree", "resolution", "order", "letter"))), (F.col("p_partkey") % 7 + 1).cast("int"))
    odd, named = F.col("kind") == "constitution", F.col("p_name").rlike("^(red|blue)")
    return _t(spark, d, "part").withColumn("kind", kind).select(
        "p_partkey", F.when(odd & ~named, 9).otherwise(tier(F.col("kind"))).cast("long").alias("tier"), F.when(~odd, F.lit(None)).when(named, "kept").otherwise("retiered").alias("tier_note")
    )


@query("""
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE o_orderpriority IS DISTINCT FROM '1-URGENT') AS BIGINT) AS n_drift
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1) ON o_custkey = c_custkey
GROUP BY 1
""")
def null_safe_drift(spark, d):
    """Rows whose derived value differs from the expected one, an absent value counting as different."""
    customer, orders = _t(spark, d, "customer", "orders")
    first = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("p"))
    return customer.join(first, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(~F.col("p").eqNullSafe("1-URGENT")).alias("n_drift"))


@query("""
SELECT c_custkey, c_acctbal BETWEEN 0 AND 5000 AS in_range, c_name ILIKE '%000001%' AS named, c_mktsegment IN ('BUILDING','MACHINERY') AS listed,
       c_nationkey = ANY([1, 3, 5]) AS member
FROM customer WHERE c_acctbal NOT BETWEEN 9000 AND 9500 AND c_name NOT LIKE '%9'
""")
def predicates(spark, d):
    """Range, pattern, list and array membership; the filters reach the scan."""
    kept = _t(spark, d, "customer").where(~F.col("c_acctbal").between(9000, 9500) & ~F.col("c_name").like("%9"))
    return kept.select(
        "c_custkey", F.col("c_acctbal").between(0, 5000).alias("in_range"), F.col("c_name").ilike("%000001%").alias("named"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("listed"), F.array_contains(F.array(*map(F.lit, (1, 3, 5))), F.col("c_nationkey")).alias("member"),
    )


@query("""
SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS BIGINT) AS n_blank,
       CAST(count(*) FILTER (WHERE length(text) >= 2000) AS BIGINT) AS n_long
FROM documents GROUP BY lang
""")
def blob_flag(spark, d):
    """Blank and whole-act texts by language."""
    return _t(spark, d, "documents").groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("n_blank"), F.count_if(F.length("text") >= 2000).alias("n_long")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(base * CASE WHEN l_discount > 0.05 THEN 0.95 ELSE 1 END,
       CASE WHEN l_tax > 0.05 THEN (CASE WHEN l_returnflag = 'R' THEN 0.85 ELSE 0.6 END) ELSE 1 END), 3) AS confidence
FROM lineitem JOIN (VALUES ('A','F',0.95::DOUBLE),('A','O',0.8::DOUBLE),('N','F',0.75::DOUBLE),('N','O',0.9::DOUBLE),('R','F',0.85::DOUBLE),('R','O',0.7::DOUBLE)) t(f,s,base)
  ON f = l_returnflag AND s = l_linestatus
""")
def confidence(spark, d):
    """A base by two keys, lowered for aliases and capped for ambiguous targets. The cells are a literal map: no join."""
    base = {("A", "F"): 0.95, ("A", "O"): 0.8, ("N", "F"): 0.75, ("N", "O"): 0.9, ("R", "F"): 0.85, ("R", "O"): 0.7}
    cells = F.create_map(*[F.lit(x) for (f, s), v in base.items() for x in (f + s, v)])
    value = F.element_at(cells, F.concat("l_returnflag", "l_linestatus")) * F.when(F.col("l_discount") > 0.05, 0.95).otherwise(1.0)
    cap = F.when(F.col("l_tax") > 0.05, F.when(F.col("l_returnflag") == "R", 0.85).otherwise(0.6)).otherwise(1.0)
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.least(value, cap), 3).alias("confidence"))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 'internal' WHEN CAST(substr(o_orderpriority,1,1) AS INT) = 9 THEN 'unknown'
       WHEN CAST(substr(o_orderpriority,1,1) AS INT) > 2 THEN 'below' WHEN CAST(substr(o_orderpriority,1,1) AS INT) = 2 THEN 'same' ELSE 'above' END AS hierarchy_rel
FROM orders
""")
def hierarchy_rel(spark, d):
    """Where a citing act stands to the cited one."""
    src = F.substring("o_orderpriority", 1, 1).cast("int")
    return _t(spark, d, "orders").select("o_orderkey", hierarchy(src, F.lit(2), F.col("o_custkey") % 10 == 0).alias("hierarchy_rel"))


@query("""
SELECT s_suppkey, c_custkey, ns.n_name AS supplier_nation, nc.n_name AS customer_nation
FROM supplier JOIN customer ON s_suppkey = c_custkey JOIN nation ns ON ns.n_nationkey = s_nationkey JOIN nation nc ON nc.n_nationkey = c_nationkey
""")
def dim_two_roles(spark, d):
    """One dimension joined in two roles."""
    supplier, customer, nation = _t(spark, d, "supplier", "customer", "nation")
    role = lambda key, name: nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
    both = supplier.join(customer, supplier.s_suppkey == customer.c_custkey)
    return both.join(role("s_nationkey", "supplier_nation"), "s_nationkey").join(role("c_nationkey", "customer_nation"), "c_nationkey").select("s_suppkey", "c_custkey", "supplier_nation", "customer_nation")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_in(spark, d):
    customer, orders = _t(spark, d, "customer", "orders")
    return customer.join(orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_not_exists(spark, d):
    customer, orders = _t(spark, d, "customer", "orders")
    return customer.join(orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) ON l_partkey = p_partkey WHERE l_partkey IS NULL")
def anti_left_null(spark, d):
    part, lineitem = _t(spark, d, "part", "lineitem")
    return part.join(lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti").select("p_partkey", "p_name")


@query("""
SELECT a.l_returnflag, CAST(count(*) > 0 AS BOOLEAN) AS violated FROM
 (SELECT l_returnflag, min(l_quantity) q FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) a JOIN
 (SELECT l_returnflag, max(l_quantity) q FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) b ON a.l_returnflag = b.l_returnflag AND a.q < b.q GROUP BY 1
""")
def theta_minmax(spark, d):
    """Whether any pair of a group violates an order: its least against its greatest, not all pairs."""
    q = F.col("l_quantity")
    ends = _t(spark, d, "lineitem").groupBy("l_returnflag").agg(F.min(F.when(F.col("l_linestatus") == "O", q)).alias("low"), F.max(F.when(F.col("l_linestatus") == "F", q)).alias("high"))
    return ends.where("low < high").select("l_returnflag", F.lit(True).alias("violated"))


@query("""
SELECT n_name, CAST(count(p_partkey) AS BIGINT) AS n_parts, substr(n_name, 1, 7) || '0.00' AS parent_code
FROM nation LEFT JOIN part ON regexp_extract(p_brand, '(\\d+)$', 1) = CAST(n_nationkey AS VARCHAR) GROUP BY 1, 3
""")
def computed_key_join(spark, d):
    """A join on a key taken out of text; parts are counted by it first."""
    nation, part = _t(spark, d, "nation", "part")
    counts = part.groupBy(F.regexp_extract("p_brand", r"(\d+)$", 1).alias("k")).agg(F.count("p_partkey").alias("n"))
    joined = nation.join(counts, F.col("n_nationkey").cast("string") == F.col("k"), "left")
    return joined.select("n_name", F.coalesce("n", F.lit(0)).alias("n_parts"), F.concat(F.substring("n_name", 1, 7), F.lit("0.00")).alias("parent_code"))


@query("""
SELECT p_brand, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders, CAST(count(*) AS BIGINT) AS n_rows
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'O' GROUP BY 1
""")
def fanout_distinct(spark, d):
    """A join that multiplies rows, and the distinct count that undoes it."""
    orders, lineitem, part = _t(spark, d, "orders", "lineitem", "part")
    some = lineitem.join(orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    return some.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").groupBy("p_brand").agg(F.countDistinct("l_orderkey").alias("n_orders"), F.count("*").alias("n_rows"))


@query("SELECT p_partkey, n_nationkey AS node FROM part LEFT JOIN nation ON p_size BETWEEN n_nationkey * 2 + 1 AND n_nationkey * 2 + 2 - n_nationkey % 2")
def range_containment(spark, d):
    """Points in intervals of a table, some of which hold fewer points than others."""
    nation, part = _t(spark, d, "nation", "part")
    k = F.col("n_nationkey")
    nodes = nation.select(k.alias("node"), (k * 2 + 1).alias("low"), (k * 2 + 2 - k % 2).alias("high"))
    return containing(part.select("p_partkey", "p_size"), nodes, "p_size", "low", "high").select("p_partkey", "node")


@query("SELECT c_mktsegment, CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) AS n_debt, CAST(count(DISTINCT c_nationkey) FILTER (WHERE c_acctbal > 5000) AS BIGINT) AS n_rich_nations, CAST(count(DISTINCT CASE WHEN c_acctbal < 1000 THEN c_nationkey END) AS BIGINT) AS n_poor_nations FROM customer GROUP BY 1")
def filter_aggs(spark, d):
    on = lambda c: F.countDistinct(F.when(c, F.col("c_nationkey")))
    return _t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count_if(F.col("c_acctbal") < 0).alias("n_debt"), on(F.col("c_acctbal") > 5000).alias("n_rich_nations"), on(F.col("c_acctbal") < 1000).alias("n_poor_nations"))


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, max(ts) AS last_ts, arg_max(event_type, ts) AS last_type, bool_or(event_type = 'error') AS any_error FROM events GROUP BY 1")
def argmax_latest(spark, d):
    """The latest state of each key, ties to the smaller id."""
    return _t(spark, d, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("ts").alias("last_ts"), F.max_by("event_type", F.struct("ts", -F.col("event_id"))).alias("last_type"), F.bool_or(F.col("event_type") == "error").alias("any_error")
    )


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS keys FROM orders GROUP BY 1")
def ordered_stragg(spark, d):
    _t(spark, d, "orders").createOrReplaceTempView("lexgrid_orders")
    return spark.sql("SELECT o_custkey, listagg(CAST(o_orderkey AS STRING), ' ') WITHIN GROUP (ORDER BY o_orderkey) AS keys FROM lexgrid_orders GROUP BY o_custkey")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def distinct_stragg(spark, d):
    return _t(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ", ").alias("priorities"))


@query("SELECT p_name, p_brand, CAST(count(DISTINCT p_partkey) AS BIGINT) AS n FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_partkey) > 1")
def ambiguous_keys(spark, d):
    return _t(spark, d, "part").groupBy("p_name", "p_brand").agg(F.countDistinct("p_partkey").alias("n")).where("n > 1")


@query("SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS n_cited, (SELECT max(c_acctbal) FROM customer) AS top_balance, (SELECT count(*) FROM nation) AS n_nations")
def scalar_multi(spark, d):
    """Aggregates of several tables in one row, as scalar subqueries."""
    orders, lineitem, customer, nation = _t(spark, d, "orders", "lineitem", "customer", "nation")
    one = spark.range(1)
    return one.select(
        orders.agg(F.count("*")).scalar().alias("n_orders"), lineitem.agg(F.countDistinct("l_partkey")).scalar().alias("n_cited"),
        customer.agg(F.max("c_acctbal")).scalar().alias("top_balance"), nation.agg(F.count("*")).scalar().alias("n_nations"),
    )


@query("""
SELECT r_regionkey, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n_units,
       coalesce((SELECT min(n_nationkey) FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey > 22), (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = r_regionkey)) AS art_from FROM region
""")
def corr_scalar(spark, d):
    """A node's own range, else its children's: both from one grouped pass over the children."""
    region, nation = _t(spark, d, "region", "nation")
    k = F.col("n_nationkey")
    kids = nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("n"), F.coalesce(F.min(F.when(k > 22, k)), F.min(k)).alias("art_from"))
    return region.join(kids, "r_regionkey", "left").select("r_regionkey", F.coalesce("n", F.lit(0)).alias("n_units"), "art_from")


@query("SELECT o_custkey, max(o_orderpriority) AS top, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n FROM orders GROUP BY 1")
def sets_per_key(spark, d):
    s = _t(spark, d, "orders").groupBy("o_custkey").agg(F.array_max(F.collect_set("o_orderpriority")).alias("top"), F.collect_set("o_orderstatus").alias("s"))
    return s.select("o_custkey", "top", F.array_join(F.array_sort("s"), ",").alias("statuses"), F.size("s").cast("long").alias("n"))


@query("SELECT conv_id AS doc_id, string_agg(text, ' ' ORDER BY turn, text) AS body FROM conversations WHERE text IS NOT NULL GROUP BY 1")
def doc_reassembly(spark, d):
    """Chunks of a document put together in order."""
    return bodies(_t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("row_id"), F.col("text").alias("article_text")))


@query("""
SELECT o_custkey AS doc_id, 'cites' AS route, CAST(count(*) AS BIGINT) AS n_hits, CAST(min(o_orderkey) AS VARCHAR) AS evidence FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1
UNION ALL SELECT doc_id, 'names', CAST(count(*) AS BIGINT), list(ev ORDER BY turn, ev)[1] FROM (SELECT conv_id AS doc_id, turn,
 trim(regexp_replace(substr(text, greatest(p - 110, 1), p + length(m) + 110 - greatest(p - 110, 1)), '\\s+', ' ', 'g')) AS ev FROM
 (SELECT *, strpos(text, m) AS p FROM (SELECT *, regexp_extract(text, 'th[ae]n +\\w+', 0) AS m FROM conversations WHERE regexp_matches(text, 'th[ae]n +\\w+')))) GROUP BY 1
""")
def two_route_union(spark, d):
    """Acts that come in by citation and acts that come in by name, with where they are named first."""
    orders, turns = _t(spark, d, "orders", "conversations")
    cites = orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("doc_id")).agg(F.lit("cites").alias("route"), F.count("*").alias("n_hits"), F.min("o_orderkey").cast("string").alias("evidence"))
    named = mentions(turns.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("row_id"), "text"), r"th[ae]n +\w+")
    return cites.unionByName(named.select("doc_id", F.lit("names").alias("route"), "n_hits", "evidence"))


@query("SELECT p_partkey, p_name, CAST(n AS BIGINT) AS n FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) JOIN part ON p_partkey = l_partkey ORDER BY n DESC, p_partkey LIMIT 15")
def top_cited(spark, d):
    """The most cited norms."""
    lineitem, part = _t(spark, d, "lineitem", "part")
    n = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return n.join(part, "p_partkey").orderBy(F.desc("n"), "p_partkey").limit(15).select("p_partkey", "p_name", "n")


@query("SELECT CAST(l_partkey AS INT) AS k FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT CAST(p_partkey AS INT) FROM part WHERE p_size > 10")
def set_difference(spark, d):
    lineitem, part = _t(spark, d, "lineitem", "part")
    return lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").cast("int").alias("k")).distinct().join(part.where("p_size > 10").select(F.col("p_partkey").cast("int").alias("k")), "k", "left_anti")
