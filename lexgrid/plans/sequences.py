"""Queries over order: occurrences, bases, carried context, spans, trees and closures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.graph import closure_of, paths
from ..sources.tables import table
from .catalog import query

REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {REST}) AS occurrence,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS total FROM lineitem
""")
def occurrence(spark: SparkSession, d: str) -> DataFrame:
    """Which of the rows with its key a row is, and of how many."""
    out = W.occurrence(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], REST.split(", "))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("occurrence").cast("long").alias("occurrence"), "total")


@query("""
SELECT event_id, user_id, event_type, CASE WHEN event_type = 'purchase' THEN last_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS last_value_,
       last_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) = event_type AS is_current FROM events
""")
def latest_status(spark, d):
    """Each event beside its key's latest state."""
    e, order = table(spark, d, "events"), ["ts", "event_id"]
    both = W.latest(W.latest(e, ["user_id"], order, F.col("value"), "v"), ["user_id"], order, F.col("event_type"), "t")
    return both.select("event_id", "user_id", "event_type", F.when(F.col("event_type") == "purchase", F.col("v")).alias("last_value_"), (F.col("t") == F.col("event_type")).alias("is_current"))


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def top1_qualify(spark, d):
    return W.top1(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("""
SELECT event_id, user_id, value BETWEEN 5 AND 60 AND (prior IS NULL OR value > prior) AS is_base, base FROM
 (SELECT *, max(CASE WHEN value BETWEEN 5 AND 60 THEN value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior,
         max(CASE WHEN value BETWEEN 5 AND 60 THEN value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base FROM events)
""")
def running_base(spark, d):
    """Which numbers begin a new base in order, and which base the others belong to."""
    return W.running_base(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value"), F.col("value").between(5, 60)).select("event_id", "user_id", "is_base", "base")


@query("""
SELECT conv_id, turn, role, count(*) AS n, last_value(CASE WHEN role = 'user' THEN len END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, len ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked_len
FROM (SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS len FROM conversations) GROUP BY conv_id, turn, role, len
""")
def carry_forward(spark, d):
    """The last question's length on each turn."""
    c = table(spark, d, "conversations").groupBy("conv_id", "turn", "role", F.length("text").cast("long").alias("len")).agg(F.count("*").alias("n"))
    return W.carry(c, ["conv_id"], ["turn", "role", "len"], asked_len=F.when(F.col("role") == "user", F.col("len"))).select("conv_id", "turn", "role", "n", "asked_len")


@query("""
SELECT event_id, user_id, lead(ts) OVER w AS next_ts, lead(value) OVER w < value AS falls, lag(event_type) OVER w = event_type AS repeats FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def lead_spans(spark, d):
    """Where each section ends, and how it meets its neighbours."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", "user_id", F.lead("ts").over(w).alias("next_ts"), (F.lead("value").over(w) < F.col("value")).alias("falls"), (F.lag("event_type").over(w) == F.col("event_type")).alias("repeats"))


@query("SELECT CAST(i AS BIGINT) AS missing FROM range(0, (SELECT max(l_partkey) + 1 FROM lineitem)) r(i) WHERE i NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def missing_in_range(spark, d):
    """The numbers of a range that are absent."""
    lineitem = table(spark, d, "lineitem")
    every = lineitem.agg(F.max("l_partkey").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("missing"))
    return every.join(lineitem.where("l_quantity > 40").select(F.col("l_partkey").alias("missing")), "missing", "left_anti")


@query("""
WITH RECURSIVE t AS (SELECT 'R' || r_regionkey AS node_id, r_name AS path, 0 AS depth FROM region
  UNION ALL SELECT k.node_id, t.path || ' > ' || k.label, t.depth + 1 FROM t JOIN (SELECT 'N' || n_nationkey AS node_id, n_name AS label, 'R' || n_regionkey AS parent FROM nation
  UNION ALL SELECT 'C' || c_custkey, c_name, 'N' || c_nationkey FROM customer) k ON k.parent = t.node_id)
SELECT node_id, path, CAST(depth AS INT) AS depth FROM t
""")
def tree_breadcrumb(spark, d):
    """Root-to-node paths."""
    return paths(spark, tree(spark, d)).select("node_id", F.array_join("labels", " > ").alias("path"), F.col("depth").cast("int").alias("depth"))


def tree(spark, d) -> DataFrame:
    """(node_id, parent_id, label) of regions, nations and customers."""
    region, nation, customer = (table(spark, d, t) for t in ("region", "nation", "customer"))
    node = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    a = region.select(node("R", "r_regionkey").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("label"))
    b = nation.select(node("N", "n_nationkey"), node("R", "n_regionkey"), "n_name")
    return a.union(b).union(customer.select(node("C", "c_custkey"), node("N", "c_nationkey"), "c_name"))


@query("""
SELECT 'R' || r_regionkey AS ancestor, CAST(count(DISTINCT n_nationkey) + count(DISTINCT c_custkey) AS BIGINT) AS n_below, CAST(min(c_custkey) AS BIGINT) AS first_unit
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1
""")
def ancestor_rollup(spark, d):
    """What lies below each root."""
    p = paths(spark, tree(spark, d)).where("depth > 0").withColumn("ancestor", F.element_at("ids", 1))
    unit = F.when(F.col("node_id").startswith("C"), F.substring("node_id", 2, 12).cast("long"))
    return p.groupBy("ancestor").agg(F.count("*").alias("n_below"), F.min(unit).alias("first_unit"))


@query("""
SELECT node_id, row_number() OVER (ORDER BY f, depth, node_id) AS place FROM (
 SELECT 'R' || r_regionkey AS node_id, 0 AS depth, coalesce(min(c_custkey), 10000) AS f FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1
 UNION ALL SELECT 'N' || n_nationkey, 1, coalesce(min(c_custkey), 10000) FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
""")
def tree_order(spark, d):
    """Inner nodes in the order of the first unit below them."""
    p = paths(spark, tree(spark, d))
    unit = F.when(F.col("node_id").startswith("C"), F.substring("node_id", 2, 12).cast("long"))
    first = p.select(F.explode("ids").alias("node_id"), unit.alias("u")).groupBy("node_id").agg(F.coalesce(F.min("u"), F.lit(10000)).alias("f"))
    inner = p.where("depth < 2").select("node_id", "depth").join(first, "node_id")
    return inner.select("node_id", F.row_number().over(Window.orderBy("f", "depth", "node_id")).cast("long").alias("place"))  # a few nodes


@query("""
WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 7 + 3) % 25 AS b FROM nation UNION ALL SELECT n_nationkey, n_nationkey // 2 FROM nation),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a)
SELECT CAST(a AS INT) AS src, CAST(b AS INT) AS dst FROM c WHERE a < 8
""")
def closure(spark, d):
    """What can be reached from some nodes, to the fixed point."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("a"))
    e = n.select("a", ((F.col("a") * 7 + 3) % 25).alias("b")).union(n.select("a", F.floor(F.col("a") / 2).cast("int").alias("b")))
    return closure_of(e, F.col("a") < 8).select(F.col("a").cast("int").alias("src"), F.col("b").cast("int").alias("dst"))


@query("""
SELECT p_brand, CAST(count(*) AS BIGINT) AS n_units, CAST(count(c) AS BIGINT) AS n_cited, CAST(count(CASE WHEN below THEN 1 END) AS BIGINT) AS n_below FROM part LEFT JOIN
 (SELECT l_partkey, count(*) AS c, bool_or(l_returnflag = 'R') AS below FROM lineitem WHERE l_quantity > 30 GROUP BY 1) ON l_partkey = p_partkey GROUP BY 1
""")
def coverage(spark, d):
    """How many units are cited at all, and from below."""
    part, lineitem = table(spark, d, "part"), table(spark, d, "lineitem")
    cited = lineitem.where("l_quantity > 30").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("c"), F.bool_or(F.col("l_returnflag") == "R").alias("below"))
    return part.join(cited, "p_partkey", "left").groupBy("p_brand").agg(F.count("*").alias("n_units"), F.count("c").alias("n_cited"), F.count_if("below").alias("n_below"))


@query("""
SELECT code, CASE WHEN code LIKE '%.00.00.00' THEN 1 WHEN code LIKE '%.00.00' THEN 2 WHEN code LIKE '%.00' THEN 3 ELSE 4 END AS level,
 CASE WHEN code LIKE '%.00.00.00' THEN NULL WHEN code LIKE '%.00.00' THEN substr(code,1,2)||'.00.00.00' WHEN code LIKE '%.00' THEN substr(code,1,5)||'.00.00' ELSE substr(code,1,8)||'.00' END AS parent_code
FROM (SELECT DISTINCT lpad(CAST(p_size % 9 + 1 AS VARCHAR),2,'0')||'.'||lpad(CAST(CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_partkey % 13 END AS VARCHAR),2,'0')||'.'||
 lpad(CAST(CASE WHEN p_partkey % 4 < 2 OR p_partkey % 13 = 0 THEN 0 ELSE p_partkey % 7 END AS VARCHAR),2,'0')||'.'||lpad(CAST(CASE WHEN p_partkey % 4 < 3 OR p_partkey % 7 = 0 OR p_partkey % 13 = 0 THEN 0 ELSE p_size % 5 END AS VARCHAR),2,'0') AS code FROM part)
""")
def code_levels(spark, d):
    """Level and parent of dotted codes, from the code alone."""
    k, z = F.col("p_partkey"), F.col("p_size")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    b = F.when(k % 4 == 0, 0).otherwise(k % 13)
    c = F.when((k % 4 < 2) | (k % 13 == 0), 0).otherwise(k % 7)
    e = F.when((k % 4 < 3) | (k % 7 == 0) | (k % 13 == 0), 0).otherwise(z % 5)
    codes = table(spark, d, "part").select(F.concat_ws(".", two(z % 9 + 1), two(b), two(c), two(e)).alias("code")).distinct()
    parts = F.split("code", r"\.")
    level = F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.lit(1), lambda a, i: F.when(F.element_at(parts, i) != "00", F.greatest(a, i)).otherwise(a))
    cut = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.when(i < F.col("level"), F.element_at(parts, i)).otherwise("00"))
    return codes.withColumn("level", level).select("code", "level", F.when(F.col("level") > 1, F.array_join(cut, ".")).alias("parent_code"))
