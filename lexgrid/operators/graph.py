"""Trees and small directed graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def paths(spark: SparkSession, nodes: DataFrame, depth: int = 100) -> DataFrame:
    """(node_id, ids, labels, depth) from each root (parent_id null) down; ids and labels list the path from the root.

    One recursive query: each level is one equi-join of its nodes to their children. Spark's limits on levels and rows of
    recursive queries are read when the query runs, so the session's are raised to `depth` and to no limit of rows.
    """
    spark.conf.set("spark.sql.cteRecursionLevelLimit", str(max(depth, int(spark.conf.get("spark.sql.cteRecursionLevelLimit", "100")))))
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(
        """
        WITH RECURSIVE t(node_id, ids, labels, depth) AS (
          SELECT node_id, array(node_id), array(label), 0 FROM {nodes} WHERE parent_id IS NULL
          UNION ALL
          SELECT n.node_id, concat(t.ids, array(n.node_id)), concat(t.labels, array(n.label)), t.depth + 1
          FROM t JOIN {nodes} n ON n.parent_id = t.node_id)
        SELECT * FROM t""",
        nodes=nodes,
    )


def closure_of(edges: DataFrame, start: Column, every: int = 4) -> DataFrame:
    """(a, b): all b that edges (a, b) lead to from the sources that `start` holds for. Rounds go on until none is new.

    Where the session has a checkpoint folder, new pairs are written there each round, and all that is reached after `every` of them, so
    that neither recomputation nor the plan grows with the rounds.
    """
    written = edges.sparkSession.sparkContext.getCheckpointDir() is not None
    edges = edges.distinct()
    reached, new, rounds = edges.where(start), edges.where(start), 0
    while True:
        new = new.select("a", F.col("b").alias("m")).join(edges.select(F.col("a").alias("m"), "b"), "m").select("a", "b").distinct().join(reached, ["a", "b"], "left_anti")
        if written:
            new = new.checkpoint()
        if new.isEmpty():
            return reached
        reached, rounds = reached.unionByName(new), rounds + 1
        if written and rounds % every == 0:
            reached = reached.checkpoint()


def breadth_problems(nodes: DataFrame) -> DataFrame:
    """(check, node_id): nodes that occur twice, have an unknown parent, or an empty label."""
    twice = nodes.groupBy("node_id").count().where("count > 1").select(F.lit("duplicate").alias("check"), "node_id")
    orphan = nodes.where("parent_id IS NOT NULL").join(nodes.select(F.col("node_id").alias("parent_id")), "parent_id", "left_anti").select(F.lit("missing parent"), "node_id")
    return twice.union(orphan).union(nodes.where("label IS NULL OR trim(label) = ''").select(F.lit("empty label"), "node_id"))


def dangling(nodes: DataFrame, see_also: str = "see_also") -> DataFrame:
    """(node_id, target): what nodes' lists of references name that no node is."""
    named = nodes.select("node_id", F.explode(see_also).alias("target"))
    return named.join(nodes.select(F.col("node_id").alias("target")).distinct(), "target", "left_anti").select("node_id", "target")
