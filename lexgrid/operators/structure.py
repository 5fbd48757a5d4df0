"""Structure trees: chains, breadcrumbs, ranges and what they lack, numbers that keys get in a given order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ancestors(spark: SparkSession, nodes: DataFrame, node_id: str) -> DataFrame:
    """(node_id, label, up) of one node and all above it, up counting from 0 at the node: a recursive query with a bound parameter."""
    return spark.sql(
        """
        WITH RECURSIVE t(node_id, label, parent_id, up) AS (
          SELECT node_id, label, parent_id, 0 FROM {nodes} WHERE node_id = :node
          UNION ALL
          SELECT n.node_id, n.label, n.parent_id, t.up + 1 FROM t JOIN {nodes} n ON n.node_id = t.parent_id)
        SELECT node_id, label, up FROM t""",
        args={"node": node_id},
        nodes=nodes,
    )


def breadcrumbs(spark: SparkSession, nodes: DataFrame, between: str = " > ") -> DataFrame:
    """(node_id, breadcrumb) from the bottom up: each node climbs to its root, and the labels it meets are joined from the root down."""
    climbed = spark.sql(
        """
        WITH RECURSIVE t(node_id, label, parent_id, up) AS (
          SELECT node_id, label, parent_id, 0 FROM {nodes}
          UNION ALL
          SELECT t.node_id, n.label, n.parent_id, t.up + 1 FROM t JOIN {nodes} n ON n.node_id = t.parent_id)
        SELECT node_id, label, up FROM t""",
        nodes=nodes,
    )
    labels = F.transform(F.sort_array(F.collect_list(F.struct("up", "label")), asc=False), lambda x: x["label"])
    return climbed.groupBy("node_id").agg(F.array_join(labels, between).alias("breadcrumb"))


def range_problems(nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, check, node_id, detail): ranges [art_from, art_to] of a document's nodes that overlap, leave a gap or don't begin at 1, and chapters without a range or children.

    nodes: key, node_id, parent_id, kind, art_from, art_to. One window over each document's ranges in order; no pairs.
    """
    w = Window.partitionBy(key).orderBy("art_from", "art_to", "node_id")
    seen = nodes.where("art_from IS NOT NULL").select("*", F.lag("art_to").over(w).alias("_before"), F.row_number().over(w).alias("_k"))
    check = (
        F.when((F.col("_k") == 1) & (F.col("art_from") != 1), "start").when(F.col("art_from") <= F.col("_before"), "overlap")
        .when(F.col("art_from") != F.col("_before") + 1, "gap")
    )
    ranges = seen.select(key, check.alias("check"), "node_id", F.when(check == "gap", F.concat_ws("-", F.col("_before") + 1, F.col("art_from") - 1)).otherwise(F.concat_ws("-", "art_from", "art_to")).alias("detail"))
    children = nodes.where("parent_id IS NOT NULL").select(key, F.col("parent_id").alias("node_id"))
    bare = nodes.where("kind = 'chapter' AND art_from IS NULL").join(children, [key, "node_id"], "left_anti")
    return ranges.where("check IS NOT NULL").unionByName(bare.select(key, F.lit("no range").alias("check"), "node_id", F.lit("").alias("detail")))


def part_ranges(placed: DataFrame) -> DataFrame:
    """(root, art_from, art_to): what the ranges below each root span. placed: ids (the path from the root), art_from, art_to."""
    return placed.where("art_from IS NOT NULL").groupBy(F.element_at("ids", 1).alias("root")).agg(F.min("art_from").alias("art_from"), F.max("art_to").alias("art_to"))


def missing_per_node(nodes: DataFrame, units: DataFrame) -> DataFrame:
    """(node_id, n_missing, missing): the numbers of each node's range that none of its units (node_id, number) has, in order; nodes that lack none give no row."""
    due = nodes.where("art_from IS NOT NULL").select("node_id", F.explode(F.sequence("art_from", "art_to")).alias("number"))
    lacking = due.join(units.select("node_id", "number"), ["node_id", "number"], "left_anti")
    return lacking.groupBy("node_id").agg(F.count("*").alias("n_missing"), F.array_join(F.sort_array(F.collect_list("number")), ", ").alias("missing"))


def superscript(number: Column, base: Column, is_base: Column) -> tuple[Column, Column]:
    """(superscript, unresolved) of numbers that W.running_base placed: what a number adds to its base's digits, null for bases; unresolved if it adds none."""
    n, b = number.cast("string"), base.cast("string")
    tail = F.when(~is_base & n.startswith(b), F.nullif(F.substr(n, F.length(b) + 1), F.lit("")))
    return tail.try_cast("int"), ~is_base & tail.isNull()


def numbered(df: DataFrame, key: str, order: list, name: str, span: int = 1 << 16) -> DataFrame:
    """df with gapless numbers from 1 in the order of (key, *order), key an integer that isn't negative or null.

    Spans of keys are counted first and numbered one by one, so no task sees more than a span's rows; what is global are
    the spans' counts.
    """
    cell = F.floor(F.col(key) / F.lit(span)).alias("_span")
    counts = df.groupBy(cell).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_span", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_span").orderBy(key, *order))
    return df.withColumn("_span", cell).join(offsets, "_span").withColumn(name, own + F.col("_before")).drop("_span", "_before")


def containing(points: DataFrame, nodes: DataFrame, at: str, low: str, high: str) -> DataFrame:
    """points with the columns of each node whose [low, high] holds `at`, nulls if none: the intervals' points are listed, and the join is on equal points."""
    listed = nodes.withColumn(at, F.explode(F.sequence(F.col(low).cast(points.schema[at].dataType), F.col(high).cast(points.schema[at].dataType))))
    return points.join(listed, at, "left")


def by_number(text: Column) -> Column:
    """Order of keys that are written numbers: by value; others last."""
    return text.try_cast("int").asc_nulls_last()


def mapping_problems(mapping: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, reason: str | None = None) -> DataFrame:
    """(check, left_key, right_key): rows of a curated mapping that name nothing in one of the two tables, repeat, or (if `reason` names a column) give no reason."""
    keys = [F.col(left_key).cast("string").alias(left_key), F.col(right_key).cast("string").alias(right_key)]
    say = lambda df, check: df.select(F.lit(check).alias("check"), *keys)
    out = say(mapping.join(left.select(left_key).distinct(), left_key, "left_anti"), "unknown left")
    out = out.unionByName(say(mapping.join(right.select(right_key).distinct(), right_key, "left_anti"), "unknown right"))
    out = out.unionByName(say(mapping.groupBy(left_key, right_key).count().where("count > 1"), "repeated"))
    return out.unionByName(say(mapping.where(F.trim(F.coalesce(reason, F.lit(""))) == ""), "no reason")) if reason else out
