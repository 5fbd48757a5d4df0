"""The published markdown sources, read where the environment names them, against what is known of them; several documents at once; front matter."""

import os

import pytest
from pyspark.sql import functions as F

from lexgrid.operators import headings as H
from lexgrid.operators import structure as S
from lexgrid.operators.graph import breadth_problems, dangling

#: Where a machine has the published markdown of the code, its outline and the classifier.
CODE, OUTLINE, CLASSES = (os.environ.get(f"MARKDOWN_{x}", "") for x in ("CODE", "OUTLINE", "CLASSES"))
there = pytest.mark.skipif(not all(map(os.path.exists, (CODE, OUTLINE, CLASSES))), reason="the published sources are not on this machine")


def lines_of(spark, path):
    return H.body(H.markdown_lines(spark, path)).cache()


@there
def test_articles_of_the_code(spark):
    got = H.articles(lines_of(spark, CODE)).collect()
    assert len(got) == 394 and sum(r.superscript is not None for r in got) == 10
    assert 168 not in {r.number for r in got} and min(r.start_line for r in got) >= 14
    assert sum(r.repealed for r in got) == 7


@there
def test_outline(spark):
    nodes = H.structure(lines_of(spark, OUTLINE))
    kinds = {r.kind: r["count"] for r in nodes.groupBy("kind").count().collect()}
    assert (kinds["part"], kinds["subsection"], kinds["chapter"], kinds["section"]) == (6, 8, 71, 57)
    leaves = nodes.where("art_from IS NOT NULL")
    assert leaves.count() == 116 and leaves.agg(F.min("art_from"), F.max("art_to")).first()[:] == (1, 1199)
    ranged = nodes.select(F.lit(1).alias("doc_id"), F.col("line_no").cast("string").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("leaf").alias("kind"), "art_from", "art_to")
    assert S.range_problems(ranged).count() == 0


@there
def test_classifier(spark):
    nodes = H.classifier(lines_of(spark, CLASSES))
    assert nodes.count() == nodes.select("code").distinct().count() == 1882
    assert nodes.where("level = 1").count() == 19 and nodes.where("level = 2 AND code LIKE '03.%'").count() == 17
    tree = nodes.select(F.col("code").alias("node_id"), F.col("parent_code").alias("parent_id"), "label", "see_also")
    assert breadth_problems(tree.drop("see_also")).count() == 0
    assert dangling(tree).count() >= 0


def test_front_matter(spark):
    texts = [("a", "---\nkey: 1\n---\none\n---\ntwo"), ("b", "one\n---\nkey: 1\n---"), ("c", "---\nnever closed")]
    rows = H.lines(spark.createDataFrame(texts, "d string, t string"), "d", "t")
    got = {}
    for r in H.body(rows, ["d"]).orderBy("d", "line_no").collect():
        got.setdefault(r.d, []).append((r.line_no, r.line))
    assert got == {"a": [(4, "one"), (5, "---"), (6, "two")], "b": [(1, "one"), (2, "---"), (3, "key: 1"), (4, "---")]}


def test_documents_are_read_apart(spark):
    texts = [("a", "**Article 1. One**\nbody\n**Article 2. Two**\nmore"), ("b", "**Article 7. Seven**\nit has lost force")]
    rows = H.lines(spark.createDataFrame(texts, "d string, t string"), "d", "t")
    got = [(r.d, r.ordinal, r.key, r.end_line, r.repealed) for r in H.articles(rows, ["d"]).orderBy("d", "ordinal").collect()]
    assert got == [("a", 1, "1", 2, False), ("a", 2, "2", 4, False), ("b", 1, "7", 2, True)]
    outline = [("a", "**Part I. A**\n**Chapter 1.** B (Articles 1–7)"), ("b", "**Chapter 2.** C (Articles 8–9)")]
    got = [(r.d, r.kind, r.number, r.part) for r in H.structure(H.lines(spark.createDataFrame(outline, "d string, t string"), "d", "t"), ["d"]).orderBy("d", "line_no").collect()]
    assert got == [("a", "part", "I", "I"), ("a", "chapter", "1", "I"), ("b", "chapter", "2", None)]
