"""Queries that measure the extractor: windows after anchors, naive and sub-unit recall, shapes of windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import measure as M
from ..operators.citations import citations
from ..sources.tables import dealt, table
from .catalog import query


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Texts that cite two articles; every fifth names another code's article after them, every second a part of the second."""
    k, n = F.col("o_orderkey"), F.col("o_custkey") % 300 + 20
    other = F.when(k % 5 == 0, ", Mehnat toʻgʻrisidagi kodeksning 9-moddasi").otherwise("")
    text = F.concat(F.lit("Fuqarolik kodeksining "), n, F.lit("-moddasi, "), n + 5, F.lit("-moddasi"), F.when(k % 2 == 0, " uchinchi qismi").otherwise(""), other, F.lit(". “Sudlar toʻgʻrisida”gi Qonunning 7-moddasi."))
    return dealt(table(spark, d, "orders"), "o_orderkey").select(k.alias("row_id"), F.lit(False).alias("allow_fk_alias"), F.lit(False).alias("is_the_code"), F.lit("law").alias("doc_type"), text.alias("article_text"))


TEXT = """(SELECT o_orderkey, o_custkey % 300 + 20 AS n, 'Fuqarolik kodeksining ' || (o_custkey % 300 + 20) || '-moddasi, ' || (o_custkey % 300 + 25) || '-moddasi' || CASE WHEN o_orderkey % 2 = 0 THEN ' uchinchi qismi' ELSE '' END
 || CASE WHEN o_orderkey % 5 = 0 THEN ', Mehnat toʻgʻrisidagi kodeksning 9-moddasi' ELSE '' END || '. “Sudlar toʻgʻrisida”gi Qonunning 7-moddasi.' AS t FROM orders)"""


@query(f"SELECT o_orderkey AS row_id, 'fuqarolik_kodeksi' AS anchor_kind, CAST(0 AS INT) AS anchor_start, CAST(21 AS INT) AS anchor_end, CAST(length(t) AS INT) AS limit_, t AS window_text, CAST(2 AS BIGINT) AS n_extracted FROM {TEXT}")
def anchor_windows(spark, d):
    """Each anchor with its window and what was extracted in it."""
    rows = _rows(spark, d)
    out = M.anchor_windows(rows, citations(spark, rows, ("article_text",)), ("article_text",))
    return out.select("row_id", "anchor_kind", "anchor_start", "anchor_end", F.col("limit").alias("limit_"), F.col("window").alias("window_text"), "n_extracted")


@query(f"SELECT 'fuqarolik_kodeksi' AS anchor_kind, CAST(count(*) AS BIGINT) AS windows, CAST(sum(2 + CAST(o_orderkey % 5 = 0 AS INT)) AS BIGINT) AS n_naive, CAST(2 * count(*) AS BIGINT) AS n_extracted, CAST(count(*) FILTER (WHERE o_orderkey % 5 = 0) AS BIGINT) AS n_missed FROM {TEXT}")
def naive_recall(spark, d):
    """What a naive reading of the windows finds, against the extractor: it misses only what another code owns."""
    rows = _rows(spark, d)
    return M.naive_recall(M.anchor_windows(rows, citations(spark, rows, ("article_text",)), ("article_text",)))


@query(f"SELECT CAST(count(*) FILTER (WHERE o_orderkey % 2 = 0) AS BIGINT) AS checked, CAST(0 AS BIGINT) AS missed FROM {TEXT}")
def unit_recall(spark, d):
    """Single articles that a part follows, and those read without it."""
    rows = _rows(spark, d)
    return M.unit_recall(rows, citations(spark, rows, ("article_text",)), ("article_text",))


def _bits(text: str) -> str:
    quote = lambda x: x.replace("'", "''")
    flags = [f"(CASE WHEN regexp_matches({text}, '{quote(p)}') THEN '1' ELSE '0' END)" for _, p in M.SEPARATORS + M.SHAPES]
    edges = lambda n, e: "CASE " + " ".join(f"WHEN {n} <= {x} THEN '{i}'" for i, x in enumerate(e)) + f" ELSE '{len(e)}' END"
    kinds = " + ".join(f"CAST(regexp_matches({text}, '{quote(p)}') AS INT)" for _, p in M.SEPARATORS)
    digits = f"len(regexp_extract_all(substr({text}, 1, {M.HEAD}), '[0-9]+'))"
    return " || ".join([*flags, f"CAST({kinds} AS VARCHAR)", f"({edges(f'length(regexp_extract({text}, chr(94) || chr(40) || chr(91) || chr(94) || chr(48) || chr(45) || chr(57) || chr(93) || chr(42) || chr(41), 1))', M.DISTANCES)})", f"({edges(digits, M.DIGITS)})"])


@query(f"SELECT signature, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, 'none' || coalesce(source, '') || {_bits('text')} AS signature FROM documents WHERE text IS NOT NULL) GROUP BY 1")
def window_shapes(spark, d):
    """All 28 features of texts, and how many share them."""
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    own = M.shape_key(M.shape(F.col("text"), F.lit("none"), F.coalesce("source", F.lit(""))))
    return docs.select("doc_id", own.alias("signature")).groupBy("signature").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
