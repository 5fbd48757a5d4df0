"""The corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup and packing, each stage written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents. Nulls, empty
texts, ties, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.llm import language, packing, simhash, substrings
from lexgrid.llm.common import Store, compact, table

LEAST_EVIDENCE = 0.27  # for the predicted language; texts of the learned languages showed 0.29 or more on the tables, other scripts and most unlearned languages less


def plain(docs: DataFrame, *keep: str) -> DataFrame:
    """docs with numbered column names but for those to keep, so that no name clashes with a stage's own."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in keep else f"_in_{i}") for i, c in enumerate(docs.columns)])


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of plain(docs) under their own names again."""
    return rows.select(*[F.col(c if c in rows.columns and f"_in_{i}" not in rows.columns else f"_in_{i}").alias(c) for i, c in enumerate(docs.columns)])


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: those without a letter, or that no language's regression value speaks for, go.

    The least evidence is LEAST_EVIDENCE, or half of what all but a hundredth of the model's own sample show where that
    is less, as with many languages that are alike. A model of a few texts only cannot tell, and all that have a letter stay.
    The model is fitted on the stage's own documents. Where no document has a label there is no model, and all that
    have a letter stay.
    """
    model = language.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike("\\p{L}"))
    judged = language.predict(plain(docs, "text"), model, ("_lang_pred", "_score", "_evidence"))
    least = min(LEAST_EVIDENCE, model.usual / 2)
    return named(judged.where((F.col("_lang_pred") != language.UNKNOWN) & (F.col("_evidence") >= least)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id, once if its row is repeated.

    Of texts that share that doc_id the one with the least hash stays; groups stay apart though they share a doc_id.
    Rows without a doc_id stay only if no row of their group has one, one for each of their fingerprints.
    """
    own = plain(docs, "doc_id", "text")
    keyed = own.withColumn("_lg_k", F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))))  # rows that are alike are one
    groups = simhash.simhash_groups(spark, keyed.select(F.col("_lg_k").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_lg_k"), F.col("fp").alias("_lg_fp"), F.col("component_id").alias("_lg_c")).distinct()
    members = groups.join(keyed.select("_lg_k", "doc_id").distinct(), "_lg_k")
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "_lg_k"))).alias("_lg_named")
    prints = members.groupBy("_lg_c", "_lg_fp").agg(least, F.min("_lg_k").alias("_lg_any"))
    firsts = prints.groupBy("_lg_c").agg(F.min("_lg_named").alias("_lg_first"))
    bare = prints.join(firsts.where("_lg_first IS NULL"), "_lg_c").select(F.col("_lg_any").alias("_lg_k"))
    kept = firsts.where("_lg_first IS NOT NULL").select(F.col("_lg_first._lg_k").alias("_lg_k")).unionByName(bare)
    return named(keyed.join(kept, "_lg_k", "left_semi").dropDuplicates(["_lg_k"]), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; one that nothing is left of goes, one that was empty before stays."""
    columns = [f"_lg_{i}" for i in range(len(docs.columns))]  # whatever the documents' columns are named
    cut = substrings.without_repeats(spark, docs, docs.columns, "text").toDF(*columns, "_lg_bytes", "_lg_removed", "_lg_spans", "_lg_kept")
    changed = F.col("_lg_removed") > 0
    new = {"text": F.col("_lg_kept"), "n_chars": F.length("_lg_kept").cast("long")}
    cut = cut.where(~changed | (F.length("_lg_kept") > 0))
    return cut.select(*[(F.when(changed, new[c]).otherwise(F.col(x)) if c in new else F.col(x)).alias(c) for c, x in zip(docs.columns, columns, strict=True)])


def fill(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of the documents lie in sequences."""
    return packing.pack(spark, docs)


STAGES = [("language ID", identify), ("SimHash near-dedup", near_dedup), ("suffix-array dedup", cut_repeats), ("packing", fill)]
#: SQL has none of the four methods; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written to the shared folder and read by the next."""
    store, docs, before = Store(spark, "pipeline"), table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        made = len(Store.made)
        docs = store.keep(stage(spark, docs, sf_dir))
        Store.sweep(made)  # what the stage wrote for itself
        compact(spark)
        if before is not None:
            store.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
