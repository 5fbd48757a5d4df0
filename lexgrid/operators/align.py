"""Pairing of two keyed lists by occurrence, and what doesn't pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import occurrence


def positional(left: DataFrame, right: DataFrame, key: str, left_order: list, right_order: list) -> DataFrame:
    """(key, occurrence, all other columns of both, method, status): rows of equal key paired in order.

    method is exact_key if the key is single on both sides, else positional_within_key; status says which side is missing:
    aligned, left_only or right_only (no row of the key on the other side), left_only_occurrence or right_only_occurrence.
    """
    a = occurrence(left, [key], left_order).withColumnsRenamed({"total": "_ta"}).withColumn("_a", F.lit(True))
    b = occurrence(right, [key], right_order).withColumnsRenamed({"total": "_tb"}).withColumn("_b", F.lit(True))
    totals = lambda df, t: df.select(key, t).distinct()
    both = a.drop("_ta").join(b.drop("_tb"), [key, "occurrence"], "full_outer").join(totals(a, "_ta"), key, "left").join(totals(b, "_tb"), key, "left")
    one = (F.col("_ta") == 1) & (F.col("_tb") == 1)
    status = (
        F.when(F.col("_a") & F.col("_b"), "aligned").when(F.col("_a"), F.when(F.col("_tb").isNull(), "left_only").otherwise("left_only_occurrence"))
        .otherwise(F.when(F.col("_ta").isNull(), "right_only").otherwise("right_only_occurrence"))
    )
    return both.withColumns({"method": F.when(F.coalesce(one, F.lit(False)), "exact_key").otherwise("positional_within_key"), "status": status}).drop("_a", "_b", "_ta", "_tb")


def reviewed(aligned: DataFrame, overrides: DataFrame, key: str, superscript: str) -> DataFrame:
    """aligned (of positional) with report, and status as decided: what a person has to look at, null for what is safe.

    overrides: (key, status) of keys that were decided on; they are reported as such. Else rows that stand alone are reported by
    their status, then pairs of a key that isn't single on both sides, then pairs with a superscript.
    """
    decided = overrides.select(key, F.col("status").alias("_decided"))
    out = aligned.join(decided, key, "left")
    report = (
        F.when(F.col("_decided").isNotNull(), "override").when(F.col("status") != "aligned", F.col("status"))
        .when(F.col("method") != "exact_key", "review_ambiguous_key").when(F.col(superscript).isNotNull(), "review_superscript")
    )
    return out.withColumns({"report": report, "status": F.coalesce("_decided", "status")}).drop("_decided")
