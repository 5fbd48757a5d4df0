"""Entity resolution in tiers, and similarity of titles."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


@pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio; the order of the two matters."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


def cascade(items: DataFrame, targets: DataFrame, block: str, title: str, fuzzy: float | None = None, margin: float = 0.15) -> DataFrame:
    """items with dst and method: their target in `targets` (dst, block, title) of the same block.

    Tiers: the equal title (of several the largest dst); else the only title of the block that holds the item's or lies
    in it; else, if fuzzy is given, the most similar one, at least that similar and `margin` ahead of the next;
    else unresolved. Candidates come from equal blocks only. Each title of a block is resolved once, however many items or targets bear it;
    only titles that an equi-join leaves over are compared within their block. A null title or block is unresolved.
    """
    key = ["_block", "_t"]
    asked = items.select(F.col(block).alias("_block"), F.col(title).alias("_t")).where("_block IS NOT NULL AND _t IS NOT NULL").distinct()
    known = targets.groupBy(F.col(block).alias("_block"), F.col(title).alias("_u")).agg(F.count("*").alias("_n"), F.max("dst").alias("_dst"))
    tried = asked.join(known.select("_block", F.col("_u").alias("_t"), F.col("_dst").alias("_exact")), key, "left")
    pairs = tried.where("_exact IS NULL").select(*key).join(known, "_block")
    inside = pairs.where(F.col("_u").contains(F.col("_t")) | F.col("_t").contains(F.col("_u")))
    part = inside.groupBy(*key).agg(F.sum("_n").alias("_hits"), F.max("_dst").alias("_part")).where("_hits = 1").drop("_hits")
    out = tried.join(part, key, "left")
    dst, method = F.coalesce("_exact", "_part"), F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_part").isNotNull(), "substring")
    if fuzzy is not None:
        shared = 2 * F.least(F.length("_t"), F.length("_u")) / (F.length("_t") + F.length("_u"))  # no ratio exceeds it
        left = pairs.join(part, key, "left_anti").where(shared >= max(0.0, fuzzy - margin))
        scored = left.withColumn("_r", seq_ratio("_t", "_u"))
        w = Window.partitionBy(*key).orderBy(F.desc("_r"), "_dst")
        ranked = scored.withColumns({"_rn": F.row_number().over(w), "_next": F.when(F.col("_n") > 1, F.col("_r")).otherwise(F.lead("_r", 1, 0.0).over(w))})
        best = ranked.where(f"_rn = 1 AND _r >= {fuzzy} AND _r - _next >= {margin}").select(*key, F.col("_dst").alias("_near"), "_r")
        out = out.join(best, key, "left")
        dst, method = F.coalesce(dst, "_near"), method.when(F.col("_r").isNotNull(), F.concat(F.lit("fuzzy:"), F.format_number("_r", 2)))
    out = out.select(*key, dst.alias("dst"), method.alias("method"))
    return items.withColumns({"_block": F.col(block), "_t": F.col(title)}).join(out, key, "left").select(*items.columns, "dst", F.coalesce("method", F.lit("unresolved")).alias("method"))
