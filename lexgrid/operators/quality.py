"""Data-quality assertions as rows (check, ok, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """No key twice."""
    return none(df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), name)


def refers(df: DataFrame, key: str, to: DataFrame, to_key: str, name: str) -> DataFrame:
    """Every key that isn't null exists in the other table."""
    return none(df.where(F.col(key).isNotNull()).join(to.select(F.col(to_key).alias(key)), key, "left_anti"), name)


def none(bad: DataFrame, name: str) -> DataFrame:
    """There is no such row."""
    return bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("long").alias("detail"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
