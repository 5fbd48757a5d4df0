"""Window idioms: occurrence numbers, running bases, carried context, spans to the next heading, latest states, one row of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def occurrence(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """occurrence and total of each row among those of its key."""
    w = Window.partitionBy(*key)
    return df.withColumn("occurrence", F.row_number().over(w.orderBy(*order))).withColumn("total", F.count("*").over(w))


def running_base(df: DataFrame, key: list[str], order: list, value: Column, in_range: Column) -> DataFrame:
    """is_base: in range and above every base before; base: the one that a row belongs to (its own, if it is one)."""
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.max(F.when(in_range, value)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = F.max(F.when(in_range, value)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("is_base", in_range & (before.isNull() | (value > before))).withColumn("base", seen)


def carry(df: DataFrame, key: list[str], order: list, **values: Column) -> DataFrame:
    """The last value of each expression that wasn't null, up to and with the row."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.last(v, ignorenulls=True).over(w) for name, v in values.items()})


def spans(df: DataFrame, key: list[str], start: str, end: str = "next_start") -> DataFrame:
    """Where the next row of the key starts."""
    return df.withColumn(end, F.lead(start).over(Window.partitionBy(*key).orderBy(start)))


def latest(df: DataFrame, key: list[str], order: list, value: Column, name: str) -> DataFrame:
    """The key's last value on each of its rows."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.last(value).over(w))


def top1(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")
