"""Scans of the star-schema and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(df: DataFrame, room: int = 16 << 20) -> int:
    """How many partitions hold about `room` bytes each of what df reads, by the plan's sizes; at least one for each core."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(-(-size // room), 20_000))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df, its rows dealt by keys over partitions of a few MB as read: a scan gives one task for each row group, which may hold a million rows.

    For narrow tables of which every row takes long.
    """
    return df.repartition(2 * parts(df, 4 << 20), *keys)


def with_row_id(spark: SparkSession, path: str, row_id: str = "row_id") -> DataFrame:
    """A Parquet scan with the physical row number, stable while the file is; with several files add the file's name to the key."""
    return spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index").withColumnRenamed("row_index", row_id)
