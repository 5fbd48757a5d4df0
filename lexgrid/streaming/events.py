"""The event log as a stream: the latest state of each key, and counts by window with a bound on lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def read(spark: SparkSession, folder: str, files_per_batch: int = 1, late: str = "1 day") -> DataFrame:
    """New files of a folder as they come; what is later than `late` goes, and an event repeated within that time counts once."""
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return raw.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark(["event_id"])


def latest_status(events: DataFrame) -> DataFrame:
    """user_id, n, last_type: for update or complete mode; ties of time go to the larger id."""
    return events.groupBy("user_id").agg(F.count("*").alias("n"), F.max_by("event_type", F.struct("at", "event_id")).alias("last_type"))


def hourly(events: DataFrame) -> DataFrame:
    """Events of each type by hour."""
    return events.groupBy(F.window("at", "1 hour").alias("hour"), "event_type").agg(F.count("*").alias("n"))
