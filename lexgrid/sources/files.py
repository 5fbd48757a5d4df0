"""Files as sources and sinks: fingerprints, pointer guards, JSON records, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "version https://git-lfs"  # how a large file's stand-in begins
SMALLEST = 10_000  # bytes of a real corpus file


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of each file, read and hashed by the executors."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def pulled(spark: SparkSession, path: str) -> None:
    """Raises if a file is the stand-in of one that was never fetched."""
    for r in spark.read.format("binaryFile").load(path).where(F.col("length") < SMALLEST).select("path", F.substring("content", 1, len(POINTER)).alias("head")).collect():
        if bytes(r["head"]).decode("utf-8", "replace") == POINTER:
            raise FileNotFoundError(f"{r['path']} is a pointer to a file that was not fetched; fetch it and run again")


#: One record of a parsed code.
ARTICLE = T.StructType([
    T.StructField("article_id", T.StringType()), T.StructField("article_number_base", T.IntegerType()), T.StructField("superscript", T.StringType()), T.StructField("db_article_number_key", T.StringType()),
    T.StructField("article_number_display", T.StringType()), T.StructField("title", T.StringType()), T.StructField("titleless", T.BooleanType()), T.StructField("heading_type", T.StringType()),
    T.StructField("structural_hierarchy", T.StructType([T.StructField(n, T.StringType()) for n in ("part", "section", "chapter", "subsection", "paragraph_division")])),
    T.StructField("raw_content", T.StringType()), T.StructField("clean_text", T.StringType()), T.StructField("char_count_raw", T.IntegerType()), T.StructField("char_count_clean", T.IntegerType()),
    T.StructField("line_range", T.StructType([T.StructField("start_line", T.IntegerType()), T.StructField("end_line", T.IntegerType())])), T.StructField("repealed", T.BooleanType()),
])


def parsed_articles(spark: SparkSession, path: str) -> DataFrame:
    """The records of a JSON file {metadata, articles: [...]}."""
    return spark.read.schema(T.StructType([T.StructField("articles", T.ArrayType(ARTICLE))])).json(path, multiLine=True).select(F.explode("articles").alias("a")).select("a.*")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def snapshot(df: DataFrame, folder: str, name: str, run_id: str, key: list[str] | None = None) -> DataFrame:
    """df as a Parquet table of one run, read back. Keys aren't enforced by the format, so `key` is checked to be unique."""
    path = f"{folder}/{name}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if key and (twice := out.groupBy(*key).count().where("count > 1").limit(1).collect()):
        raise ValueError(f"{name}: key {key} is not unique, e.g. {twice[0].asDict()}")
    return out
