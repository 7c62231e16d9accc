"""Article tables over parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the article stream starts here, one article per minute of its number.
STREAM_START = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles: raw_id, source, title (first line), content, timestamp."""
    begin = F.unix_micros(F.lit(STREAM_START).cast("timestamp"))
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("raw_id"),
        "source",
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("content"),
        F.timestamp_micros(begin + F.col("doc_id") * 60_000_000).alias("timestamp"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with ``ts`` as a timestamp: a watermark takes no zoneless time."""
    table = read_table(spark, folder, "events")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def processed_articles(table: DataFrame) -> DataFrame:
    """The columns the batch metrics need; the scan reads nothing else."""
    return table.select("source", "title", "content")
