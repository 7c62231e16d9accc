"""Article tables in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FETCH = 10_000


def scan_options(
    url: str, table: str, column: str, lower: int, upper: int, partitions: int
) -> dict[str, str]:
    """Options of a scan cut into ranges of ``column``, read by as many tasks."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(ROWS_PER_FETCH),
    }


def read_articles(
    spark: SparkSession,
    url: str,
    lower: int,
    upper: int,
    partitions: int,
    table: str = "processed_articles",
    column: str = "id",
    **options: str,
) -> DataFrame:
    """Source, title and content of all processed articles, in parallel range scans."""
    reader = spark.read.format("jdbc").options(
        **scan_options(url, table, column, lower, upper, partitions), **options
    )
    return reader.load().select("source", "title", "content")


def append_rows(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Append rows to a table, each partition in batches of its own."""
    rows.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(ROWS_PER_FETCH), **options
    ).mode("append").save()
