"""Topics on a Kafka broker. Needs Spark's Kafka package on the class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

def has_kafka(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        return False
    return True


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Messages of one or more topics as (topic, value, timestamp, position).

    ``max_offsets`` bounds the records of a trigger; without it each trigger takes all.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return (
        reader.load()
        .selectExpr(
            "topic",
            "CAST(value AS STRING) AS value",
            "timestamp",
            "concat_ws('-', partition, offset) AS position",
        )
    )


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Publish (topic, value) rows."""
    (
        messages.select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
