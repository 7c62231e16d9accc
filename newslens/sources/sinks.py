"""Writers of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_step(
    rows: DataFrame, path: str, run: str, epoch_id: int = 0, partition_by: tuple[str, ...] = ()
) -> None:
    """Rows of one step of one run, replacing what an earlier try of it left.

    ``run`` is the id of a stream, which outlives restarts, or of a batch run; two runs
    never share a folder, so neither can replace the other's rows.
    """
    (
        rows.withColumn("run", F.lit(run))
        .withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "run", "epoch_id")
        .parquet(path)
    )


def write_metrics(rows: DataFrame, path: str, run: str, epoch_id: int = 0) -> None:
    """Metric rows with the time they are written at, in folders by processing type first."""
    rows = rows.withColumn("created_at", F.current_timestamp())
    write_step(rows, path, run, epoch_id, ("processing_type",))


def drop_metrics(spark: SparkSession, path: str, processing_type: str, run: str, epoch_id: int) -> None:
    """Remove the metric rows of one step, wherever the table is stored."""
    folder = f"{path}/processing_type={processing_type}/run={run}/epoch_id={epoch_id}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stream_id(batch: DataFrame) -> str:
    """Id of the stream that a foreachBatch callback works for."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not called from a stream")
    return found


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
