"""Run timing: duration, throughput and the comparison of processing types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions.times import ratio_or_zero, seconds_between


def timing_metrics(runs: DataFrame) -> DataFrame:
    """Timing rows from run-log rows (processing_type, start_time, end_time, records)."""
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    return runs.select(
        "processing_type",
        "start_time",
        "end_time",
        duration.alias("processing_duration_seconds"),
        F.col("records").cast("bigint").alias("records_processed"),
        ratio_or_zero(F.col("records"), duration).alias("records_per_second"),
    )


def compare_performance(timings: DataFrame) -> DataFrame:
    """Mean duration and mean, best and worst throughput per processing type.

    Means run over decimals, so they do not depend on the order of addition.
    """
    seconds = F.col("processing_duration_seconds").cast("decimal(20,6)")
    throughput = F.col("records_per_second").cast("decimal(20,6)")
    n = F.count(F.lit(1))
    return timings.groupBy("processing_type").agg(
        F.round(F.sum(seconds).cast("double") / n, 4).alias("avg_duration"),
        F.round(F.sum(throughput).cast("double") / n, 4).alias("avg_throughput"),
        F.max("records_per_second").alias("max_throughput"),
        F.min("records_per_second").alias("min_throughput"),
        n.alias("num_executions"),
    )
