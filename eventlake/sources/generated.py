"""Numbered rows made by Spark itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rate_rows(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """An endless stream of `timestamp, value` with values counting up from 0."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def rate_batches(
    spark: SparkSession, per_batch: int, partitions: int | None = None
) -> DataFrame:
    """The same rows, a fixed number per micro-batch instead of per second.

    `partitions` is the number of tasks that make a batch; Spark's default parallelism if left out.
    """
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()
