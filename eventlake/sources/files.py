"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def csv_scan(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text whose first line names the columns; every column is a string.

    Without type inference the data is read once, and large files split over tasks.
    """
    return spark.read.csv(path, header=True)


def table_stream(
    spark: SparkSession, folder: str, name: str, max_bytes: int | None = None
) -> DataFrame:
    """The Parquet file, or the directory of Parquet files, called `name`, as a stream.

    `max_bytes` bounds a micro-batch, and so what one failure repeats; a file is never split.
    """
    # The file stream takes a directory or a glob; this glob matches just the one name.
    schema = spark.read.parquet(f"{folder}/{name}").schema
    reader = spark.readStream.schema(schema)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.parquet(f"{folder}/{{{name}}}")
