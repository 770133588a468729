"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.streaming.control import WORD_INTERVAL, trigger


def csv_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = WORD_INTERVAL,
    timestamp_format: str | None = None,
) -> StreamingQuery:
    """Append a stream to headerless CSV files; Spark's sink log keeps each batch single.

    Timestamps are written in milliseconds unless `timestamp_format` asks for more.
    """
    writer = rows.writeStream.format("csv").outputMode("append").option("path", path)
    if timestamp_format is not None:
        writer = writer.option("timestampFormat", timestamp_format)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(every)).start()


def parquet_overwrite(rows: DataFrame, path: str, output_files: int | None = None) -> None:
    """Replace the directory with `rows`; by default each task writes its own file."""
    if output_files is not None:
        rows = rows.repartition(output_files)
    rows.write.mode("overwrite").parquet(path)
