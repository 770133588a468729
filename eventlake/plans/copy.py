"""The batch job that turns delimited files into Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventlake.session import full_path
from eventlake.sinks.files import parquet_overwrite
from eventlake.sources.files import csv_scan


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    preview: bool = False,
    output_files: int | None = None,
) -> None:
    """Copy headered CSV at `source` to Parquet at `target`, replacing what is there.

    `preview` prints the first rows, at the cost of a second, small read.
    """
    # Spark empties the target before it reads the source, so this would lose the source.
    if f"{full_path(spark, source)}/".startswith(f"{full_path(spark, target)}/"):
        raise ValueError(f"{target} holds the source {source}; choose another target")
    rows = csv_scan(spark, source)
    if preview:
        rows.show()
    parquet_overwrite(rows, target, output_files)
