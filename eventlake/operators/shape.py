"""Typed payload columns to the columns of the landed tables.

`clock` is the ingest time. Left out, it is `current_timestamp()`: one value per micro-batch, which
the checkpoint records, so that a replayed batch lands in the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.schemas import FLOW_COLUMNS, WORD_PREFIX


def ingest_clock(clock: Column | None = None) -> Column:
    return F.current_timestamp() if clock is None else clock


def date_parts(clock: Column | None = None) -> dict[str, Column]:
    """Year, month, day and hour of the ingest clock in the session time zone."""
    now = ingest_clock(clock)
    return {"year": F.year(now), "month": F.month(now), "day": F.day(now), "hour": F.hour(now)}


def enrich_events(events: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add the doubled value and the ingest time to decoded JSON events."""
    return events.withColumns(
        {"doubled_value": F.col("value") * 2, "processing_time": ingest_clock(clock)}
    )


def flatten_telemetry(
    telemetry: DataFrame, clock: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Decoded telemetry in the layout of the landed table.

    `vin_hash` is the vehicle id as received, under the table's name for it. The partition columns
    follow the arrival clock, so a late message lands in the hour it arrived in.
    """
    derived = {
        "vin_hash": F.col("vin"),
        "flow_name": F.col("flow_metric.flow_name"),
        "flow_timestamp": F.col("flow_metric.flow_timestamp").cast("timestamp"),
        "flow_aui": F.col("flow_metric.flow_aui"),
        "tmc_arrival_timestamp": F.col("tmc_arrival_timestamp").cast("timestamp"),
        **date_parts(clock),
    }
    columns = [derived.get(name, F.col(name)).alias(name) for name in FLOW_COLUMNS.names]
    return telemetry.select(*keep, *columns)


def word_rows(numbers: DataFrame, clock: Column | None = None) -> DataFrame:
    """A generated word and the batch time for each number in `value`."""
    word = F.concat(F.lit(WORD_PREFIX), F.col("value").cast("string"))
    return numbers.select(word.alias("word"), ingest_clock(clock).alias("timestamp"))
