"""Typed columns to message payloads and envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.protobuf import MessageFormat, encode_message
from eventlake.schemas import EVENT, KEY_PREFIX, TELEMETRY

# Spark writes JSON timestamps in milliseconds unless told otherwise; sources carry microseconds.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def synthetic_events(rows: DataFrame) -> DataFrame:
    """One random event per input row: a UUID, the current time, a uniform value below 100."""
    return rows.select(
        F.uuid().alias("id"),
        F.current_timestamp().alias("timestamp"),
        (F.rand() * 100).alias("value"),
    )


# How many vehicles, regions and flows the sample messages are spread over.
SAMPLE_VEHICLES, SAMPLE_REGIONS, SAMPLE_FLOWS = 1000, 7, 40


def sample_telemetry(rows: DataFrame) -> DataFrame:
    """One telemetry message per number in `id`, every field derived from the number.

    Messages spread over flows, regions and vehicles, arrive a second apart and up to now, and hold
    one to three links. Every fourth has no asset, every ninth no flow.
    """
    number = F.col("id")

    def numbered(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value.cast("string"))

    arrival = F.timestamp_seconds(F.unix_seconds(F.current_timestamp()) - number % 86_400)
    flow_number = number % SAMPLE_FLOWS
    flow = F.struct(
        F.sha1(numbered("flow", flow_number).cast("binary")).alias("flow_aui"),
        numbered("route ", flow_number).alias("flow_name"),
        F.timestamp_seconds(F.unix_seconds(arrival) - flow_number).alias("flow_timestamp"),
    )
    links = F.sequence(F.lit(0).cast("bigint"), number % 3)
    return rows.select(
        "id",
        arrival.alias("tmc_arrival_timestamp"),
        numbered("VIN", number % SAMPLE_VEHICLES).alias("vin"),
        F.transform(links, lambda i: F.concat_ws("/", F.lit("data:"), number, i)).alias(
            "data_uris"
        ),
        F.when(number % 2 == 0, "camera").otherwise("lidar").alias("device_type"),
        numbered("zone-", number % SAMPLE_REGIONS).alias("region"),
        F.concat_ws(".", F.lit("2"), number % 4).alias("protocol_version"),
        F.when(number % 9 != 8, flow).alias("flow_metric"),
        F.array(numbered("trace-", number)).alias("correlation_ids"),
        F.when(number % 4 != 3, numbered("rig-", number % 50)).alias("asset_id"),
        F.array(numbered("days-", number % 30)).alias("expiration_length_types"),
    )


def message_key(number: Column | str) -> Column:
    """The text key of a numbered message."""
    return F.concat(F.lit(KEY_PREFIX), F.col(number) if isinstance(number, str) else number)


def json_payload() -> Column:
    """The event columns of the current row as JSON text."""
    return F.to_json(F.struct(*EVENT.names), {"timestampFormat": MICROSECONDS})


def telemetry_payload(form: MessageFormat | None = None, engine: str = "auto") -> Column:
    """The telemetry columns of the current row as Protobuf bytes."""
    return encode_message(F.struct(*TELEMETRY.names), form, engine)


def to_envelope(
    rows: DataFrame, payload: Column, key: Column | None = None, topic: str = ""
) -> DataFrame:
    """Rows as topic records, numbered within their partition.

    The numbers come from the time of the publish and Spark's partition layout, so no shuffle is
    needed to give them, and a later publish goes on above an earlier one; two that start in the
    same millisecond may share numbers. They have gaps, which a broker's have not. Spark cannot
    number a stream that way; there they stay NULL, and a broker gives its own.
    """
    partition = offset = F.lit(None)
    if not rows.isStreaming:
        partition = F.spark_partition_id()
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        # No publish gets further than 2 ** 22 rows of a partition in a millisecond.
        offset = F.shiftleft(F.unix_millis(F.current_timestamp()), 22) + place
    return rows.select(
        (F.lit(None) if key is None else key).cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
