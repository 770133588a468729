"""Row shapes shared by the sources, operators and tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, TEXTS, TIME = StringType(), ArrayType(StringType()), TimestampType()
INT, LONG, DOUBLE, BYTES = IntegerType(), LongType(), DoubleType(), BinaryType()


def columns(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


# Column names, types and order that readers of the landed tables rely on.

#: One record of a message topic, as the Kafka source delivers it.
ENVELOPE = columns(
    key=BYTES,
    value=BYTES,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    timestamp=TIME,
    timestampType=INT,
)

#: Payload of a JSON event message.
EVENT = columns(id=TEXT, timestamp=TIME, value=DOUBLE)

#: Landed JSON events: the payload, the doubled value and the ingest clock.
EVENT_COLUMNS = columns(
    id=TEXT, timestamp=TIME, value=DOUBLE, doubled_value=DOUBLE, processing_time=TIME
)

#: Payload of a telemetry message; Protobuf field numbers follow this order, starting at 1.
TELEMETRY = columns(
    tmc_arrival_timestamp=TIME,
    vin=TEXT,
    data_uris=TEXTS,
    device_type=TEXT,
    region=TEXT,
    protocol_version=TEXT,
    flow_metric=columns(flow_aui=TEXT, flow_name=TEXT, flow_timestamp=TIME),
    correlation_ids=TEXTS,
    asset_id=TEXT,
    expiration_length_types=TEXTS,
)

#: Landed telemetry: one flat row per message.
FLOW_COLUMNS = columns(
    tmc_arrival_timestamp=TIME,
    vin_hash=TEXT,
    data_uris=TEXTS,
    device_type=TEXT,
    region=TEXT,
    protocol_version=TEXT,
    flow_name=TEXT,
    flow_timestamp=TIME,
    correlation_ids=TEXTS,
    asset_id=TEXT,
    expiration_length_types=TEXTS,
    year=INT,
    month=INT,
    day=INT,
    hour=INT,
    flow_aui=TEXT,
)

#: A message that could not be read: its envelope, its bytes, and the ingest clock.
QUARANTINE_COLUMNS = columns(
    key=BYTES,
    payload=BYTES,
    topic=TEXT,
    partition=INT,
    offset=LONG,
    timestamp=TIME,
    processing_time=TIME,
)

#: Number of flow-id buckets of the landed telemetry table.
FLOW_BUCKETS = 16

#: Text in front of the number in a generated word, and in front of a message key.
WORD_PREFIX = "word_"
KEY_PREFIX = "key"
