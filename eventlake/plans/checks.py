"""Every operator and job run over the test tables, beside the SQL that gives the same rows.

A check takes a session and the folder of the tables. The ingest clock is pinned, since a result
that can be compared may not hold the current time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import ClassVar

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampType

from eventlake.functions.buckets import iceberg_bucket
from eventlake.functions.protobuf import decode_message, described_format, encode_message
from eventlake.operators.decode import decode_json, decode_telemetry
from eventlake.operators.encode import (
    json_payload,
    message_key,
    synthetic_events,
    telemetry_payload,
    to_envelope,
)
from eventlake.operators.shape import date_parts, flatten_telemetry, word_rows
from eventlake.plans.copy import csv_to_parquet
from eventlake.plans.ingest import flow_rows, ingest_events, ingest_telemetry
from eventlake.plans.produce import publish_events, publish_telemetry, write_words
from eventlake.schemas import EVENT, FLOW_BUCKETS
from eventlake.session import remove_folder, scratch_folder
from eventlake.sinks.quarantine import as_messages
from eventlake.sinks.tables import ParquetTable, event_table, flow_table, quarantine_table
from eventlake.sinks.topics import publish, publish_stream
from eventlake.sources.files import table_stream
from eventlake.sources.generated import rate_batches
from eventlake.sources.topics import DirectoryTopic, messages
from eventlake.streaming.batches import BatchMetric
from eventlake.streaming.progress import Progress, StopSwitch, await_end, watch

Query = Callable[[SparkSession, str], DataFrame]

#: Numbers that one task of the rate source makes, about.
RATE_ROWS_A_TASK = 1_000_000

#: What one micro-batch of a streamed table may hold.
STREAM_BYTES = 1 << 40

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def check(sql: str) -> Callable[[Query], Query]:
    """Register a query, named by its function without `check_`, with the SQL it is compared to."""

    def register(query: Query) -> Query:
        name = query.__name__.removeprefix("check_")
        QUERIES[name] = query
        ORACLE_SQL[name] = sql
        return query

    return register


# --- inputs -----------------------------------------------------------------------------------


def pinned() -> Column:
    return F.lit("2024-06-01 12:34:56").cast("timestamp")


def events(spark: SparkSession, tables: str) -> DataFrame:
    rows = spark.read.parquet(f"{tables}/events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def as_events(rows: DataFrame) -> DataFrame:
    """The events table in the columns of a JSON event."""
    return rows.select(
        "event_id",
        "event_type",
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        "value",
    )


def as_telemetry(rows: DataFrame) -> DataFrame:
    """The events table in the columns of a telemetry message."""
    flow = F.struct(
        F.concat(F.lit("flow_"), "event_type").alias("flow_aui"),
        F.col("event_type").alias("flow_name"),
        F.date_trunc("second", "ts").alias("flow_timestamp"),
    )
    return rows.select(
        "event_id",
        "event_type",
        "user_id",
        F.col("ts").alias("tmc_arrival_timestamp"),
        F.concat(F.lit("VIN"), "user_id").alias("vin"),
        F.array(F.concat(F.lit("u/"), "event_id"), F.concat(F.lit("k/"), "user_id")).alias(
            "data_uris"
        ),
        F.lit("sensor").alias("device_type"),
        F.lit("US").alias("region"),
        F.lit("1.0").alias("protocol_version"),
        flow.alias("flow_metric"),
        F.array(F.concat(F.lit("c"), "event_id")).alias("correlation_ids"),
        F.concat(F.lit("asset_"), "user_id").alias("asset_id"),
        F.array(F.lit("type1")).alias("expiration_length_types"),
    )


def comparable(rows: DataFrame) -> DataFrame:
    """Timestamps without zone and arrays as text, as the SQL side has them."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif field.dataType.typeName() == "array":
            column = F.concat_ws(";", column)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


class Workspace:
    """One run's topic, table and checkpoint, in a new shared folder.

    A result is read from the table after its query returns, so the table stays until `close`, or
    `close_workspaces` for all of them.
    """

    open: ClassVar[list[Workspace]] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = scratch_folder(spark)
        self.tables: list[str] = []
        self.open.append(self)
        # Bounded micro-batches bound what a crash repeats and what one write shuffles; a
        # terabyte still gives thousands of cores a few tasks each.
        self.topic = DirectoryTopic(f"{self.folder}/topic", max_bytes=STREAM_BYTES)
        self.checkpoint = f"{self.folder}/checkpoint"
        self.metrics: list[BatchMetric] = []

    def table(self, spec: Callable, folder: str = "table") -> ParquetTable:
        name = f"landed_{uuid.uuid4().hex}"
        self.tables.append(name)
        return ParquetTable(spec(name), f"{self.folder}/{folder}")

    def landed(self) -> None:
        """Remove what was only needed to land the table."""
        remove_folder(self.spark, self.topic.path)
        remove_folder(self.spark, self.checkpoint)

    def close(self) -> None:
        """Remove the table and all files; results that were not read yet are lost."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(self.spark, self.folder)
        self.open.remove(self)

    def land_events(
        self,
        table: ParquetTable,
        on_batch=None,
        quarantine: ParquetTable | None = None,
        switch: StopSwitch | None = None,
    ) -> StreamingQuery:
        return ingest_events(
            self.spark,
            self.topic,
            table,
            self.checkpoint,
            every=None,
            clock=pinned(),
            on_batch=on_batch or self.metrics.append,
            quarantine=quarantine,
            switch=switch,
        )

    def crash_first(self, land: Callable[[Callable | None], StreamingQuery]) -> None:
        """Run `land(on_batch)` until it crashes behind its first batch, and again to the end."""

        def crash(metric: BatchMetric) -> None:
            raise RuntimeError(f"crash after batch {metric.batch}")

        try:
            land(crash).awaitTermination()
        except StreamingQueryException as error:
            if "crash after batch 0" not in str(error):
                raise
        else:
            raise AssertionError("the crash did not stop the stream")
        land(self.metrics.append).awaitTermination()
        if [metric.batch for metric in self.metrics] != [0]:
            raise AssertionError(f"batch 0 was not replayed: {self.metrics}")


def close_workspaces() -> None:
    """Remove what all queries so far have written, once their results are read."""
    for work in list(Workspace.open):
        work.close()


# --- JSON events ------------------------------------------------------------------------------

EVENT_TABLE_SQL = """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp", value, value * 2 AS doubled_value,
       TIMESTAMP '2024-06-01 12:34:56' AS processing_time
FROM events
"""


@check(EVENT_TABLE_SQL)
def json_event_ingest(spark: SparkSession, tables: str) -> DataFrame:
    """Publish events as JSON, land them as a stream, read the table."""
    work = Workspace(spark)
    table = work.table(event_table)
    publish_events(as_events(events(spark, tables)), work.topic)
    work.land_events(table).awaitTermination()
    work.landed()
    return comparable(table.read(spark))


@check("SELECT CAST(event_id AS VARCHAR) AS id, ts AS \"timestamp\", value FROM events")
def mixed_publishers(spark: SparkSession, tables: str) -> DataFrame:
    """Purchases published as a batch, the rest as a stream, signups as a later batch; all land."""
    work = Workspace(spark)
    table = work.table(event_table)
    rows = as_events(events(spark, tables))
    kind = F.coalesce("event_type", F.lit(""))
    publish_events(rows.where(kind == "purchase"), work.topic)
    streamed = table_stream(spark, tables, "events.parquet", STREAM_BYTES)
    streamed = as_events(streamed.withColumn("ts", F.col("ts").cast("timestamp")))
    publish_stream(
        to_envelope(streamed.where(~kind.isin("purchase", "signup")), json_payload()),
        work.topic,
        f"{work.folder}/publisher",
    ).awaitTermination()
    publish_events(rows.where(kind == "signup"), work.topic)
    work.land_events(table).awaitTermination()
    work.landed()
    return comparable(table.read(spark).select(*EVENT.names))


@check("""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS "timestamp",
       CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value
FROM events
""")
def json_decode_permissive(spark: SparkSession, tables: str) -> DataFrame:
    """Truncated text for error events, a wrongly typed field for views; no row is lost."""
    messages = (
        as_events(events(spark, tables))
        .withColumn("text", json_payload())
        .withColumn("value", broken_text().cast("binary"))
    )
    return comparable(decode_json(messages, keep=["event_id"]))


def broken_text() -> Column:
    """The JSON in `text`, cut short for errors, with a field of the wrong type for views."""
    text = F.col("text")
    quoted = F.regexp_replace(text, r'"value":([^}]*)\}', r'"value":"v$1"}')
    return (
        F.when(F.col("event_type") == "error", F.substring_index(text, ",", 2))
        .when(F.col("event_type") == "view", quoted)
        .otherwise(text)
    )


@check("""
WITH texts AS (
  SELECT *, concat('{"id":"', event_id, '","timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'), '"')
    AS start FROM events
)
SELECT CASE WHEN event_type IN ('error', 'view') THEN 'quarantine' ELSE 'table' END AS place,
       CASE WHEN event_type IN ('error', 'view') THEN concat('key', event_id)
            WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN event_type NOT IN ('error', 'view', 'signup') THEN value END AS value,
       CASE WHEN event_type = 'error' THEN start
            WHEN event_type = 'view' THEN concat(start, ',"value":"v', value, '"}') END AS message
FROM texts
""")
def json_quarantine(spark: SparkSession, tables: str) -> DataFrame:
    """Broken messages land in a table of their own, in a batch that crashes and is replayed.

    Errors are cut short and views have a field of the wrong type, while signups are blank and land
    as rows of NULLs. Quarantined messages are told by their key.
    """
    work = Workspace(spark)
    table, aside = work.table(event_table), work.table(quarantine_table, "quarantine")
    rows = as_events(events(spark, tables)).withColumn("text", json_payload())
    payload = F.when(F.col("event_type") == "signup", F.lit(" ")).otherwise(broken_text())
    publish(to_envelope(rows, payload, message_key("event_id")), work.topic)
    work.crash_first(lambda on_batch: work.land_events(table, on_batch, aside))
    work.landed()
    landed = table.read(spark).select(
        F.lit("table").alias("place"), "id", "value", F.lit(None).cast("string").alias("message")
    )
    quarantined = aside.read(spark).select(
        F.lit("quarantine").alias("place"),
        F.col("key").cast("string").alias("id"),
        F.lit(None).cast("double").alias("value"),
        F.col("payload").cast("string").alias("message"),
    )
    return landed.unionByName(quarantined)


@check("""
SELECT concat('{"id":"', event_id, '","timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
              '","value":', value, '}') AS value
FROM events
""")
def json_encode(spark: SparkSession, tables: str) -> DataFrame:
    """Events as JSON text with microseconds."""
    return as_events(events(spark, tables)).select(json_payload().alias("value"))


@check("SELECT count(*) AS n, count(*) AS ids, TRUE AS in_range FROM events")
def check_synthetic_events(spark: SparkSession, tables: str) -> DataFrame:
    """One random event per table row: its ids are distinct and its values within bounds."""
    made = synthetic_events(events(spark, tables))
    return made.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("ids"),
        F.every((F.col("value") >= 0) & (F.col("value") < 100)).alias("in_range"),
    )


# --- topics -----------------------------------------------------------------------------------


@check("SELECT concat('key', event_id) AS key, event_id, user_id FROM events")
def keyed_envelope(spark: SparkSession, tables: str) -> DataFrame:
    """Telemetry under its message key, published and read back from the topic."""
    work = Workspace(spark)
    publish_telemetry(as_telemetry(events(spark, tables)), work.topic, "event_id")
    read = decode_telemetry(messages(spark, work.topic), keep=["key"])
    return read.select(
        F.col("key").cast("string").alias("key"),
        F.substring_index(F.col("correlation_ids")[0], "c", -1).cast("bigint").alias("event_id"),
        F.substring_index("vin", "VIN", -1).cast("bigint").alias("user_id"),
    )


@check("""
SELECT concat('key', event_id) AS key, event_id, CAST(1 AS BIGINT) AS n_published FROM events
""")
def replay_safe_publish(spark: SparkSession, tables: str) -> DataFrame:
    """A publisher crashes behind a micro-batch and publishes it again: each message is there once."""
    work = Workspace(spark)
    streamed = table_stream(spark, tables, "events.parquet", STREAM_BYTES)
    made = as_events(streamed.withColumn("ts", F.col("ts").cast("timestamp")))
    rows = to_envelope(made, json_payload(), message_key("event_id"))
    published: list[int] = []

    def crash(batch: int) -> None:
        raise RuntimeError(f"crash after batch {batch}")

    for on_batch in (crash, published.append):
        query = publish_stream(rows, work.topic, work.checkpoint, on_batch=on_batch)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if on_batch is not crash or "crash after batch 0" not in str(error):
                raise
    if published != [0]:
        raise AssertionError(f"batch 0 was not published again: {published}")
    read = messages(spark, work.topic).groupBy("key").count()
    return read.select(
        F.col("key").cast("string").alias("key"),
        F.substring_index(F.col("key").cast("string"), "key", -1).cast("bigint").alias("event_id"),
        F.col("count").alias("n_published"),
    )


# --- telemetry --------------------------------------------------------------------------------

FLOW_SQL = """
SELECT ts AS tmc_arrival_timestamp, concat('VIN', user_id) AS vin_hash,
       concat('u/', event_id, ';k/', user_id) AS data_uris, 'sensor' AS device_type,
       'US' AS region, '1.0' AS protocol_version, event_type AS flow_name,
       date_trunc('second', ts) AS flow_timestamp, concat('c', event_id) AS correlation_ids,
       concat('asset_', user_id) AS asset_id, 'type1' AS expiration_length_types,
       CAST(2024 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day,
       CAST(12 AS INTEGER) AS hour, concat('flow_', event_type) AS flow_aui
FROM events
"""


def telemetry_messages(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "event_type", telemetry_payload().alias("value"))


@check(FLOW_SQL)
def telemetry_flatten(spark: SparkSession, tables: str) -> DataFrame:
    """Encode, decode and flatten in one plan."""
    encoded = telemetry_messages(as_telemetry(events(spark, tables)))
    return comparable(flow_rows(encoded, pinned()))


@check("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS flow_name,
       CASE WHEN event_type = 'error' THEN NULL ELSE concat('VIN', user_id) END AS vin_hash,
       CASE WHEN event_type = 'error' THEN NULL ELSE concat('u/', event_id, ';k/', user_id) END
         AS data_uris
FROM events
""")
def telemetry_permissive(spark: SparkSession, tables: str) -> DataFrame:
    """Errors arrive cut short and land as rows of NULLs."""
    encoded = telemetry_messages(as_telemetry(events(spark, tables)))
    cut = F.when(
        F.col("event_type") == "error", F.expr("substring(value, 1, length(value) - 1)")
    ).otherwise(F.col("value"))
    decoded = decode_telemetry(
        encoded.withColumn("value", cut), keep=["event_id"], options={"mode": "PERMISSIVE"}
    )
    flat = flatten_telemetry(decoded, pinned(), keep=["event_id"])
    uris = F.when(F.col("data_uris").isNotNull(), F.concat_ws(";", "data_uris")).alias("data_uris")
    return flat.select("event_id", "flow_name", "vin_hash", uris)


@check("""
SELECT CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'table' END AS place,
       CASE WHEN event_type = 'error' THEN concat('key', event_id) END AS key,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN concat('VIN', user_id) END AS vin_hash,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN concat('c', event_id) END
         AS correlation_ids,
       CASE WHEN event_type = 'error' THEN concat('c', event_id) END AS mended
FROM events
""")
def telemetry_quarantine(spark: SparkSession, tables: str) -> DataFrame:
    """Errors arrive cut short and are set aside; their bytes are kept, so they can be mended.

    The cut takes the last byte, and the check puts it back. Signups have no payload and land as rows of NULLs.
    """
    work = Workspace(spark)
    table, aside = work.table(flow_table), work.table(quarantine_table, "quarantine")
    kind = F.col("event_type")
    cut = F.when(kind == "error", F.expr("substring(value, 1, length(value) - 1)")).when(
        kind != "signup", F.col("value")
    )
    encoded = telemetry_messages(as_telemetry(events(spark, tables)))
    publish(to_envelope(encoded, cut, message_key("event_id")), work.topic)
    work.crash_first(
        lambda on_batch: ingest_telemetry(
            spark, work.topic, table, work.checkpoint,
            every=None, clock=pinned(), on_batch=on_batch, quarantine=aside,
        )
    )
    work.landed()
    none = F.lit(None).cast("string")
    landed = table.read(spark).select(
        F.lit("table").alias("place"),
        none.alias("key"),
        "vin_hash",
        F.when(F.col("correlation_ids").isNotNull(), F.concat_ws(";", "correlation_ids")).alias(
            "correlation_ids"
        ),
        none.alias("mended"),
    )
    # Every message ends in the text "type1".
    lost = as_messages(aside.read(spark)).withColumn(
        "value", F.concat("value", F.lit("1").cast("binary"))
    )
    mended = decode_telemetry(lost, keep=["key"]).select(
        F.lit("quarantine").alias("place"),
        F.col("key").cast("string").alias("key"),
        none.alias("vin_hash"),
        none.alias("correlation_ids"),
        F.concat_ws(";", "correlation_ids").alias("mended"),
    )
    return landed.unionByName(mended)


@check(FLOW_SQL + "WHERE event_type <> 'signup'")
def telemetry_flatten_nonnull(spark: SparkSession, tables: str) -> DataFrame:
    """Signups arrive without a payload and are dropped where the topic is scanned."""
    work = Workspace(spark)
    payload = F.when(F.col("event_type") != "signup", F.col("value"))
    encoded = telemetry_messages(as_telemetry(events(spark, tables)))
    publish(to_envelope(encoded, payload, message_key("event_id")), work.topic)
    return comparable(flow_rows(messages(spark, work.topic), pinned(), drop_null=True))


@check("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS flow_name,
       CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END
         AS flow_timestamp,
       CASE WHEN event_type = 'click' THEN NULL ELSE concat('VIN', user_id) END AS vin_hash,
       CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 2 END AS INTEGER) AS n_uris
FROM events
""")
def telemetry_optional_fields(spark: SparkSession, tables: str) -> DataFrame:
    """Unset sub-message, unset scalar and empty array, each on its own event type."""
    kind = F.col("event_type")
    sparse = as_telemetry(events(spark, tables)).withColumns(
        {
            "flow_metric": F.when(kind != "error", F.col("flow_metric")),
            "vin": F.when(kind != "click", F.col("vin")),
            "data_uris": F.when(kind != "view", F.col("data_uris")),
        }
    )
    decoded = decode_telemetry(telemetry_messages(sparse), keep=["event_id"])
    flat = flatten_telemetry(decoded, pinned(), keep=["event_id"])
    uris = F.size("data_uris").alias("n_uris")
    return comparable(flat.select("event_id", "flow_name", "flow_timestamp", "vin_hash", uris))


#: A message with a field of every kind, as another party may describe it. It holds its own type.
READING = """
name: "reading.proto" package: "party" syntax: "proto3"
dependency: "google/protobuf/timestamp.proto" dependency: "google/protobuf/duration.proto"
enum_type { name: "Kind"
  value { name: "CLICK" number: 0 } value { name: "ERROR" number: 1 }
  value { name: "PURCHASE" number: 2 } value { name: "SIGNUP" number: 3 }
  value { name: "VIEW" number: 4 } }
message_type { name: "Part"
  field { name: "name" number: 1 label: LABEL_OPTIONAL type: TYPE_STRING }
  field { name: "amount" number: 2 label: LABEL_OPTIONAL type: TYPE_SINT32 } }
message_type { name: "Reading"
  nested_type { name: "TagsEntry" options { map_entry: true }
    field { name: "key" number: 1 label: LABEL_OPTIONAL type: TYPE_STRING }
    field { name: "value" number: 2 label: LABEL_OPTIONAL type: TYPE_SINT64 } }
  nested_type { name: "ByNumberEntry" options { map_entry: true }
    field { name: "key" number: 1 label: LABEL_OPTIONAL type: TYPE_UINT32 }
    field { name: "value" number: 2 label: LABEL_OPTIONAL type: TYPE_MESSAGE type_name: ".party.Part" } }
  oneof_decl { name: "_note" }
  field { name: "id" number: 1 label: LABEL_OPTIONAL type: TYPE_FIXED64 }
  field { name: "user" number: 2 label: LABEL_OPTIONAL type: TYPE_UINT32 }
  field { name: "kind" number: 3 label: LABEL_OPTIONAL type: TYPE_ENUM type_name: ".party.Kind" }
  field { name: "value" number: 4 label: LABEL_OPTIONAL type: TYPE_DOUBLE }
  field { name: "half" number: 5 label: LABEL_OPTIONAL type: TYPE_FLOAT }
  field { name: "high" number: 6 label: LABEL_OPTIONAL type: TYPE_BOOL }
  field { name: "raw" number: 7 label: LABEL_OPTIONAL type: TYPE_BYTES }
  field { name: "note" number: 8 label: LABEL_OPTIONAL type: TYPE_STRING oneof_index: 0
          proto3_optional: true }
  field { name: "at" number: 9 label: LABEL_OPTIONAL type: TYPE_MESSAGE
          type_name: ".google.protobuf.Timestamp" }
  field { name: "took" number: 10 label: LABEL_OPTIONAL type: TYPE_MESSAGE
          type_name: ".google.protobuf.Duration" }
  field { name: "tags" number: 11 label: LABEL_REPEATED type: TYPE_MESSAGE
          type_name: ".party.Reading.TagsEntry" }
  field { name: "by_number" number: 12 label: LABEL_REPEATED type: TYPE_MESSAGE
          type_name: ".party.Reading.ByNumberEntry" }
  field { name: "kinds" number: 13 label: LABEL_REPEATED type: TYPE_ENUM type_name: ".party.Kind" }
  field { name: "parts" number: 14 label: LABEL_REPEATED type: TYPE_MESSAGE type_name: ".party.Part" }
  field { name: "cause" number: 15 label: LABEL_OPTIONAL type: TYPE_MESSAGE
          type_name: ".party.Reading" } }
"""
READING_MESSAGE = "party.Reading"


def reading_descriptors() -> bytes:
    from google.protobuf import descriptor_pb2, duration_pb2, text_format, timestamp_pb2

    files = descriptor_pb2.FileDescriptorSet()
    for module in (timestamp_pb2, duration_pb2):
        module.DESCRIPTOR.CopyToProto(files.file.add())
    text_format.Parse(READING, files.file.add())
    return files.SerializeToString()


@check("""
SELECT nullif(event_id, 0) AS id, CAST(nullif(user_id, 0) AS INTEGER) AS user,
       CASE WHEN event_type <> 'click' THEN upper(event_type) END AS kind,
       CASE WHEN value <> 0 THEN value END AS value,
       CASE WHEN value <> 0 THEN CAST(CAST(value / 2 AS FLOAT) AS DOUBLE) END AS half,
       CASE WHEN value > 20 THEN TRUE END AS high,
       props AS raw, CASE WHEN event_type <> 'view' THEN '' END AS note,
       CASE WHEN event_type <> 'error' THEN ts END AS "at",
       CAST(event_id - 5000 AS BIGINT) AS took_seconds,
       CASE WHEN event_type = 'signup' THEN NULL ELSE -user_id END AS tag,
       concat(event_type, event_id) AS part_name, CAST(-1 AS INTEGER) AS part_amount,
       concat(upper(event_type), ';CLICK') AS kinds,
       CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 2 END AS INTEGER) AS n_parts,
       CASE WHEN event_type = 'purchase' THEN nullif(user_id, 0) END AS cause,
       CASE WHEN event_type = 'purchase' THEN nullif(event_id, 0) END AS cause_of_cause
FROM events
""")
def protobuf_all_types(spark: SparkSession, tables: str) -> DataFrame:
    """Messages with fields of every kind, in columns derived from their descriptors, and back.

    Unset fields of proto3 that were sent as 0, false or empty come back as NULL, the optional one
    does not. Purchases hold a message of their own type, which holds another.
    """
    form = described_format(
        READING_MESSAGE, reading_descriptors(), {"recursive.fields.max.depth": "3"}
    )
    part = F.struct(
        F.concat("event_type", "event_id").alias("name"), F.lit(-1).alias("amount")
    )
    kind, kind_name = F.col("event_type"), F.upper("event_type")
    level = {
        "user": F.col("user_id").cast("int"),
        "kind": kind_name,
        "half": (F.col("value") / 2).cast("float"),
        "high": F.col("value") > 20,
        "raw": F.col("props").cast("binary"),
        "note": F.when(kind != "view", ""),
        "at": F.when(kind != "error", F.col("ts")),
        "took": F.make_dt_interval(secs=F.col("event_id") - 5000),
        "tags": F.when(kind != "signup", F.create_map(kind, -F.col("user_id"))),
        "by_number": F.create_map(F.lit(7), part),
        "kinds": F.array(kind_name, F.lit("CLICK")),
        "parts": F.when(kind != "view", F.array(part, part)),
    }

    def message(schema: StructType, **values: Column) -> Column:
        """A struct of the schema; what is not given is unset."""
        return F.struct(
            *[
                (values[f.name] if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ]
        )

    schema = form.schema
    inner = schema["cause"].dataType
    deepest = message(inner["cause"].dataType, id=F.col("event_id"))
    cause = message(inner, id=F.col("user_id"), cause=deepest)
    whole = message(
        schema,
        id=F.col("event_id"),
        value=F.col("value"),
        cause=F.when(kind == "purchase", cause),
        **level,
    )
    sent = events(spark, tables).select(encode_message(whole, form).alias("payload"))
    read = sent.select(decode_message("payload", form).alias("r"))
    return comparable(
        read.select(
            *[f"r.{name}" for name in ("id", "user", "kind", "value")],
            F.col("r.half").cast("double").alias("half"),
            "r.high",
            F.col("r.raw").cast("string").alias("raw"),
            "r.note",
            "r.at",
            F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.col("r.took")).alias("took_seconds"),
            F.get(F.map_values("r.tags"), F.lit(0)).alias("tag"),
            F.col("r.by_number")[7]["name"].alias("part_name"),
            F.col("r.by_number")[7]["amount"].alias("part_amount"),
            F.col("r.kinds").alias("kinds"),
            F.size("r.parts").alias("n_parts"),
            F.col("r.cause.id").alias("cause"),
            F.col("r.cause.cause.id").alias("cause_of_cause"),
        )
    )


@check(FLOW_SQL)
def telemetry_ingest(spark: SparkSession, tables: str) -> DataFrame:
    """Publish telemetry, land it as a stream in the bucketed table, read the table."""
    work = Workspace(spark)
    table = work.table(flow_table)
    publish_telemetry(as_telemetry(events(spark, tables)), work.topic, "event_id")
    query = ingest_telemetry(
        spark, work.topic, table, work.checkpoint, every=None, clock=pinned()
    )
    query.awaitTermination()
    work.landed()
    return comparable(table.read(spark))


@check("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
FROM events
""")
def ingest_date_parts(spark: SparkSession, tables: str) -> DataFrame:
    """Date parts of a clock, here the event's own time."""
    parts = [part.alias(name) for name, part in date_parts(F.col("ts")).items()]
    return events(spark, tables).select("event_id", *parts)


# --- generated words --------------------------------------------------------------------------


@check("""
SELECT concat('word_', event_id) AS word, TIMESTAMP '2024-06-01 12:34:56' AS "timestamp"
FROM events
""")
def check_word_rows(spark: SparkSession, tables: str) -> DataFrame:
    """A word per event number."""
    numbers = events(spark, tables).select(F.col("event_id").alias("value"))
    return comparable(word_rows(numbers, pinned()))


@check("""
SELECT concat('word_', event_id) AS word, TIMESTAMP '2024-06-01 12:34:56' AS "timestamp"
FROM events
""")
def word_rows_stream(spark: SparkSession, tables: str) -> DataFrame:
    """Stream the events table through the word job into CSV files, read them back."""
    folder = Workspace(spark).folder
    stream = table_stream(spark, tables, "events.parquet", STREAM_BYTES)
    numbers = stream.select(F.col("event_id").alias("value"))
    write_words(
        numbers, f"{folder}/words", f"{folder}/checkpoint", every=None, clock=pinned()
    ).awaitTermination()
    reader = spark.read.schema("word string, timestamp timestamp").option("timeZone", "UTC")
    return comparable(reader.csv(f"{folder}/words"))


@check("""
SELECT concat('word_', event_id) AS word, TIMESTAMP '2024-06-01 12:34:56' AS "timestamp"
FROM events WHERE event_type IN ('click', 'purchase')
""")
def rate_words(spark: SparkSession, tables: str) -> DataFrame:
    """Numbers of the rate source, as many as events go up to, through the word job.

    A stream of generated numbers is joined to the clicks and purchases of the table by their number,
    so that words of these come out; one micro-batch of numbers is drained. The bound of the source
    is the table's largest number, so the work grows with it.
    """
    numbered = events(spark, tables).where(F.col("event_type").isin("click", "purchase"))
    largest = numbered.agg(F.max("event_id")).first()[0]
    made = rate_batches(
        spark,
        1 if largest is None else largest + 1,
        max(1, (largest or 0) // RATE_ROWS_A_TASK),
    )
    numbers = made.select("value").join(
        numbered.select(F.col("event_id").alias("value")), "value"
    )
    folder = Workspace(spark).folder
    write_words(
        numbers, f"{folder}/words", f"{folder}/checkpoint", every=None, clock=pinned()
    ).awaitTermination()
    reader = spark.read.schema("word string, timestamp timestamp").option("timeZone", "UTC")
    return comparable(reader.csv(f"{folder}/words"))


# --- files ------------------------------------------------------------------------------------


@check("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
""")
def check_csv_to_parquet(spark: SparkSession, tables: str) -> DataFrame:
    """Headered CSV of the part table, copied to Parquet."""
    folder = Workspace(spark).folder
    spark.read.parquet(f"{tables}/part.parquet").write.csv(f"{folder}/csv", header=True)
    csv_to_parquet(spark, f"{folder}/csv", f"{folder}/parquet")
    return spark.read.parquet(f"{folder}/parquet")


# --- streaming guarantees ---------------------------------------------------------------------


@check("SELECT count(*) AS n_counted, count(*) AS n_landed FROM events")
def batch_metrics(spark: SparkSession, tables: str) -> DataFrame:
    """The counts reported per micro-batch add up to the rows in the table."""
    work = Workspace(spark)
    table = work.table(event_table)
    # Three publishes are three files at least, and each file a micro-batch.
    rows = as_events(events(spark, tables))
    kind = F.coalesce("event_type", F.lit(""))
    for some in (kind == "purchase", kind == "view", ~kind.isin("purchase", "view")):
        publish_events(rows.where(some), work.topic)
    work.topic = DirectoryTopic(work.topic.path, max_files=1)
    work.land_events(table).awaitTermination()
    work.landed()
    counted = sum(metric.rows for metric in work.metrics)
    return table.read(spark).agg(
        F.lit(counted).cast("bigint").alias("n_counted"), F.count(F.lit(1)).alias("n_landed")
    )


@check("""
SELECT count(*) AS n_reported, count(*) AS n_landed, TRUE AS ranges_join, TRUE AS took_time
FROM events
""")
def batch_progress(spark: SparkSession, tables: str) -> DataFrame:
    """Spark's reports on the micro-batches of a stream that is stopped between two and restarted.

    Their rows add up to the table's, each begins where the one before ended, and each took time.
    """
    work = Workspace(spark)
    table = work.table(event_table)
    rows = as_events(events(spark, tables))
    kind = F.coalesce("event_type", F.lit(""))
    for some in (kind == "purchase", kind == "view", ~kind.isin("purchase", "view")):
        publish_events(rows.where(some), work.topic)
    work.topic = DirectoryTopic(work.topic.path, max_files=1)
    reports: list[Progress] = []
    listener = watch(spark, reports.append)
    try:
        for _ in range(2):
            switch = StopSwitch()
            # The first stream is told to stop while its first batch is at work.
            first = not work.metrics

            def on_batch(metric: BatchMetric, switch=switch, first=first) -> None:
                work.metrics.append(metric)
                if first:
                    switch.thrown.set()

            query = work.land_events(table, on_batch, switch=switch)
            await_end(query)
            if not listener.wait(str(query.id)):
                raise AssertionError("the end of the stream was not reported")
            listener.ended.clear()
            if first and len(work.metrics) != 1:
                raise AssertionError(f"the stream went on: {work.metrics}")
    finally:
        spark.streams.removeListener(listener)
    work.landed()
    if [report.batch for report in reports] != list(range(len(reports))) or len(reports) < 3:
        raise AssertionError(f"batches are missing: {reports}")
    joins = [
        earlier.sources[0].end == later.sources[0].start
        for earlier, later in zip(reports, reports[1:], strict=False)
    ]
    return table.read(spark).agg(
        F.lit(sum(report.rows for report in reports)).cast("bigint").alias("n_reported"),
        F.count(F.lit(1)).alias("n_landed"),
        F.lit(all(joins)).alias("ranges_join"),
        F.lit(all(report.seconds > 0 for report in reports)).alias("took_time"),
    )


@check("SELECT CAST(event_id AS VARCHAR) AS id, value FROM events")
def checkpoint_resume(spark: SparkSession, tables: str) -> DataFrame:
    """A restart lands only what was published since."""
    work = Workspace(spark)
    table = work.table(event_table)
    rows = as_events(events(spark, tables))
    late = F.col("event_type").eqNullSafe("purchase")
    publish_events(rows.where(~late), work.topic)
    work.land_events(table).awaitTermination()
    work.land_events(table).awaitTermination()
    publish_events(rows.where(late), work.topic)
    work.land_events(table).awaitTermination()
    work.landed()
    return table.read(spark).select("id", "value")


@check("""
SELECT CAST(event_id AS VARCHAR) AS id, value, (SELECT count(*) FROM events) AS landed_at_crash
FROM events
""")
def replay_safe_append(spark: SparkSession, tables: str) -> DataFrame:
    """A crash after the write and before the checkpoint commit; the restart replays the batch.

    What had landed at the crash is part of the result: all rows, so the restart wrote them again.
    """
    work = Workspace(spark)
    table = work.table(event_table)
    publish_events(as_events(events(spark, tables)), work.topic)

    def crash(metric: BatchMetric) -> None:
        raise RuntimeError(f"crash after batch {metric.batch}")

    try:
        work.land_events(table, on_batch=crash).awaitTermination()
    except StreamingQueryException as error:
        if "crash after batch 0" not in str(error):
            raise
    else:
        raise AssertionError("the crash did not stop the stream")
    at_crash = table.read(spark).count()
    work.land_events(table).awaitTermination()
    if [metric.batch for metric in work.metrics] != [0]:
        raise AssertionError(f"batch 0 was not replayed: {work.metrics}")
    work.landed()
    return table.read(spark).select(
        "id", "value", F.lit(at_crash).cast("bigint").alias("landed_at_crash")
    )


# --- table layout -----------------------------------------------------------------------------


def land_flows(spark: SparkSession, tables: str, clock: Column) -> ParquetTable:
    """The whole events table as telemetry, appended in one batch."""
    table = Workspace(spark).table(flow_table)
    table.create(spark)
    flows = flow_rows(telemetry_messages(as_telemetry(events(spark, tables))), clock)
    table.append(flows, uuid.uuid4().hex, 0)
    return table


@check("""
SELECT c.name, c.type, count(*) AS n_values
FROM events, (VALUES
  ('tmc_arrival_timestamp', 'timestamp'), ('vin_hash', 'string'),
  ('data_uris', 'array<string>'), ('device_type', 'string'), ('region', 'string'),
  ('protocol_version', 'string'), ('flow_name', 'string'), ('flow_timestamp', 'timestamp'),
  ('correlation_ids', 'array<string>'), ('asset_id', 'string'),
  ('expiration_length_types', 'array<string>'), ('year', 'int'), ('month', 'int'),
  ('day', 'int'), ('hour', 'int'), ('flow_aui', 'string')) AS c(name, type)
GROUP BY c.name, c.type
""")
def table_ddl(spark: SparkSession, tables: str) -> DataFrame:
    """Creating the table again keeps its rows; every declared column is filled."""
    table = land_flows(spark, tables, pinned())
    table.create(spark)
    rows = table.read(spark)
    counts = rows.agg(*[F.count(name).alias(name) for name in rows.columns])
    described = [
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.col(n).alias("n_values"))
        for n, t in rows.dtypes
    ]
    return counts.select(F.inline(F.array(*described)))


@check("""
SELECT concat('c', event_id) AS correlation_ids, event_type AS flow_name,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) // 12 * 12 AS INTEGER) AS hour
FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND hour(ts) < 12
""")
def partitioned_scan(spark: SparkSession, tables: str) -> DataFrame:
    """Land by half day, read the mornings of two weeks: no other partition is listed."""
    arrival = F.unix_seconds("tmc_arrival_timestamp")
    half_day = 12 * 60 * 60
    table = land_flows(spark, tables, F.timestamp_seconds(arrival - arrival % half_day))
    rows = table.read(spark, year=2024, month=1)
    mornings = rows.where(F.col("day").between(8, 21) & (F.col("hour") < 12))
    return comparable(mornings.select("correlation_ids", "flow_name", "day", "hour"))


@check(FLOW_SQL + "WHERE event_type = 'purchase'")
def bucket_scan(spark: SparkSession, tables: str) -> DataFrame:
    """Read one flow: only its bucket is listed."""
    return comparable(land_flows(spark, tables, pinned()).read(spark, flow_aui="flow_purchase"))


@check(FLOW_SQL + """
WHERE user_id % 2 = 0 AND event_type IN (
  SELECT event_type FROM events WHERE event_type < 'p' GROUP BY event_type
)
""")
def bucket_join(spark: SparkSession, tables: str) -> DataFrame:
    """Join the flow table to the flows of some event types: only their buckets are read."""
    table = land_flows(spark, tables, pinned())
    chosen = events(spark, tables).where(F.col("event_type") < "p")
    keys = chosen.select(F.concat(F.lit("flow_"), "event_type").alias("flow_aui"))
    found = table.matching(spark, keys, "flow_aui")
    user = F.substring_index("vin_hash", "VIN", -1).cast("bigint")
    return comparable(found.where(user % 2 == 0))


@check("""
WITH keys AS (
  SELECT event_id, concat('flow_', event_type, '_', user_id) AS s FROM events
), words AS (
  SELECT event_id, CAST(strlen(s) AS UBIGINT) AS n,
    list_transform(range(0, (strlen(s) + 3) // 4), lambda i:
      CAST(list_sum(list_transform(range(0, 4), lambda j:
        CASE WHEN 4 * i + j < strlen(s)
             THEN CAST(ord(s[4 * i + j + 1]) AS BIGINT) << (8 * j) ELSE 0 END)) AS UBIGINT)) AS ks
  FROM keys
), scrambled AS (
  SELECT event_id, n, list_transform(
    list_transform(ks, lambda k: (k * 3432918353) & 4294967295), lambda k:
      ((((k << 15) & 4294967295) | (k >> 17)) * 461845907) & 4294967295) AS ks
  FROM words
), body AS (
  SELECT event_id, n, CASE WHEN n % 4 > 0 THEN ks[-1] ELSE 0 END AS tail,
    list_reduce(ks[:n // 4], lambda h, k:
      ((((xor(h, k) << 13) & 4294967295) | (xor(h, k) >> 19)) * 5 + 3864292196) & 4294967295,
      CAST(0 AS UBIGINT)) AS h
  FROM scrambled
),
joined AS (SELECT event_id, xor(xor(h, tail), n) AS h FROM body),
first AS (SELECT event_id, (xor(h, h >> 16) * 2246822507) & 4294967295 AS h FROM joined),
second AS (SELECT event_id, (xor(h, h >> 13) * 3266489909) & 4294967295 AS h FROM first)
SELECT event_id, CAST((xor(h, h >> 16) & 2147483647) % 16 AS INTEGER) AS bucket FROM second
""")
def bucket16(spark: SparkSession, tables: str) -> DataFrame:
    """The bucket of a text key per event."""
    key = F.concat(F.lit("flow_"), "event_type", F.lit("_"), "user_id")
    return events(spark, tables).select(
        "event_id", iceberg_bucket(FLOW_BUCKETS, key).alias("bucket")
    )
