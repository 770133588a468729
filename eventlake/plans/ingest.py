"""Continuous jobs that land a message topic in a lake table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.functions.protobuf import READ_OPTIONS, MessageFormat
from eventlake.operators.decode import decode_json, decode_telemetry
from eventlake.operators.shape import enrich_events, flatten_telemetry
from eventlake.schemas import ENVELOPE, EVENT_COLUMNS, FLOW_COLUMNS
from eventlake.sinks.quarantine import SET_ASIDE, Quarantine, message_to_keep
from eventlake.sinks.tables import LakeTable
from eventlake.sources.topics import Topic, message_stream
from eventlake.streaming.batches import BatchMetric, append_batches, log_batch
from eventlake.streaming.control import JSON_EVENT_INTERVAL, TELEMETRY_INTERVAL
from eventlake.streaming.progress import StopSwitch


CORRUPT, WHOLE = "corrupt_message", "whole_message"


def event_rows(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """JSON event messages as rows of the event table."""
    return enrich_events(decode_json(messages), clock)


def set_aside(decoded: DataFrame, names: list[str], clock: Column | None) -> DataFrame:
    """The columns of a table, and the message where the row could not be read."""
    message = F.when(F.col(CORRUPT).isNotNull(), message_to_keep(WHOLE, clock))
    return decoded.select(*names, message.alias(SET_ASIDE))


def with_envelope(messages: DataFrame) -> DataFrame:
    return messages.withColumn(WHOLE, F.struct(*ENVELOPE.names))


def event_rows_or_messages(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """Rows of the event table, those of messages that cannot be read with `SET_ASIDE`."""
    decoded = decode_json(with_envelope(messages), keep=[WHOLE], corrupt=CORRUPT)
    return set_aside(enrich_events(decoded, clock), EVENT_COLUMNS.names, clock)


def flow_rows_or_messages(
    messages: DataFrame,
    clock: Column | None = None,
    drop_null: bool = False,
    form: MessageFormat | None = None,
    engine: str = "auto",
    options: Mapping[str, str] = READ_OPTIONS,
) -> DataFrame:
    """Rows of the flow table, those of messages that cannot be read with `SET_ASIDE`."""
    decoded = decode_telemetry(
        with_envelope(messages),
        keep=[WHOLE],
        drop_null=drop_null,
        form=form,
        engine=engine,
        options={**options, "mode": "PERMISSIVE"},
        corrupt=CORRUPT,
    )
    return set_aside(
        flatten_telemetry(decoded, clock, keep=[WHOLE, CORRUPT]), FLOW_COLUMNS.names, clock
    )


def flow_rows(
    messages: DataFrame,
    clock: Column | None = None,
    drop_null: bool = False,
    form: MessageFormat | None = None,
    engine: str = "auto",
    options: Mapping[str, str] = READ_OPTIONS,
) -> DataFrame:
    """Telemetry messages as rows of the flow table."""
    decoded = decode_telemetry(
        messages, drop_null=drop_null, form=form, engine=engine, options=options
    )
    return flatten_telemetry(decoded, clock)


def ingest_events(
    spark: SparkSession,
    topic: Topic,
    table: LakeTable,
    checkpoint: str,
    every: str | None = JSON_EVENT_INTERVAL,
    clock: Column | None = None,
    on_batch: Callable[[BatchMetric], None] = log_batch,
    quarantine: LakeTable | None = None,
    switch: StopSwitch | None = None,
) -> StreamingQuery:
    """Land JSON events; the caller waits on the query it returns.

    Messages that do not parse, or have a field of the wrong type, land as rows with NULLs, or as
    they came in the `quarantine` table, if there is one.
    """
    table.create(spark)
    messages = message_stream(spark, topic)
    if quarantine is None:
        rows, sink = event_rows(messages, clock), table
    else:
        quarantine.create(spark)
        rows, sink = event_rows_or_messages(messages, clock), Quarantine(table, quarantine)
    return append_batches(rows, sink, checkpoint, every, on_batch, switch)


def ingest_telemetry(
    spark: SparkSession,
    topic: Topic,
    table: LakeTable,
    checkpoint: str,
    every: str | None = TELEMETRY_INTERVAL,
    clock: Column | None = None,
    drop_null: bool = False,
    form: MessageFormat | None = None,
    engine: str = "auto",
    on_batch: Callable[[BatchMetric], None] = log_batch,
    options: Mapping[str, str] = READ_OPTIONS,
    quarantine: LakeTable | None = None,
    switch: StopSwitch | None = None,
) -> StreamingQuery:
    """Land Protobuf telemetry; the caller waits on the query it returns.

    `options` are those of the decoder, `mode` among them. With a `quarantine` table malformed
    messages land there as they came, whatever the mode.
    """
    table.create(spark)
    messages = message_stream(spark, topic)
    if quarantine is None:
        rows, sink = flow_rows(messages, clock, drop_null, form, engine, options), table
    else:
        quarantine.create(spark)
        rows = flow_rows_or_messages(messages, clock, drop_null, form, engine, options)
        sink = Quarantine(table, quarantine)
    return append_batches(rows, sink, checkpoint, every, on_batch, switch)
