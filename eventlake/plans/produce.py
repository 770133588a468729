"""Jobs that publish messages, and the generated-word job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.functions.protobuf import MessageFormat
from eventlake.operators.encode import (
    json_payload,
    message_key,
    synthetic_events,
    telemetry_payload,
    to_envelope,
)
from eventlake.operators.shape import word_rows
from eventlake.sinks.files import csv_stream
from eventlake.sinks.topics import publish, publish_stream
from eventlake.sources.topics import KafkaTopic, Topic
from eventlake.streaming.control import WORD_INTERVAL


def topic_name(topic: Topic) -> str:
    return topic.topic if isinstance(topic, KafkaTopic) else topic.path.rstrip("/").split("/")[-1]


def publish_events(events: DataFrame, topic: Topic) -> None:
    """Publish rows with the event columns as keyless JSON messages."""
    publish(to_envelope(events, json_payload(), topic=topic_name(topic)), topic)


def publish_synthetic_events(rows: DataFrame, topic: Topic) -> None:
    """Publish one random event per row of `rows`."""
    publish_events(synthetic_events(rows), topic)


def stream_synthetic_events(
    rows: DataFrame, topic: Topic, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Publish one random event per streamed row; the caller waits on the query."""
    events = to_envelope(synthetic_events(rows), json_payload(), topic=topic_name(topic))
    return publish_stream(events, topic, checkpoint, every)


def publish_telemetry(
    telemetry: DataFrame,
    topic: Topic,
    number: Column | str,
    form: MessageFormat | None = None,
    engine: str = "auto",
) -> None:
    """Publish rows with the telemetry columns as Protobuf messages, keyed by their number."""
    payload = telemetry_payload(form, engine)
    publish(to_envelope(telemetry, payload, message_key(number), topic_name(topic)), topic)


def write_words(
    numbers: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = WORD_INTERVAL,
    clock: Column | None = None,
) -> StreamingQuery:
    """Write a word per streamed number to CSV files; the caller waits on the query."""
    return csv_stream(word_rows(numbers, clock), path, checkpoint, every)
