"""Message topics, and reading them as streams.

A topic is on a Kafka broker, or in a directory of Parquet files with the same envelope columns
for use without a broker. `sinks.publish` writes either kind.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from eventlake.schemas import ENVELOPE
from eventlake.session import folder_exists, make_folder


@dataclass(frozen=True)
class KafkaTopic:
    """A broker topic; needs the `spark-sql-kafka` package.

    `max_offsets` bounds a micro-batch, which a first run over a long backlog wants.
    `min_partitions` splits a hot broker partition over several tasks. `options` go to reader and
    writer alike, as those of a secured broker do; `reading` and `writing` to one of them.
    """

    servers: str
    topic: str
    starting_offsets: str = "earliest"
    max_offsets: int | None = None
    min_partitions: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    reading: Mapping[str, str] = field(default_factory=dict)
    writing: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": self.max_offsets,
            "minPartitions": self.min_partitions,
            **self.options,
            **self.reading,
        }
        return {name: str(value) for name, value in chosen.items() if value is not None}

    def writer_options(self) -> dict[str, str]:
        """A record counts as written only when all in-sync replicas have it."""
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            "kafka.acks": "all",
            **self.options,
            **self.writing,
        }


@dataclass(frozen=True)
class DirectoryTopic:
    """Envelope rows in Parquet files; files already there count as the earliest messages.

    Batches are files in the folder itself, a streamed micro-batch is a folder of its own below it,
    whose files appear once the batch is committed.
    """

    path: str
    max_files: int | None = None
    max_bytes: int | None = None

    def reader_options(self) -> dict[str, str]:
        chosen = {
            "recursiveFileLookup": "true",
            "maxFilesPerTrigger": self.max_files,
            "maxBytesPerTrigger": self.max_bytes,
        }
        return {name: str(value) for name, value in chosen.items() if value is not None}


Topic = KafkaTopic | DirectoryTopic


#: The log that Spark's file sink leaves; who reads its folder sees only the files it lists.
SINK_LOG = "_spark_metadata"


def refuse_sink_log(spark: SparkSession, topic: DirectoryTopic) -> None:
    if folder_exists(spark, f"{topic.path}/{SINK_LOG}"):
        raise ValueError(
            f"{topic.path} was written by Spark's file sink, whose log hides other messages"
        )


def messages(spark: SparkSession, topic: DirectoryTopic) -> DataFrame:
    """All messages that are in a directory topic now."""
    refuse_sink_log(spark, topic)
    reader = spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true")
    return reader.parquet(topic.path)


def message_stream(spark: SparkSession, topic: Topic) -> DataFrame:
    """The messages of a topic from the earliest on, as a streaming DataFrame."""
    reader = spark.readStream.options(**topic.reader_options())
    if isinstance(topic, KafkaTopic):
        return reader.format("kafka").load()
    refuse_sink_log(spark, topic)
    make_folder(spark, topic.path)
    return reader.schema(ENVELOPE).parquet(topic.path)
