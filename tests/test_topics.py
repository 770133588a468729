from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventlake import cli
from eventlake.operators.decode import decode_json, decode_telemetry
from eventlake.operators.encode import sample_telemetry, to_envelope
from eventlake.plans.produce import (
    publish_synthetic_events,
    publish_telemetry,
    stream_synthetic_events,
    topic_name,
)
from eventlake.schemas import ENVELOPE
from eventlake.sinks import topics
from eventlake.sinks.topics import publish, publish_stream
from eventlake.sources.generated import rate_batches, rate_rows
from eventlake.sources.topics import DirectoryTopic, KafkaTopic, message_stream, messages


def numbered(rows, first, count):
    return to_envelope(rows.range(first, first + count), F.col("id").cast("string"))


def numbers(frame):
    return sorted(int(r[0]) for r in frame.select(F.col("value").cast("string")).collect())


def test_kafka_reader_options():
    assert KafkaTopic("a:1,b:2", "news").reader_options() == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "news",
        "startingOffsets": "earliest",
    }
    bounded = KafkaTopic(
        "a:1", "news", max_offsets=1000, min_partitions=64, options={"failOnDataLoss": "false"}
    ).reader_options()
    assert bounded["maxOffsetsPerTrigger"] == "1000"
    assert bounded["minPartitions"] == "64"
    assert bounded["failOnDataLoss"] == "false"


def test_kafka_options_for_one_side_only():
    topic = KafkaTopic(
        "a:1", "news",
        options={"kafka.security.protocol": "SSL"},
        reading={"failOnDataLoss": "false"},
        writing={"kafka.linger.ms": "5"},
    )
    assert set(topic.reader_options()) >= {"kafka.security.protocol", "failOnDataLoss"}
    assert set(topic.writer_options()) >= {"kafka.security.protocol", "kafka.linger.ms"}
    assert "kafka.linger.ms" not in topic.reader_options()
    assert "failOnDataLoss" not in topic.writer_options()


def test_kafka_writer_waits_for_all_replicas():
    assert KafkaTopic("a:1", "news").writer_options() == {
        "kafka.bootstrap.servers": "a:1",
        "topic": "news",
        "kafka.acks": "all",
    }


def test_topic_names():
    assert topic_name(KafkaTopic("a:1", "news")) == "news"
    assert topic_name(DirectoryTopic("s3a://lake/topics/news/")) == "news"


def test_published_batches_accumulate(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "news"))
    for _ in range(2):
        publish(to_envelope(spark.range(10), F.col("id").cast("string")), topic)
    assert messages(spark, topic).count() == 20


def test_published_stream(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "news"))
    rows = rate_batches(spark, per_batch=30).select(F.col("value").cast("string").alias("text"))
    made = to_envelope(rows, F.col("text"))
    publish_stream(made, topic, str(tmp_path / "checkpoint")).awaitTermination()
    assert numbers(messages(spark, topic)) == list(range(30))


def stream_of(spark, folder, first, count, files=None):
    """A stream over a new folder of numbers, in three micro-batches, or in one of so many files."""
    path = str(folder / f"numbers-{first}")
    spark.range(first, first + count, numPartitions=3).write.parquet(path)
    reader = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 3 if files else 1)
    rows = reader.parquet(path)
    if files:
        rows = rows.repartition(files)
    return to_envelope(rows, F.col("id").cast("string"))


@pytest.fixture
def landing(spark, tmp_path, table_name):
    """An ingest of the topic's numbers that goes on from its checkpoint."""
    topic = DirectoryTopic(str(tmp_path / "topic"))
    folder, checkpoint = str(tmp_path / "landed"), str(tmp_path / "landing")

    def land():
        texts = message_stream(spark, topic).select(F.col("value").cast("string"))
        writer = texts.writeStream.format("text").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(folder).awaitTermination()
        return sorted(int(r[0]) for r in spark.read.text(folder).collect())

    return topic, land


@pytest.mark.parametrize("stream_first", [False, True])
def test_batches_and_streams_share_a_topic(spark, tmp_path, landing, stream_first):
    topic, land = landing

    def batch(first, count):
        publish(numbered(spark, first, count), topic)

    def stream(first, count):
        made = stream_of(spark, tmp_path, first, count)
        publish_stream(made, topic, str(tmp_path / f"c{first}")).awaitTermination()

    if stream_first:
        stream(20, 30)
        batch(0, 20)
    else:
        batch(0, 20)
        stream(20, 30)
    assert land() == list(range(50))
    batch(50, 7)
    assert numbers(messages(spark, topic)) == land() == list(range(57))
    stream(57, 9)
    assert numbers(messages(spark, topic)) == land() == list(range(66))


def test_command_line_publishers_share_a_topic(spark, tmp_path, landing, monkeypatch):
    topic, _ = landing
    spark.range(30).write.parquet(str(tmp_path / "rate"))
    made = spark.readStream.schema("id bigint").parquet(str(tmp_path / "rate"))
    monkeypatch.setattr(cli, "rate_rows", lambda *_: made)
    monkeypatch.setattr(
        cli, "stream_synthetic_events", lambda *a: stream_synthetic_events(*a[:3], every=None)
    )
    for words in (["--count", "20"], ["--per-second", "5", "--checkpoint", str(tmp_path / "c")],
                  ["--count", "7"]):
        publishing = ["publish-events", "--directory", topic.path, *words]
        cli.run(spark, cli.parser().parse_args(publishing))
    assert decode_json(messages(spark, topic)).select("id").distinct().count() == 57


def test_a_replayed_micro_batch_is_published_once(spark, tmp_path, landing, monkeypatch):
    topic, land = landing
    made, checkpoint = stream_of(spark, tmp_path, 0, 12, files=6), str(tmp_path / "c")
    whole, moves = topics.move_file, []

    def crash(at, copies):
        """Move `at` files; the next one is copied without its source being deleted, or not at all."""

        def move(spark, source, target):
            moves.append(source)
            if len(moves) <= at:
                return whole(spark, source, target)
            if copies and len(moves) == at + 1:
                shutil.copy(source, target)
            raise OSError("no more")

        return move

    seen = []
    monkeypatch.setattr(topics, "MOVERS", 1)
    for move in (crash(0, False), crash(2, True), crash(1, False), crash(1, True)):
        moves.clear()
        monkeypatch.setattr(topics, "move_file", move)
        with pytest.raises(StreamingQueryException, match="no more"):
            publish_stream(made, topic, checkpoint).awaitTermination()
        seen.append(len(land()))
    # Readers meet the files as they come, each once.
    assert seen[0] == 0 and seen == sorted(seen) and 0 < seen[1] < 12
    monkeypatch.setattr(topics, "move_file", whole)
    publish_stream(made, topic, checkpoint).awaitTermination()
    assert land() == list(range(12)) == numbers(messages(spark, topic))
    folder = Path(topic.path)
    assert not list((folder / "_staging").iterdir())
    assert [note.suffix for note in (folder / "_notes").iterdir() if note.suffix != ".crc"] == [".done"]


@pytest.mark.parametrize("moment", ["staged", "noted", "moved", "done"])
def test_a_publisher_that_dies_loses_and_doubles_nothing(spark, tmp_path, landing, monkeypatch, moment):
    """Before the note is whole, behind it, behind the moves, and behind all."""
    topic, land = landing
    rows = numbered(spark, 0, 30).repartition(5)
    write, make, done = topics.write_note, topics.make_folder, []

    def write_note(spark, path, lines):
        if moment == "staged":
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            Path(path).write_text("part-0000")  # cut short
            raise OSError("died")
        if moment == "moved" and path.endswith(".done"):
            raise OSError("died")
        write(spark, path, lines)
        if moment == "done" and path.endswith(".done"):
            raise OSError("died")

    def make_folder(*arguments):
        if moment == "noted":
            raise OSError("died")
        return make(*arguments)

    monkeypatch.setattr(topics, "write_note", write_note)
    monkeypatch.setattr(topics, "make_folder", make_folder)
    for _ in range(2):
        if moment == "done" and done:
            break
        with pytest.raises(OSError, match="died"):
            topics.publish_micro_batch(rows, topic, "run", 3)
        done.append(land())
    monkeypatch.undo()
    topics.publish_micro_batch(numbered(spark, 0, 30).repartition(2), topic, "run", 3)
    topics.publish_micro_batch(numbered(spark, 0, 30).repartition(3), topic, "run", 3)
    assert land() == list(range(30)) == numbers(messages(spark, topic))


def test_lost_files_are_not_passed_over(spark, tmp_path, monkeypatch):
    topic = DirectoryTopic(str(tmp_path / "news"))
    monkeypatch.setattr(topics, "move_file", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError, match="died"):
        topics.publish_micro_batch(numbered(spark, 0, 9), topic, "run", 0)
    monkeypatch.undo()
    shutil.rmtree(f"{topic.path}/_staging")
    with pytest.raises(OSError, match="committed files are gone"):
        topics.publish_micro_batch(numbered(spark, 0, 9), topic, "run", 0)


def test_batches_of_an_earlier_version_are_not_published_again(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "news"))
    numbered(spark, 0, 9).write.parquet(f"{topic.path}/run-{7:010d}")
    topics.publish_micro_batch(numbered(spark, 0, 9), topic, "run", 7)
    assert numbers(messages(spark, topic)) == list(range(9))


def test_an_empty_micro_batch(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "news"))
    for _ in range(2):
        topics.publish_micro_batch(numbered(spark, 0, 0), topic, "run", 0)
    assert messages(spark, topic).count() == 0


def test_a_topic_of_sparks_own_file_sink_is_refused(spark, tmp_path):
    path = str(tmp_path / "news")
    made = stream_of(spark, tmp_path, 0, 5)
    writer = made.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start(path).awaitTermination()
    topic = DirectoryTopic(path)
    for use in (
        lambda: publish(numbered(spark, 5, 2), topic),
        lambda: publish_stream(made, topic, str(tmp_path / "d")),
        lambda: message_stream(spark, topic),
        lambda: messages(spark, topic),
    ):
        with pytest.raises(ValueError, match="file sink"):
            use()


def test_later_publishes_are_numbered_above_earlier_ones(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "news"))
    for first in (0, 10, 20):
        publish(numbered(spark, first, 10), topic)
    found = messages(spark, topic)
    assert found.select("partition", "offset").distinct().count() == 30
    by_publish = F.floor(F.col("value").cast("string").cast("int") / 10)
    bounds = found.groupBy(by_publish.alias("n")).agg(F.min("offset"), F.max("offset"))
    rows = sorted(map(tuple, bounds.collect()))
    assert rows[0][2] < rows[1][1] and rows[1][2] < rows[2][1]


def test_random_events_reach_the_topic(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "events"))
    publish_synthetic_events(spark.range(50), topic)
    found = messages(spark, topic)
    assert found.where("key IS NOT NULL").isEmpty()
    decoded = decode_json(found)
    assert decoded.where("id IS NOT NULL AND value >= 0 AND value < 100").count() == 50


def test_streamed_random_events_differ_between_batches(spark, tmp_path):
    spark.range(40, numPartitions=4).write.parquet(str(tmp_path / "numbers"))
    reader = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1)
    topic = DirectoryTopic(str(tmp_path / "events"))
    rows = reader.parquet(str(tmp_path / "numbers"))
    query = stream_synthetic_events(rows, topic, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    made = decode_json(messages(spark, topic)).collect()
    assert len({r.id for r in made}) == len({r.value for r in made}) == len(made) == 40
    assert len({r.timestamp for r in made}) == 4


def test_sample_telemetry_reaches_the_topic(spark, tmp_path):
    topic = DirectoryTopic(str(tmp_path / "telemetry"))
    publish_telemetry(sample_telemetry(spark.range(90)), topic, "id")
    rows = decode_telemetry(messages(spark, topic), keep=["key"]).collect()
    assert {bytes(r.key) for r in rows} == {f"key{i}".encode() for i in range(90)}
    assert {r.vin for r in rows} == {f"VIN{i}" for i in range(90)}
    flows = {r.flow_metric.flow_aui for r in rows if r.flow_metric}
    assert len(flows) == 40 and len({r.region for r in rows}) == 7
    assert sum(r.flow_metric is None for r in rows) == 10
    assert {len(r.data_uris) for r in rows} == {1, 2, 3}
    assert all(r.tmc_arrival_timestamp.microsecond == 0 for r in rows)


def test_streams_are_streams(spark, tmp_path):
    stream = message_stream(spark, DirectoryTopic(str(tmp_path / "not there yet")))
    assert stream.isStreaming and stream.schema == ENVELOPE
    rates = rate_rows(spark)
    assert rates.isStreaming and rates.dtypes == [("timestamp", "timestamp"), ("value", "bigint")]
