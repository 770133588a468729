"""Publishing envelope rows to a topic."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.session import (
    file_sizes,
    folder_exists,
    make_folder,
    move_file,
    read_note,
    remove_folder,
    write_note,
)
from eventlake.sources.topics import DirectoryTopic, KafkaTopic, Topic, refuse_sink_log
from eventlake.streaming.control import trigger


def publish(envelopes: DataFrame, topic: Topic) -> None:
    """Append a batch of envelope rows to the topic."""
    if isinstance(topic, KafkaTopic):
        records = envelopes.select("key", "value")
        records.write.format("kafka").options(**topic.writer_options()).save()
    else:
        refuse_sink_log(envelopes.sparkSession, topic)
        envelopes.write.mode("append").parquet(topic.path)


#: Files that are moved side by side.
MOVERS = 16


def publish_micro_batch(envelopes: DataFrame, topic: DirectoryTopic, run: str, batch: int) -> None:
    """Publish a micro-batch once, whatever happens on the way and on any kind of store.

    The batch is written out of the readers' sight. A note of its files then commits it: from there
    on nothing is written again. The files are moved to the batch's folder one by one, and a second
    note says that all are there. An attempt that finds the first note moves what is left; one that
    finds the second does nothing. Readers see whole files of committed batches, each once.
    """
    spark = envelopes.sparkSession
    name = f"{run}-{batch:010d}"
    # Readers do not look into folders that start with an underscore.
    staging, target = f"{topic.path}/_staging/{name}", f"{topic.path}/{name}"
    committed, done = f"{topic.path}/_notes/{name}.files", f"{topic.path}/_notes/{name}.done"
    if read_note(spark, done) is not None:
        return
    files = read_note(spark, committed)
    if files is None:
        if folder_exists(spark, target):
            # Published by a version without notes, which moved whole folders.
            return
        envelopes.write.mode("overwrite").parquet(staging)
        files = sorted(file for file in file_sizes(spark, staging) if file.endswith(".parquet"))
        write_note(spark, committed, files)
    make_folder(spark, target)
    staged, there = file_sizes(spark, staging), file_sizes(spark, target)
    lost = set(files) - staged.keys() - there.keys()
    if lost:
        raise OSError(f"{name}: committed files are gone: {sorted(lost)}")

    def move(file: str) -> None:
        # A copy that was made, but whose source was not deleted yet, needs no other.
        if there.get(file) != staged[file]:
            move_file(spark, f"{staging}/{file}", f"{target}/{file}")

    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(move, [file for file in files if file in staged]))
    write_note(spark, done, [])
    remove_folder(spark, staging)
    remove_folder(spark, committed)


def publish_stream(
    envelopes: DataFrame,
    topic: Topic,
    checkpoint: str,
    every: str | None = None,
    on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append a stream of envelope rows to the topic.

    A directory topic takes batches and any number of streams. A stream started again from its
    checkpoint publishes each micro-batch once. `on_batch` is told the id of each micro-batch that a
    directory topic has.
    """
    run: Future[str] = Future()
    if isinstance(topic, KafkaTopic):
        writer = envelopes.select("key", "value").writeStream.format("kafka")
        writer = writer.options(**topic.writer_options())
    else:
        refuse_sink_log(envelopes.sparkSession, topic)
        make_folder(envelopes.sparkSession, topic.path)

        def land(rows: DataFrame, batch: int) -> None:
            publish_micro_batch(rows, topic, run.result(), batch)
            if on_batch is not None:
                on_batch(batch)

        writer = envelopes.writeStream.foreachBatch(land)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.trigger(**trigger(every)).start()
    # The query id is known only now; the first batch waits for it.
    run.set_result(query.id)
    return query
