"""Appending a stream to a lake table, one micro-batch at a time."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.streaming.control import trigger
from eventlake.streaming.progress import StopSwitch

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Landed:
    """Rows of a micro-batch that landed in its table, and messages that were set aside instead."""

    rows: int
    quarantined: int = 0


class BatchSink(Protocol):
    """What a stream can be appended to: the lake tables, or the caller's own code."""

    def append(self, rows: DataFrame, run: str, batch: int) -> int | Landed:
        """Land `rows` once per `(run, batch)`, however often it is called; gives their number."""


@dataclass(frozen=True)
class BatchMetric:
    """What one micro-batch landed."""

    run: str
    batch: int
    rows: int
    quarantined: int = 0


def log_batch(metric: BatchMetric) -> None:
    log.info("run %s batch %d: %d rows landed", metric.run, metric.batch, metric.rows)
    if metric.quarantined:
        log.warning(
            "run %s batch %d: %d messages set aside", metric.run, metric.batch, metric.quarantined
        )


def append_batches(
    stream: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    every: str | None,
    on_batch: Callable[[BatchMetric], None] = log_batch,
    switch: StopSwitch | None = None,
) -> StreamingQuery:
    """Append each micro-batch of `stream` to `sink`, then report it to `on_batch`.

    The append and the checkpoint commit are separate steps, so a crash in between replays the
    batch. The sink is told the query id, which outlives restarts from the same checkpoint, and
    the batch id, and lands each pair once. It counts the rows while it writes them. A `switch` ends
    the stream between two batches.
    """
    run: Future[str] = Future()

    def land(rows: DataFrame, batch: int) -> None:
        if switch is not None:
            switch.begin_batch()
        landed = sink.append(rows, run.result(), batch)
        if not isinstance(landed, Landed):
            landed = Landed(landed)
        on_batch(BatchMetric(run.result(), batch, landed.rows, landed.quarantined))

    writer = stream.writeStream.outputMode("append").foreachBatch(land)
    query = writer.option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    # The query id is known only now; the first batch waits for it.
    run.set_result(query.id)
    return query
