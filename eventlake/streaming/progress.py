"""What running streams report, and stopping them between two micro-batches."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from threading import Event

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class SourceRange:
    """The part of one source that a micro-batch read, as the source counts it."""

    source: str
    start: object
    end: object
    rows: int


@dataclass(frozen=True)
class Progress:
    """One micro-batch as Spark reports it, once its offsets are committed."""

    run: str
    batch: int
    rows: int
    seconds: float
    sources: tuple[SourceRange, ...]


def offset(text: str | None) -> object:
    """A source's offset, None where it had none yet; most are JSON."""
    if text in (None, "None"):
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


class ProgressListener(StreamingQueryListener):
    """Hands the progress of every stream of a session on, or of those with the given query ids.

    Spark tells listeners some time after the batch, in order, and the end of a stream last. Triggers
    that found nothing to read are not told of.
    """

    def __init__(
        self, on_progress: Callable[[Progress], None], runs: set[str] | None = None
    ) -> None:
        self.on_progress, self.runs = on_progress, runs
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        run = str(report.id)
        if self.runs is not None and run not in self.runs:
            return
        sources = tuple(
            SourceRange(s.description, offset(s.startOffset), offset(s.endOffset), s.numInputRows)
            for s in report.sources
        )
        if all(source.start == source.end for source in sources):
            return
        self.on_progress(
            Progress(run, report.batchId, report.numInputRows, report.batchDuration / 1000, sources)
        )

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def wait(self, run: str, seconds: float = 10.0) -> bool:
        """Wait until the end of a stream was told, and with it all of its progress."""
        end = time.monotonic() + seconds
        while run not in self.ended and time.monotonic() < end:
            time.sleep(0.01)
        return run in self.ended


def watch(spark: SparkSession, on_progress: Callable[[Progress], None]) -> ProgressListener:
    """Hear of all streams of the session until `spark.streams.removeListener(...)`."""
    listener = ProgressListener(on_progress)
    spark.streams.addListener(listener)
    return listener


#: Told from other errors of a stream by its text.
STOPPED = "eventlake: stopped between micro-batches"


class StoppedBetweenBatchesError(RuntimeError):
    def __init__(self) -> None:
        super().__init__(STOPPED)


class StopSwitch:
    """Ends a stream that was started with it, never in the middle of a micro-batch.

    Once it is thrown, the batch at work ends and is committed. The next one ends the stream before it
    has done anything; a restart from the checkpoint begins with it.
    """

    def __init__(self) -> None:
        self.thrown = Event()

    def begin_batch(self) -> None:
        """Called by the stream before each micro-batch."""
        if self.thrown.is_set():
            raise StoppedBetweenBatchesError

    def stop(self, query: StreamingQuery, seconds: float | None = None) -> bool:
        """Throw the switch and wait for the end of the stream; whether it came in that time."""
        self.thrown.set()
        end = None if seconds is None else time.monotonic() + seconds
        while query.isActive and (end is None or time.monotonic() < end):
            if not query.status["isTriggerActive"]:
                # It waits for data or for its time, and any batch from here on does nothing.
                query.stop()
            time.sleep(0.02)
        return not query.isActive


def await_end(query: StreamingQuery) -> None:
    """Wait for a stream to end, by itself or by its switch; any other error is raised."""
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if STOPPED not in str(error):
            raise
