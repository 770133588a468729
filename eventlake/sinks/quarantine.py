"""Setting aside messages that cannot be read, beside the table that takes the others.

A row brings its message along in the column `SET_ASIDE` if it could not be read. A micro-batch is
decoded once and kept while both tables are written. Either table lands a replayed micro-batch once,
and what a message is does not change between attempts, so after any crash and replay each message is
in one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.shape import ingest_clock
from eventlake.schemas import ENVELOPE, QUARANTINE_COLUMNS
from eventlake.streaming.batches import BatchSink, Landed

SET_ASIDE = "set_aside"


def message_to_keep(envelope: str, clock: Column | None = None) -> Column:
    """The message in the envelope column as a row of the quarantine table."""
    have = {
        "payload": F.col(f"{envelope}.value"),
        "processing_time": ingest_clock(clock),
    }
    return F.struct(
        *[
            have.get(name, F.col(f"{envelope}.{name}")).alias(name)
            for name in QUARANTINE_COLUMNS.names
        ]
    )


@dataclass(frozen=True)
class Quarantine:
    """A sink for rows that may carry `SET_ASIDE`: these go to `aside`, the others to `table`."""

    table: BatchSink
    aside: BatchSink

    def append(self, rows: DataFrame, run: str, batch: int) -> Landed:
        kept = rows.persist()
        try:
            unread = kept.where(F.col(SET_ASIDE).isNotNull()).select(f"{SET_ASIDE}.*")
            aside = self.aside.append(unread, run, batch)
            read = kept.where(F.col(SET_ASIDE).isNull()).drop(SET_ASIDE)
            return Landed(self.table.append(read, run, batch), aside)
        finally:
            kept.unpersist()


def as_messages(quarantined: DataFrame) -> DataFrame:
    """Rows of the quarantine table as messages, to publish them or to decode them again."""
    have = {"value": F.col("payload"), "timestampType": F.lit(0)}
    return quarantined.select(
        *[
            have.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in ENVELOPE
        ]
    )
