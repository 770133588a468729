"""Message payloads to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.protobuf import (
    READ_OPTIONS,
    MessageFormat,
    decode_message,
    telemetry_format,
)
from eventlake.schemas import EVENT


def decode_json(
    messages: DataFrame,
    schema: StructType = EVENT,
    payload: str = "value",
    keep: Sequence[str] = (),
    corrupt: str | None = None,
) -> DataFrame:
    """Parse JSON text in `payload`; `keep` names columns to carry along.

    Every message yields one row. Text that does not parse, or a field of the wrong type, gives
    NULLs, never an error. `corrupt` asks for one more column, of that name, which holds the whole
    text of such a message. It is NULL for messages that parse, and for NULL, empty and blank ones.
    """
    options = {}
    if corrupt is not None:
        if corrupt.lower() in {name.lower() for name in (*keep, *schema.names)}:
            raise ValueError(f"{corrupt} is a column already")
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        options = {"columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json(F.col(payload).cast("string"), schema, options)
    return messages.select(*keep, parsed.alias("data")).select(*keep, "data.*")


def decode_telemetry(
    messages: DataFrame,
    payload: str = "value",
    keep: Sequence[str] = (),
    drop_null: bool = False,
    form: MessageFormat | None = None,
    engine: str = "auto",
    options: Mapping[str, str] = READ_OPTIONS,
    corrupt: str | None = None,
) -> DataFrame:
    """Parse Protobuf telemetry in `payload`.

    `form` describes the messages, if their field numbers are not this library's own. Malformed
    bytes fail the query, or yield an all-NULL row with the option `mode` set to PERMISSIVE. Then
    `corrupt` asks for one more column, of that name, which holds the bytes of such a message.

    A NULL payload yields an all-NULL row, or none with `drop_null`, which drops NULL payloads
    before they are decoded, so that the filter reaches the scan.
    """
    if drop_null:
        messages = messages.where(F.col(payload).isNotNull())
    event = decode_message(payload, form, engine, options)
    if corrupt is None:
        return messages.select(*keep, event.alias("event")).select(*keep, "event.*")
    names = (form or telemetry_format()).schema.names
    if corrupt.lower() in {name.lower() for name in (*keep, *names)}:
        raise ValueError(f"{corrupt} is a column already")
    lost = F.when(F.col("event").isNull(), F.col("payload")).alias(corrupt)
    decoded = messages.select(*keep, F.col(payload).alias("payload"), event.alias("event"))
    return decoded.select(*keep, "event.*", lost)
