"""Protobuf payloads to and from struct columns.

With the `spark-protobuf` package on the classpath both directions run in the JVM. Without it the
same columns come from Arrow UDFs over the `google.protobuf` runtime. Both read the message
layout from one descriptor set: the caller's own, or one derived from the payload's Spark schema.
"""

from __future__ import annotations

import gc
import math
import sys
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DayTimeIntervalType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

from eventlake.functions.descriptors import (
    DEPTH,
    ENUMS_AS_INTS,
    UPCAST_UNSIGNED,
    check_columns,
    check_types,
    columns_of,
    descriptor_set,
    is_map,
    is_set,
    message_class,
    message_layout,
)
from eventlake.schemas import TELEMETRY

# Ship this module's functions inside the UDF, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKAGE = "eventlake"
TELEMETRY_MESSAGE = f"{PACKAGE}.Telemetry"

#: Reader options that telemetry topics are decoded with.
READ_OPTIONS = {DEPTH: "10"}

EMIT_DEFAULTS = "emit.default.values"

#: Reader options that the Python engine takes.
PYTHON_OPTIONS = ("mode", DEPTH, ENUMS_AS_INTS, UPCAST_UNSIGNED, EMIT_DEFAULTS)
MODES = ("FAILFAST", "PERMISSIVE")


@dataclass(frozen=True)
class MessageFormat:
    """A Protobuf message type and the columns to read from it.

    Without `descriptors`, `name` is a message class on the JVM's class path.
    """

    name: str
    schema: StructType = TELEMETRY
    descriptors: bytes | None = None


def telemetry_format() -> MessageFormat:
    """Telemetry with field numbers in schema order."""
    return MessageFormat(
        TELEMETRY_MESSAGE, TELEMETRY, descriptor_set(TELEMETRY_MESSAGE, TELEMETRY)
    )


def described_format(
    name: str, descriptors: bytes, options: Mapping[str, str] = READ_OPTIONS
) -> MessageFormat:
    """A message type with all the columns that its descriptors give; see `columns_of`."""
    return MessageFormat(name, columns_of(message_layout(name, descriptors), options), descriptors)


def permissive(options: Mapping[str, str]) -> bool:
    """Whether malformed messages become NULL; an option without effect here is refused."""
    unknown = sorted(set(options) - set(PYTHON_OPTIONS))
    mode = options.get("mode", "FAILFAST").upper()
    if unknown or mode not in MODES:
        raise ValueError(f"the Python engine does not take {unknown or f'mode {mode}'}")
    return mode == "PERMISSIVE"


@contextmanager
def collector_paused() -> Iterator[None]:
    """A batch makes many objects and no cycles, so searching them for cycles is wasted time."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


# --- messages to columns ------------------------------------------------------------------------


def enum_names(numbers: list, enum) -> list:
    """Names of an enum's numbers; a number that the enum does not know keeps a made-up one."""
    known = {number: value.name for number, value in enum.values_by_number.items()}
    return [
        None if n is None else known.get(n) or f"UNKNOWN_ENUM_VALUE_{enum.name}_{n}"
        for n in numbers
    ]


def wrapped(numbers: list, bits: int) -> list:
    """Unsigned numbers as the signed ones of the same bits."""
    half = 1 << (bits - 1)
    return [n if n is None or n < half else n - (1 << bits) for n in numbers]


def instants(children: list, unset: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Timestamp or Duration messages in microseconds."""
    seconds = np.array([c.seconds for c in children], dtype=np.int64)
    nanos = np.array([c.nanos for c in children], dtype=np.int64)
    # A negative duration has negative nanoseconds, which are cut towards zero.
    micros = seconds * 1_000_000 + np.trunc(nanos / 1_000).astype(np.int64)
    return pa.array(micros, mask=unset).cast(kind)


def values_to_array(
    values: list, field, kind: DataType, defaults: bool, unset: np.ndarray | None = None
) -> pa.Array:
    """Values of a field, or of its elements, as an Arrow column; None is NULL."""
    if field.message_type is not None:
        if unset is None:
            unset = np.zeros(len(values), bool)
        if isinstance(kind, TimestampType):
            return instants(values, unset, pa.timestamp("us", tz="UTC"))
        if isinstance(kind, DayTimeIntervalType):
            return instants(values, unset, pa.duration("us"))
        return messages_to_struct(values, field.message_type, kind, unset, defaults)
    if field.enum_type is not None and isinstance(kind, StringType):
        values = enum_names(values, field.enum_type)
    elif isinstance(kind, IntegerType) and field.cpp_type == field.CPPTYPE_UINT32:
        values = wrapped(values, 32)
    elif isinstance(kind, LongType) and field.cpp_type == field.CPPTYPE_UINT64:
        values = wrapped(values, 64)
    return pa.array(values, to_arrow_type(kind))


def known_values(messages: list, field, kind: DataType, defaults: bool) -> list:
    """Values of a field of one value, None where it was not sent.

    A field without presence (most of proto3) cannot tell that from its default value.
    """
    name = field.name
    values = [getattr(m, name) for m in messages]
    if field.has_presence:
        if field.has_default_value:
            return values
        # Only an empty value leaves open whether the field was set.
        return [
            v if v or m.HasField(name) else None for v, m in zip(values, messages, strict=True)
        ]
    if defaults:
        return values
    if isinstance(kind, (FloatType, DoubleType)):
        return [v if v or math.copysign(1, v) < 0 else None for v in values]
    return [v or None for v in values]


def messages_to_column(messages: list, field, kind: DataType, defaults: bool) -> pa.Array:
    """One field of every message, as an Arrow column; `field` is its Protobuf descriptor.

    `defaults` gives unset fields without presence their default value instead of NULL.
    """
    name = field.name
    if field.is_repeated:
        held = [getattr(m, name) for m in messages]
        offsets = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
        if is_map(field):
            entry = field.message_type.fields_by_name
            keys = [key for one in held for key in one]
            values = [one[key] for one in held for key in one]
            return pa.MapArray.from_arrays(
                offsets,
                values_to_array(keys, entry["key"], kind.keyType, defaults),
                values_to_array(values, entry["value"], kind.valueType, defaults),
            )
        flat = [value for one in held for value in one]
        return pa.ListArray.from_arrays(
            offsets, values_to_array(flat, field, kind.elementType, defaults)
        )
    if field.message_type is None:
        values = known_values(messages, field, kind, defaults)
        return values_to_array(values, field, kind, defaults)
    unset = np.array([not m.HasField(name) for m in messages], dtype=bool)
    return values_to_array([getattr(m, name) for m in messages], field, kind, defaults, unset)


def messages_to_struct(
    messages: list, layout, schema: StructType, unset: np.ndarray, defaults: bool
) -> pa.Array:
    if not len(schema):
        raise ValueError(f"{layout.full_name} has no columns")
    return pa.StructArray.from_arrays(
        [
            messages_to_column(messages, layout.fields_by_name[f.name], f.dataType, defaults)
            for f in schema
        ],
        names=schema.fieldNames(),
        mask=pa.array(unset),
    )


# --- columns to messages ------------------------------------------------------------------------


def to_objects(column: pa.Array) -> list:
    """Text or bytes of a column as Python objects; much faster than `to_pylist`."""
    return column.to_numpy(zero_copy_only=False).tolist()


def elements(column: pa.Array, flat: list, what: str, name: str) -> list[list]:
    """The flat values of a list or map column, row by row; a NULL row is an empty one."""
    # The offsets of a NULL slot are equal in Arrow data from Spark, so it reads as empty.
    offsets = column.offsets.to_numpy().tolist()
    if None in flat[offsets[0] : offsets[-1]]:
        raise ValueError(f"{name}: {what} cannot hold NULL")
    return [flat[start:end] for start, end in zip(offsets, offsets[1:], strict=False)]


def column_to_values(column: pa.Array, kind: DataType, field, name: str) -> list:
    """Arrow column to the Python values a message constructor takes; None leaves a field unset."""
    if isinstance(kind, MapType):
        entry = field.message_type.fields_by_name
        keys = column_to_values(column.keys, kind.keyType, entry["key"], name)
        items = column_to_values(column.items, kind.valueType, entry["value"], name)
        rows = elements(column, items, "a map", name)
        return [
            dict(zip(some, values, strict=True))
            for some, values in zip(elements(column, keys, "a map", name), rows, strict=True)
        ]
    if isinstance(kind, ArrayType):
        flat = column_to_values(column.values, kind.elementType, field, name)
        return elements(column, flat, "a repeated field", name)
    if isinstance(kind, (TimestampType, DayTimeIntervalType)):
        valid = column.is_valid().to_numpy(zero_copy_only=False).tolist()
        unit = pa.timestamp("us", tz="UTC") if isinstance(kind, TimestampType) else pa.duration("us")
        micros = column.cast(unit).cast(pa.int64()).fill_null(0).to_numpy()
        seconds, rest = np.divmod(micros, 1_000_000)
        if isinstance(kind, DayTimeIntervalType):
            # Both parts of a duration have its sign.
            low = (seconds < 0) & (rest > 0)
            seconds, rest = seconds + low, rest - low * 1_000_000
        return [
            {"seconds": second, "nanos": nano} if known else None
            for known, second, nano in zip(
                valid, seconds.tolist(), (rest * 1_000).tolist(), strict=True
            )
        ]
    if isinstance(kind, StructType):
        return column_to_rows(column, kind, field.message_type)
    if isinstance(kind, (StringType, BinaryType)):
        return to_objects(column)
    values = column.to_pylist()
    if isinstance(kind, DecimalType):
        values = [None if v is None else int(v) for v in values]
    bits = {field.CPPTYPE_UINT32: 32, field.CPPTYPE_UINT64: 64}.get(field.cpp_type)
    if bits and isinstance(kind, (IntegerType, LongType)):
        values = [v if v is None or v >= 0 else v + (1 << bits) for v in values]
    return values


def column_to_rows(column: pa.Array, kind: StructType, layout) -> list:
    """The messages of a struct column as dicts, None for NULL."""
    # flatten() applies the parent's slice and NULLs to the children.
    children = [
        column_to_values(child, f.dataType, layout.fields_by_name[f.name], f.name)
        for child, f in zip(column.flatten(), kind.fields, strict=True)
    ]
    names = kind.fieldNames()
    valid = column.is_valid().to_numpy(zero_copy_only=False).tolist()
    return [
        dict(zip(names, row, strict=True)) if known else None
        for known, row in zip(valid, zip(*children, strict=True), strict=True)
    ]


# --- engines ------------------------------------------------------------------------------------


def checked(form: MessageFormat, options: Mapping[str, str] | None = None) -> None:
    """Refuse columns that the message does not have, while the query is built."""
    check_types(form.schema)
    check_columns(message_layout(form.name, form.descriptors), form.schema, options)


def _decode_udf(form: MessageFormat, options: Mapping[str, str]) -> Callable[..., Column]:
    name, schema, descriptors = form.name, form.schema, form.descriptors
    lenient, defaults = permissive(options), is_set(options, EMIT_DEFAULTS)
    checked(form, options)

    @F.arrow_udf(form.schema)
    def protobuf_decode(payloads: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from google.protobuf.message import DecodeError

        cls = message_class(name, descriptors)

        def parsed(payloads: list, unset: np.ndarray) -> Iterator:
            # A NULL payload is parsed as an empty message and masked out again.
            for place, payload in enumerate(payloads):
                try:
                    yield cls.FromString(payload or b"")
                except DecodeError:
                    if not lenient:
                        raise
                    unset[place] = True
                    yield cls()

        for batch in payloads:
            unset = batch.is_null().to_numpy(zero_copy_only=False).copy()
            with collector_paused():
                messages = list(parsed(to_objects(batch), unset))
                decoded = messages_to_struct(messages, cls.DESCRIPTOR, schema, unset, defaults)
            yield decoded

    return protobuf_decode


def _encode_udf(form: MessageFormat) -> Callable[..., Column]:
    name, schema, descriptors = form.name, form.schema, form.descriptors
    checked(form)

    @F.arrow_udf("binary")
    def protobuf_encode(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cls = message_class(name, descriptors)
        for batch in rows:
            with collector_paused():
                values = column_to_rows(batch, schema, cls.DESCRIPTOR)
                payloads = [None if v is None else cls(**v).SerializeToString() for v in values]
            yield pa.array(payloads, pa.binary())

    return protobuf_encode


def jvm_protobuf(spark: SparkSession) -> bool:
    """Whether the `spark-protobuf` package is loaded."""
    try:
        spark.sql("SELECT from_protobuf(X'', '', X'')")
    except AnalysisException as error:
        return not (error.getCondition() or "").startswith("PROTOBUF_NOT_LOADED")
    return True


def _in_jvm(engine: str, form: MessageFormat) -> bool:
    if engine not in ("auto", "jvm", "python"):
        raise ValueError(f"engine must be auto, jvm or python, not {engine!r}")
    in_jvm = engine == "jvm" or (engine == "auto" and jvm_protobuf(SparkSession.active()))
    if not in_jvm and form.descriptors is None:
        raise ValueError(f"{form.name}: without spark-protobuf a descriptor set is needed")
    return in_jvm


def decode_message(
    payload: Column | str,
    form: MessageFormat | None = None,
    engine: str = "auto",
    options: Mapping[str, str] = READ_OPTIONS,
) -> Column:
    """Payload bytes to a struct of the format's columns.

    Malformed bytes fail the query, or give NULL with the option `mode` set to PERMISSIVE.
    """
    form = form or telemetry_format()
    if not _in_jvm(engine, form):
        return _decode_udf(form, options)(payload)
    from pyspark.sql.protobuf.functions import from_protobuf

    whole = from_protobuf(
        payload, form.name, options=dict(options), binaryDescriptorSet=form.descriptors
    )
    # The message may have more fields than the format asks for.
    chosen = F.struct(*(whole[name].alias(name) for name in form.schema.fieldNames()))
    return F.when(whole.isNotNull(), chosen)


def encode_message(
    row: Column | str, form: MessageFormat | None = None, engine: str = "auto"
) -> Column:
    """A struct to payload bytes; NULL fields stay unset, a NULL struct gives NULL."""
    form = form or telemetry_format()
    if not _in_jvm(engine, form):
        return _encode_udf(form)(row)
    from pyspark.sql.protobuf.functions import to_protobuf

    return to_protobuf(row, form.name, binaryDescriptorSet=form.descriptors)
