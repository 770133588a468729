"""Protobuf descriptor sets: made from Spark columns, and walked to get the columns of a message.

The walk gives the types that the `spark-protobuf` package gives, and takes its options: how often a
message may hold a message of its own kind (`recursive.fields.max.depth`), enums as numbers
(`enums.as.ints`), and unsigned numbers in a type that holds them all (`upcast.unsigned.ints`).
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark import cloudpickle
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DayTimeIntervalType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Ship this module's functions inside the UDF, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TIMESTAMP_MESSAGE = "google.protobuf.Timestamp"
DURATION_MESSAGE = "google.protobuf.Duration"

DEPTH = "recursive.fields.max.depth"
ENUMS_AS_INTS = "enums.as.ints"
UPCAST_UNSIGNED = "upcast.unsigned.ints"

#: Levels of one message within itself that may be asked for, at most.
DEEPEST = 10

#: Unsigned numbers of 64 bits, where they are not to wrap around.
UNSIGNED_LONG = DecimalType(20, 0)


def is_set(options: Mapping[str, str], name: str) -> bool:
    return options.get(name, "false").lower() == "true"


def message_layout(message: str, descriptors: bytes):
    """The descriptor of a message type out of a serialized `FileDescriptorSet`."""
    from google.protobuf import descriptor_pb2, descriptor_pool

    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptors).file:
        pool.AddSerializedFile(file.SerializeToString())
    return pool.FindMessageTypeByName(message)


def message_class(message: str, descriptors: bytes):
    from google.protobuf import message_factory

    return message_factory.GetMessageClass(message_layout(message, descriptors))


def is_map(field) -> bool:
    return field.message_type is not None and field.message_type.GetOptions().map_entry


# --- columns of a message -----------------------------------------------------------------------


def scalar_type(field, options: Mapping[str, str]) -> DataType | None:
    """The column type of a field, or of its elements; None for a message with fields of its own."""
    upcast = is_set(options, UPCAST_UNSIGNED)
    kinds = {
        field.TYPE_DOUBLE: DoubleType(),
        field.TYPE_FLOAT: FloatType(),
        field.TYPE_BOOL: BooleanType(),
        field.TYPE_STRING: StringType(),
        field.TYPE_BYTES: BinaryType(),
        field.TYPE_ENUM: IntegerType() if is_set(options, ENUMS_AS_INTS) else StringType(),
        field.TYPE_UINT32: LongType() if upcast else IntegerType(),
        field.TYPE_FIXED32: LongType() if upcast else IntegerType(),
        field.TYPE_UINT64: UNSIGNED_LONG if upcast else LongType(),
        field.TYPE_FIXED64: UNSIGNED_LONG if upcast else LongType(),
    }
    kinds |= dict.fromkeys((field.TYPE_INT32, field.TYPE_SINT32, field.TYPE_SFIXED32), IntegerType())
    kinds |= dict.fromkeys((field.TYPE_INT64, field.TYPE_SINT64, field.TYPE_SFIXED64), LongType())
    if field.message_type is None:
        return kinds[field.type]
    special = {TIMESTAMP_MESSAGE: TimestampType(), DURATION_MESSAGE: DayTimeIntervalType()}
    return special.get(field.message_type.full_name)


def columns_of(layout, options: Mapping[str, str]) -> StructType:
    """The columns of a message type, field by field.

    A message type within itself appears as often as `recursive.fields.max.depth` says (at most 10),
    the outermost included; deeper fields are left out, as are messages without any fields. Without
    the option, or with 0, such a type is an error.
    """
    deepest = int(options.get(DEPTH, "-1"))
    if deepest > DEEPEST:
        raise ValueError(f"{DEPTH} is at most {DEEPEST}, not {deepest}")

    def value_type(field, around: dict[str, int]) -> DataType | None:
        kind = scalar_type(field, options)
        if kind is not None:
            return kind
        inner = field.message_type
        levels = around.get(inner.full_name, 0)
        if levels and deepest <= 0:
            raise ValueError(f"{field.full_name} holds its own type: set {DEPTH}")
        if levels and levels >= deepest:
            return None
        struct = walk(inner, around | {inner.full_name: levels + 1})
        return struct if struct.fields else None

    def walk(layout, around: dict[str, int]) -> StructType:
        found = []
        for field in layout.fields:
            if is_map(field):
                entry = field.message_type.fields_by_name
                value = value_type(entry["value"], around)
                kind = value and MapType(scalar_type(entry["key"], options), value, False)
            else:
                kind = value_type(field, around)
                if kind is not None and field.is_repeated:
                    kind = ArrayType(kind, False)
            if kind is not None:
                found.append(StructField(field.name, kind, not field.is_required))
        return StructType(found)

    return walk(layout, {layout.full_name: 1})


def check_columns(
    layout, schema: StructType, options: Mapping[str, str] | None = None, path: str = ""
) -> None:
    """Refuse columns that the message has no field for, or one of another type.

    Without `options` enums and unsigned numbers may be of either of their types.
    """
    either = ({}, {ENUMS_AS_INTS: "true"}, {UPCAST_UNSIGNED: "true"})

    def check(field, kind: DataType, name: str) -> None:
        own = [scalar_type(field, some) for some in (either if options is None else (options,))]
        if own[0] is None and isinstance(kind, StructType):
            check_columns(field.message_type, kind, options, f"{name}.")
        elif kind not in own:
            raise TypeError(f"{name}: {kind.simpleString()} is not the type of {field.full_name}")

    for column in schema.fields:
        field = layout.fields_by_name.get(column.name)
        kind, name = column.dataType, path + column.name
        if field is None:
            raise TypeError(f"{layout.full_name} has no field for {name}")
        if is_map(field) and isinstance(kind, MapType):
            entry = field.message_type.fields_by_name
            check(entry["key"], kind.keyType, f"{name}.key")
            check(entry["value"], kind.valueType, f"{name}.value")
        elif field.is_repeated and not is_map(field) and isinstance(kind, ArrayType):
            check(field, kind.elementType, f"{name}.element")
        elif field.is_repeated or isinstance(kind, (ArrayType, MapType)):
            raise TypeError(f"{name}: {kind.simpleString()} is not the type of {field.full_name}")
        else:
            check(field, kind, name)


# --- a message for columns ----------------------------------------------------------------------


def camel(name: str) -> str:
    return "".join(part.capitalize() for part in name.split("_"))


def check_types(schema: StructType) -> None:
    """Refuse columns that no Protobuf field has the type of."""
    known = (StringType, TimestampType, DayTimeIntervalType, IntegerType, LongType, FloatType)
    known += (DoubleType, BooleanType, BinaryType)

    def check(kind: DataType, name: str) -> None:
        if isinstance(kind, StructType):
            for column in kind.fields:
                whole = f"{name}.{column.name}" if name else column.name
                inner = column.dataType
                if isinstance(inner, MapType):
                    if isinstance(inner.keyType, (FloatType, DoubleType, BinaryType, StructType)):
                        raise TypeError(f"no Protobuf type for {whole}: {inner}")
                    check(inner.keyType, whole)
                    inner = inner.valueType
                elif isinstance(inner, ArrayType):
                    inner = inner.elementType
                check(inner, whole)
        elif not isinstance(kind, known) and kind != UNSIGNED_LONG:
            raise TypeError(f"no Protobuf type for {name}: {kind}")

    check(schema, "")


def descriptor_set(message: str, schema: StructType) -> bytes:
    """A serialized `FileDescriptorSet` for `schema`, numbering fields in schema order from 1.

    The syntax is proto2: there an unset scalar can be told from an empty one, as NULL needs.
    """
    from google.protobuf import descriptor_pb2, duration_pb2, timestamp_pb2

    check_types(schema)
    files = descriptor_pb2.FileDescriptorSet()
    package, _, name = message.rpartition(".")
    file = descriptor_pb2.FileDescriptorProto(
        name=f"{message}.proto", package=package, syntax="proto2"
    )
    for module in (timestamp_pb2, duration_pb2):
        module.DESCRIPTOR.CopyToProto(files.file.add())
        file.dependency.append(module.DESCRIPTOR.name)
    kinds = descriptor_pb2.FieldDescriptorProto
    scalars = {
        StringType: kinds.TYPE_STRING,
        BinaryType: kinds.TYPE_BYTES,
        BooleanType: kinds.TYPE_BOOL,
        IntegerType: kinds.TYPE_INT32,
        LongType: kinds.TYPE_INT64,
        FloatType: kinds.TYPE_FLOAT,
        DoubleType: kinds.TYPE_DOUBLE,
        DecimalType: kinds.TYPE_UINT64,
    }
    messages = {TimestampType: TIMESTAMP_MESSAGE, DayTimeIntervalType: DURATION_MESSAGE}

    def fill(field, kind: DataType, nested: str) -> None:
        if isinstance(kind, StructType):
            field.type, field.type_name = kinds.TYPE_MESSAGE, f".{package}.{nested}"
            declare(nested, kind)
        elif type(kind) in messages:
            field.type, field.type_name = kinds.TYPE_MESSAGE, f".{messages[type(kind)]}"
        else:
            field.type = scalars[type(kind)]

    def declare(message_name: str, struct: StructType) -> None:
        declared = file.message_type.add(name=message_name)
        for number, column in enumerate(struct.fields, start=1):
            field = declared.field.add(
                name=column.name, number=number, label=kinds.LABEL_OPTIONAL
            )
            kind, nested = column.dataType, camel(column.name)
            if nested in {other.name for other in file.message_type}:
                nested = message_name + nested
            if isinstance(kind, MapType):
                entry = declared.nested_type.add(name=f"{camel(column.name)}Entry")
                entry.options.map_entry = True
                for place, (part, inner) in enumerate(
                    (("key", kind.keyType), ("value", kind.valueType)), start=1
                ):
                    fill(
                        entry.field.add(name=part, number=place, label=kinds.LABEL_OPTIONAL),
                        inner,
                        nested,
                    )
                field.label, field.type = kinds.LABEL_REPEATED, kinds.TYPE_MESSAGE
                field.type_name = f".{package}.{message_name}.{entry.name}"
                continue
            if isinstance(kind, ArrayType):
                field.label, kind = kinds.LABEL_REPEATED, kind.elementType
            fill(field, kind, nested)

    declare(name, schema)
    files.file.append(file)
    return files.SerializeToString()
