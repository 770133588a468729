"""Columns derived from descriptors, and every Protobuf type there and back."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from google.protobuf import descriptor_pb2, text_format
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.functions.descriptors import columns_of, descriptor_set, message_layout
from eventlake.functions.protobuf import (
    MessageFormat,
    decode_message,
    described_format,
    encode_message,
    message_class,
)
from eventlake.operators.decode import decode_telemetry
from eventlake.plans.checks import READING_MESSAGE, reading_descriptors

DEPTH = "recursive.fields.max.depth"
PERSON = """
name: "person.proto" package: "p" syntax: "proto2"
message_type { name: "Person"
  field { name: "name" number: 1 label: LABEL_OPTIONAL type: TYPE_STRING }
  field { name: "friend" number: 2 label: LABEL_OPTIONAL type: TYPE_MESSAGE type_name: ".p.Person" }
  field { name: "all" number: 3 label: LABEL_REPEATED type: TYPE_MESSAGE type_name: ".p.Person" } }
message_type { name: "Pair"
  field { name: "other" number: 1 label: LABEL_OPTIONAL type: TYPE_MESSAGE type_name: ".p.Other" } }
message_type { name: "Other"
  field { name: "pair" number: 1 label: LABEL_OPTIONAL type: TYPE_MESSAGE type_name: ".p.Pair" }
  field { name: "n" number: 2 label: LABEL_REQUIRED type: TYPE_INT32 } }
message_type { name: "Bare"
  field { name: "pair" number: 1 label: LABEL_OPTIONAL type: TYPE_MESSAGE type_name: ".p.Bare" } }
"""


def files(*texts):
    found = descriptor_pb2.FileDescriptorSet()
    for text in texts:
        text_format.Parse(text, found.file.add())
    return found.SerializeToString()


def person_type(levels):
    kind = "struct<name:string>"
    for _ in range(levels - 1):
        kind = f"struct<name:string,friend:{kind},all:array<{kind}>>"
    return kind


@pytest.mark.parametrize("depth", [1, 2, 3, 10])
def test_depth(depth):
    # The tenth level holds two fields of its type on each of nine levels.
    if depth == 10:
        text = PERSON.replace('''  field { name: "all" number: 3 label: LABEL_REPEATED type: TYPE_MESSAGE type_name: ".p.Person" } }''', "}")
        kind = "struct<name:string>"
        for _ in range(9):
            kind = f"struct<name:string,friend:{kind}>"
    else:
        text, kind = PERSON, person_type(depth)
    found = columns_of(message_layout("p.Person", files(text)), {DEPTH: str(depth)})
    assert found.simpleString() == kind


@pytest.mark.parametrize("options", [{}, {DEPTH: "0"}, {DEPTH: "-1"}])
def test_depth_is_asked_for(options):
    with pytest.raises(ValueError, match=r"p.Person.friend holds its own type: set recursive"):
        described_format("p.Person", files(PERSON), options)


def test_more_than_ten_levels_are_refused():
    with pytest.raises(ValueError, match="at most 10, not 11"):
        described_format("p.Person", files(PERSON), {DEPTH: "11"})


def test_types_within_each_other():
    layout = message_layout("p.Pair", files(PERSON))
    assert columns_of(layout, {DEPTH: "1"}).simpleString() == "struct<other:struct<n:int>>"
    assert columns_of(layout, {DEPTH: "2"}).simpleString() == (
        "struct<other:struct<pair:struct<other:struct<n:int>>,n:int>>"
    )
    assert not columns_of(layout, {DEPTH: "1"})["other"].dataType["n"].nullable


def test_a_message_without_fields_is_left_out():
    assert columns_of(message_layout("p.Bare", files(PERSON)), {DEPTH: "5"}) == StructType([])


@pytest.mark.parametrize("depth", [1, 3, 10])
def test_deeper_messages_are_cut(spark, depth):
    single = PERSON.replace('type_name: ".p.Person" } }', 'type_name: ".p.Other" } }', 1)
    cls = message_class("p.Person", files(single))
    person = cls(name="0")
    at = person
    for level in range(1, 15):
        at = at.friend
        at.name = str(level)
    form = described_format("p.Person", files(single), {DEPTH: str(depth)})
    rows = spark.createDataFrame([(person.SerializeToString(),)], "value binary")
    row = rows.select(decode_message("value", form).alias("p")).first().p
    names = []
    while row is not None:
        names.append(row.name)
        row = getattr(row, "friend", None)
    assert names == [str(level) for level in range(depth)]


READING_TYPES = (
    "struct<id:bigint,user:int,kind:string,value:double,half:float,high:boolean,raw:binary,note:string,"
    "at:timestamp,took:interval day to second,tags:map<string,bigint>,"
    "by_number:map<int,struct<name:string,amount:int>>,kinds:array<string>,"
    "parts:array<struct<name:string,amount:int>>>"
)


def reading(**options):
    return described_format(READING_MESSAGE, reading_descriptors(), {DEPTH: "1", **options})


def test_types():
    assert reading().schema.simpleString() == READING_TYPES
    other = reading(**{"enums.as.ints": "true", "upcast.unsigned.ints": "true"}).schema
    assert [other[name].dataType.simpleString() for name in ("id", "user", "kind", "kinds", "by_number")] == [
        "decimal(20,0)", "bigint", "int", "array<int>", "map<bigint,struct<name:string,amount:int>>",
    ]


UPCAST = {"enums.as.ints": "true", "upcast.unsigned.ints": "true", DEPTH: "1"}
LARGEST = ((1 << 64) - 1, (1 << 32) - 1)


@pytest.mark.parametrize("upcast", [False, True])
def test_every_type_there_and_back(spark, upcast):
    form = reading(**(UPCAST if upcast else {}))
    enum = (lambda n, name: n) if upcast else (lambda n, name: name)
    full = (
        Decimal(LARGEST[0]) if upcast else -1, LARGEST[1] if upcast else -1, enum(4, "VIEW"),
        -0.0, 1.5, True, bytearray(b"\x00\xff"), "", dt.datetime(1969, 12, 31, 23, 59, 59, 5),
        dt.timedelta(days=-2, microseconds=3), {"a": 0, "b": -7}, {3: ("x", None), 4: (None, -5)},
        [enum(0, "CLICK"), enum(3, "SIGNUP")], [("p", 1), (None, None)],
    )
    empty = (*[None] * 10, {}, {}, [], [])
    rows = spark.createDataFrame([full, empty], form.schema)
    sent = rows.select(encode_message(F.struct("*"), form).alias("value"))
    options = UPCAST if upcast else {DEPTH: "1"}
    back = sent.select(decode_message("value", form, options=options).alias("r")).select("r.*")
    assert back.dtypes == rows.dtypes
    found = back.collect()
    assert sorted(map(repr, found)) == sorted(map(repr, rows.collect()))
    (first,) = [r for r in found if r.id is not None]
    assert math.copysign(1, first.value) < 0
    whole = message_class(READING_MESSAGE, reading_descriptors())
    messages = [whole.FromString(bytes(r.value)) for r in sent.collect()]
    assert sorted((m.id, m.user) for m in messages) == [(0, 0), LARGEST]


def test_presence_in_proto3(spark):
    """Zero, false and empty cannot be told from unset, but in the optional field and within lists."""
    cls = message_class(READING_MESSAGE, reading_descriptors())
    message = cls(id=0, value=0.0, high=False, note="", kinds=["CLICK"], tags={"a": 0})
    rows = spark.createDataFrame([(message.SerializeToString(),)], "value binary")
    row = rows.select(decode_message("value", reading()).alias("r")).first().r
    assert (row.id, row.value, row.high, row.kind, row.raw) == (None,) * 5
    assert (row.note, row.kinds, row.tags, row.at) == ("", ["CLICK"], {"a": 0}, None)
    filled = rows.select(
        decode_message("value", reading(), options={"emit.default.values": "true"}).alias("r")
    ).first().r
    assert (filled.id, filled.value, filled.high, filled.kind, filled.raw) == (0, 0.0, False, "CLICK", b"")
    assert (filled.note, filled.at) == ("", None)


def test_defaults_in_proto2(spark):
    text = """name: "d.proto" package: "d" syntax: "proto2" message_type { name: "D"
      field { name: "n" number: 1 label: LABEL_OPTIONAL type: TYPE_INT32 default_value: "7" }
      field { name: "m" number: 2 label: LABEL_OPTIONAL type: TYPE_INT32 } }"""
    form = described_format("d.D", files(text))
    rows = spark.createDataFrame([(b"",), (b"\x08\x00\x10\x00",)], "value binary")
    found = rows.select(decode_message("value", form).alias("r")).select("r.*").collect()
    assert sorted(map(repr, map(tuple, found))) == ["(0, 0)", "(7, None)"]


def test_unknown_enum_numbers_keep_a_name(spark):
    rows = spark.createDataFrame([(b"\x18\x2a\x6a\x02\x01\x2a",)], "value binary")
    row = rows.select(decode_message("value", reading()).alias("r")).first().r
    assert (row.kind, row.kinds) == ("UNKNOWN_ENUM_VALUE_Kind_42", ["ERROR", "UNKNOWN_ENUM_VALUE_Kind_42"])


@pytest.mark.parametrize(
    "columns, message",
    [
        ("id int", "id: int is not the type of party.Reading.id"),
        ("other string", "party.Reading has no field for other"),
        ("parts array<struct<name:string,amount:string>>", "parts.element.amount: string"),
        ("tags map<string,int>", "tags.value: int"),
        ("tags string", "tags: string"),
        ("kinds string", "kinds: string"),
        ("note array<string>", "note: array<string>"),
    ],
)
def test_columns_that_the_message_has_not_are_refused(spark, columns, message):
    form = MessageFormat(READING_MESSAGE, StructType.fromDDL(columns), reading_descriptors())
    for build in (decode_message, encode_message):
        with pytest.raises(TypeError, match=message.replace("(", r"\(")):
            build("value", form, engine="python")


def test_some_columns_of_a_message(spark):
    form = MessageFormat(READING_MESSAGE, StructType.fromDDL("cause struct<user:int>, id bigint"), reading_descriptors())
    cls = message_class(READING_MESSAGE, reading_descriptors())
    sent = cls(id=3, cause=cls(user=4, cause=cls(user=5))).SerializeToString()
    rows = spark.createDataFrame([(sent,)], "value binary")
    row = decode_telemetry(rows, form=form).first()
    assert (row.cause.user, row.id) == (4, 3)


def test_nulls_in_maps_and_lists_are_named(spark):
    rows = spark.createDataFrame([({"a": None}, [None])], "tags map<string,bigint>, parts array<struct<name:string>>")
    for name in ("tags", "parts"):
        kind = StructType([rows.schema[name]])
        form = MessageFormat(READING_MESSAGE, kind, reading_descriptors())
        with pytest.raises(PythonException, match=f"{name}: a .* cannot hold NULL"):
            rows.select(encode_message(F.struct(name), form)).collect()


def test_descriptors_made_from_columns(spark):
    schema = StructType.fromDDL(
        "a int, b bigint, c float, d double, e boolean, f binary, g interval day to second, "
        "h map<string,struct<x:int>>, i array<struct<x:string>>, j struct<i:struct<y:int>>, k array<timestamp>"
    )
    form = MessageFormat("own.Thing", schema, descriptor_set("own.Thing", schema))
    row = (1, -2, 0.5, 1e300, False, bytearray(b"z"), dt.timedelta(seconds=1), {"k": (None,)}, [("q",)], ((4,),),
           [dt.datetime(2024, 1, 1)])
    rows = spark.createDataFrame([row], schema)
    back = rows.select(encode_message(F.struct("*"), form).alias("v")).select(decode_message("v", form).alias("r"))
    assert back.select("r.*").collect() == rows.collect()
    assert described_format("own.Thing", form.descriptors).schema.simpleString() == schema.simpleString()
