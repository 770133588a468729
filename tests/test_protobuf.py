from __future__ import annotations

import datetime as dt

import pytest
from google.protobuf import descriptor_pb2
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from eventlake.functions.protobuf import (
    TELEMETRY_MESSAGE,
    MessageFormat,
    decode_message,
    descriptor_set,
    encode_message,
    jvm_protobuf,
    message_class,
    telemetry_format,
)
from eventlake.operators.decode import decode_telemetry
from eventlake.operators.encode import telemetry_payload
from eventlake.schemas import TELEMETRY, columns

# Hand-assembled wire bytes: field 2 "V", field 3 twice, field 7 {1: "f", 3: {1: 5, 2: 7000}}.
INSTANT = b"\x08\x05\x10\xd8\x36"
FLOW = b"\x0a\x01f" + b"\x1a\x05" + INSTANT
WIRE = b"\x12\x01V" + b"\x1a\x01a" + b"\x1a\x01b" + b"\x3a\x0a" + FLOW
EMPTY = dict.fromkeys(TELEMETRY.names) | {
    "data_uris": [],
    "correlation_ids": [],
    "expiration_length_types": [],
}


def decoded(spark, payloads, **options):
    rows = spark.createDataFrame([(p,) for p in payloads], "value binary").coalesce(1)
    return [r.asDict(recursive=True) for r in decode_telemetry(rows, **options).collect()]


def test_field_numbers_follow_the_schema():
    cls = message_class(TELEMETRY_MESSAGE, descriptor_set(TELEMETRY_MESSAGE, TELEMETRY))
    numbers = {field.name: field.number for field in cls.DESCRIPTOR.fields}
    assert numbers == {name: i for i, name in enumerate(TELEMETRY.names, start=1)}
    nested = cls.DESCRIPTOR.fields_by_name["flow_metric"].message_type
    assert [(f.name, f.number) for f in nested.fields] == [
        ("flow_aui", 1),
        ("flow_name", 2),
        ("flow_timestamp", 3),
    ]


def test_unsupported_type_is_refused():
    with pytest.raises(TypeError, match="amount"):
        descriptor_set("x.Y", columns(amount=DecimalType(10, 2)))


def test_wire_bytes(spark):
    (row,) = decoded(spark, [WIRE])
    assert row == EMPTY | {
        "vin": "V",
        "data_uris": ["a", "b"],
        "flow_metric": {
            "flow_aui": "f",
            "flow_name": None,
            "flow_timestamp": dt.datetime(1970, 1, 1, 0, 0, 5, 7),
        },
    }


def test_zero_length_message_is_all_unset(spark):
    assert decoded(spark, [b""]) == [EMPTY]


def test_null_payload_gives_an_all_null_row(spark):
    assert decoded(spark, [None, WIRE])[0] == dict.fromkeys(TELEMETRY.names)


def test_null_payload_is_dropped_on_request(spark):
    rows = decoded(spark, [None, WIRE, None], drop_null=True)
    assert [row["vin"] for row in rows] == ["V"]


def test_set_but_empty_text_differs_from_unset(spark):
    (row,) = decoded(spark, [b"\x12\x00"])
    assert row["vin"] == "" and row["region"] is None


def test_unknown_fields_are_ignored(spark):
    (row,) = decoded(spark, [WIRE + b"\xfa\x01\x03xyz"])
    assert row["vin"] == "V"


@pytest.mark.parametrize("payload", [b"\xff\xff\xff", WIRE[:-1]])
def test_malformed_bytes_fail_the_query(spark, payload):
    with pytest.raises(PythonException, match="DecodeError"):
        decoded(spark, [payload])


def test_empty_partition(spark):
    assert decoded(spark, []) == []


text = st.one_of(st.none(), st.text(max_size=8))
texts = st.lists(st.text(max_size=5), max_size=3)
instants = st.one_of(
    st.none(),
    st.datetimes(min_value=dt.datetime(1, 1, 3), max_value=dt.datetime(9999, 12, 28)),
)
flows = st.one_of(st.none(), st.tuples(text, text, instants))
messages = st.tuples(
    instants, text, texts, text, text, text, flows, texts, text, texts
)


@settings(max_examples=8, deadline=None)
@given(st.lists(messages, min_size=1, max_size=20))
def test_round_trip(spark, rows):
    frame = spark.createDataFrame(rows, TELEMETRY)
    back = decode_telemetry(frame.select(telemetry_payload().alias("value")))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.collect()))


def test_null_arrays_become_empty(spark):
    frame = spark.createDataFrame([(None,) * len(TELEMETRY)], TELEMETRY)
    back = decode_telemetry(frame.select(telemetry_payload().alias("value")))
    assert back.collect()[0].asDict() == EMPTY


def test_null_struct_encodes_to_null(spark):
    frame = spark.createDataFrame([(None,), ((None, "V", *[None] * 8),)], columns(row=TELEMETRY))
    payloads = frame.select(encode_message("row").alias("value")).collect()
    assert {p.value and bytes(p.value) for p in payloads} == {None, b"\x12\x01V"}


def test_the_payload_is_decoded_once(spark):
    rows = spark.createDataFrame([(WIRE,)], "value binary")
    plan = decode_telemetry(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("protobuf_decode(") == 1


def renumbered(syntax):
    """The telemetry message as another party may define it: other numbers, other syntax."""
    files = descriptor_pb2.FileDescriptorSet.FromString(telemetry_format().descriptors)
    file = files.file[-1]
    file.syntax = syntax
    file.package = "party"
    for message in file.message_type:
        for field in message.field:
            field.number += 100
            if field.type_name:
                field.type_name = field.type_name.replace(".eventlake.", ".party.")
    return MessageFormat("party.Telemetry", TELEMETRY, files.SerializeToString())


@pytest.mark.parametrize("syntax", ["proto2", "proto3"])
def test_the_callers_own_message_type(spark, syntax):
    form = renumbered(syntax)
    values = (None, "V", ["a"], "", None, "1.0", (None, "f", None), [], "x", [])
    frame = spark.createDataFrame([values], TELEMETRY)
    published = frame.select(telemetry_payload(form).alias("value"))
    assert bytes(published.first().value).startswith(b"\xb2\x06\x01V")  # field 102, text
    (row,) = decode_telemetry(published, form=form).collect()
    # Proto3 does not send empty text, so it cannot be told from an unset field.
    device = "" if syntax == "proto2" else None
    assert row.asDict(recursive=True) == frame.first().asDict(recursive=True) | {
        "device_type": device
    }


def test_engine_choice(spark):
    assert not jvm_protobuf(spark)
    with pytest.raises(ValueError, match="engine"):
        decode_message("value", engine="other")
    with pytest.raises(ValueError, match="descriptor set"):
        decode_message("value", MessageFormat("com.example.Telemetry"))


def test_jvm_engine_passes_the_descriptors(spark, monkeypatch):
    from pyspark.sql.protobuf import functions

    calls = []

    def stand_in(column, message, options=None, binaryDescriptorSet=None):
        calls.append((column, message, options, binaryDescriptorSet))
        return F.lit(None).cast(TELEMETRY)

    monkeypatch.setattr(functions, "from_protobuf", stand_in)
    monkeypatch.setattr(functions, "to_protobuf", stand_in)
    by_class = MessageFormat("com.example.Telemetry")
    decode_message("value", engine="jvm")
    encode_message("row", engine="jvm")
    decode_message("value", by_class, engine="jvm")
    depth = {"recursive.fields.max.depth": "10"}
    descriptors = descriptor_set(TELEMETRY_MESSAGE, TELEMETRY)
    assert calls == [
        ("value", TELEMETRY_MESSAGE, depth, descriptors),
        ("row", TELEMETRY_MESSAGE, None, descriptors),
        ("value", "com.example.Telemetry", depth, None),
    ]


def test_both_engines_give_the_columns_of_the_format(spark, monkeypatch):
    from pyspark.sql.protobuf import functions

    whole = StructType([*TELEMETRY.fields]).add("extra", "string")
    monkeypatch.setattr(
        functions, "from_protobuf", lambda *_, **__: F.lit(None).cast(whole)
    )
    rows = spark.createDataFrame([(WIRE,)], "value binary")
    for engine in ("jvm", "python"):
        assert decode_telemetry(rows, engine=engine).columns == TELEMETRY.names


def test_malformed_messages_become_null_on_demand(spark):
    rows = spark.createDataFrame([(1, b"\xff\xff"), (2, b"\x12\x01V"), (3, None)], "n int, value binary")
    found = decode_telemetry(rows, keep=["n"], options={"mode": "permissive"}).collect()
    assert {r.n: r.vin for r in found} == {1: None, 2: "V", 3: None}
    assert next(r for r in found if r.n == 1).data_uris is None


def test_options_without_effect_are_refused(spark):
    for options in ({"mode": "DROPMALFORMED"}, {"unwrap.primitive.wrapper.types": "true"}):
        with pytest.raises(ValueError, match="Python engine"):
            decode_message("value", engine="python", options=options)


@pytest.mark.parametrize("kind", ["date", "array<decimal(5,1)>", "struct<a: string, b: tinyint>"])
def test_types_without_a_field_are_refused_when_the_column_is_built(spark, kind):
    schema = StructType.fromDDL(f"a string, b {kind}")
    form = MessageFormat("party.Telemetry", schema, b"")
    for build in (decode_message, encode_message):
        with pytest.raises(TypeError, match=r"no Protobuf type for b(\.b)?:"):
            build("value", form, engine="python")


def test_a_null_in_an_array_is_named(spark):
    values = (None, "V", ["a", None], "", None, "1.0", None, [], "x", [])
    frame = spark.createDataFrame([values], TELEMETRY).select(telemetry_payload().alias("value"))
    with pytest.raises(PythonException, match="data_uris: a repeated field cannot hold NULL"):
        frame.collect()
