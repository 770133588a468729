"""What reaches the scans, and where the jobs shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlake.operators.encode import (
    json_payload,
    sample_telemetry,
    synthetic_events,
    telemetry_payload,
    to_envelope,
)
from eventlake.operators.shape import word_rows
from eventlake.plans.checks import QUERIES
from eventlake.plans.ingest import event_rows, flow_rows
from eventlake.schemas import ENVELOPE


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def messages(spark, tmp_path):
    spark.createDataFrame([], ENVELOPE).write.parquet(str(tmp_path / "topic"))
    return spark.read.schema(ENVELOPE).parquet(str(tmp_path / "topic"))


@pytest.mark.parametrize("shape", [event_rows, flow_rows])
def test_only_the_payload_is_read(messages, shape):
    assert "ReadSchema: struct<value:binary>" in plan(shape(messages))


def test_dropping_null_payloads_reaches_the_scan(messages):
    assert "PushedFilters: [IsNotNull(value)]" in plan(flow_rows(messages, drop_null=True))
    assert "PushedFilters: []" in plan(flow_rows(messages))


def test_decoding_and_encoding_do_not_shuffle(spark, messages):
    numbers = spark.range(10).withColumnRenamed("id", "value")
    events, telemetry = synthetic_events(spark.range(10)), sample_telemetry(spark.range(10))
    shaped = [
        event_rows(messages),
        flow_rows(messages, drop_null=True),
        word_rows(numbers),
        to_envelope(events, json_payload()),
        to_envelope(telemetry, telemetry_payload(), F.lit("key")),
    ]
    for rows in shaped:
        assert "Exchange" not in plan(rows) and "Sort" not in plan(rows)


MAP_ONLY = (
    "bucket16", "ingest_date_parts", "json_decode_permissive", "json_encode", "telemetry_flatten",
    "telemetry_optional_fields", "telemetry_permissive", "word_rows",
)


@pytest.mark.parametrize("name", MAP_ONLY)
def test_map_only_queries_do_not_shuffle(spark, tmp_path, name):
    """Whatever the size of the table: one file and one row, or more files than cores."""
    event = ("timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS event_id", "id AS user_id")
    for rows, files in ((1, 1), (200, 40)):
        events = spark.range(rows, numPartitions=files).selectExpr(
            *event, "'view' AS event_type", "1.5D AS value"
        )
        folder = tmp_path / str(files)
        events.write.parquet(str(folder / "events.parquet"))
        found = QUERIES[name](spark, str(folder))
        assert "Exchange" not in plan(found) and found.count() == rows
