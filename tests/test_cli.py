from __future__ import annotations

import pytest

from eventlake import cli
from eventlake.cli import chosen_conf, chosen_format, chosen_topic, parser, run
from eventlake.functions.buckets import iceberg_bucket
from eventlake.functions.protobuf import MessageFormat
from eventlake.operators.decode import decode_json
from eventlake.sources.topics import DirectoryTopic, KafkaTopic, messages

INGEST = ["ingest-events", "--table", "t", "--checkpoint", "c"]


def parse(*words):
    return parser().parse_args([str(word) for word in words])


def test_intervals():
    kafka = ["--servers", "a:1", "--topic", "news"]
    assert parse(*INGEST, *kafka).every == "30 seconds"
    assert parse(*INGEST, *kafka, "--every", "5 seconds").every == "5 seconds"
    assert parse(*INGEST, *kafka, "--drain").every is None
    assert parse("ingest-telemetry", *INGEST[1:], *kafka).every == "1 minute"
    assert parse("write-words", "--output", "o", "--checkpoint", "c").every == "5 minutes"


def test_rebalancing():
    ingest = [*INGEST, "--directory", "/d"]
    assert parse(*ingest).rebalance is None
    assert parse(*ingest, "--rebalance").rebalance is True
    assert parse(*ingest, "--no-rebalance").rebalance is False


def test_topics():
    limited = ["--max-per-batch", "9"]
    kafka = parse(*INGEST, "--servers", "a:1", "--topic", "news", *limited)
    assert chosen_topic(kafka) == KafkaTopic("a:1", "news", max_offsets=9)
    folder = parse(*INGEST, "--directory", "/d", *limited)
    assert chosen_topic(folder) == DirectoryTopic("/d", max_files=9)
    bytes_ = parse(*INGEST, "--directory", "/d", "--max-bytes", 5)
    assert chosen_topic(bytes_) == DirectoryTopic("/d", max_bytes=5)
    with pytest.raises(SystemExit):
        chosen_topic(parse(*INGEST, "--servers", "a:1"))
    with pytest.raises(SystemExit):
        parse(*INGEST, "--directory", "/d", "--max-bytes", 5, "--max-per-batch", 5)
    with pytest.raises(SystemExit):
        chosen_topic(parse(*INGEST, "--servers", "a:1", "--topic", "t", "--max-bytes", 5))
    with pytest.raises(SystemExit):
        chosen_topic(parse(*INGEST, "--directory", "/d", "--option", "a=b"))
    with pytest.raises(SystemExit):
        parse(*INGEST, "--directory", "/d", "--option", "nothing")
    with pytest.raises(SystemExit):
        parse(*INGEST)


def test_topic_options():
    kafka = ["--servers", "a:1", "--topic", "news"]
    secured = ["--option", "kafka.security.protocol=SSL", "--option", "a=b=c"]
    reader = chosen_topic(
        parse(*INGEST, *kafka, *secured, "--starting", "latest", "--min-partitions", 64)
    ).reader_options()
    assert reader["kafka.security.protocol"] == "SSL" and reader["a"] == "b=c"
    assert (reader["startingOffsets"], reader["minPartitions"]) == ("latest", "64")
    writer = chosen_topic(parse("publish-events", *kafka, *secured)).writer_options()
    assert writer["kafka.security.protocol"] == "SSL"
    assert "startingOffsets" not in writer


def test_catalog_settings(monkeypatch):
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "reader")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "hidden")
    bound = parse(
        "--catalog-uri", "http://c", "--warehouse", "s3a://w/", "--store-endpoint", "http://s",
        *INGEST, "--directory", "/d",
    )
    conf = chosen_conf(bound)
    assert conf["spark.sql.catalog.spark_catalog.uri"] == "http://c"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://s"
    assert chosen_conf(parse(*INGEST, "--directory", "/d")) == {}
    with pytest.raises(SystemExit):
        chosen_conf(parse("--catalog-uri", "http://c", *INGEST, "--directory", "/d"))


def test_jobs_end_to_end(spark, tmp_path, table_name, capsys):
    topic, folder = tmp_path / "topic", tmp_path / "table"
    run(spark, parse("publish-events", "--count", 20, "--directory", topic))
    found = messages(spark, DirectoryTopic(str(topic)))
    assert decode_json(found).select("id").distinct().count() == 20
    ingest = ["--table", table_name, "--location", folder, "--directory", topic]
    run(spark, parse("ingest-events", *ingest, "--checkpoint", tmp_path / "c", "--drain"))
    assert "batch 0: 20 rows landed" in capsys.readouterr().out
    assert spark.table(table_name).count() == 20


def test_telemetry_jobs_end_to_end(spark, tmp_path, table_name):
    topic, folder = tmp_path / "topic", tmp_path / "table"
    run(spark, parse("publish-telemetry", "--directory", topic))
    ingest = ["--table", table_name, "--location", folder, "--directory", topic, "--drop-null"]
    run(spark, parse("ingest-telemetry", *ingest, "--checkpoint", tmp_path / "c", "--drain"))
    landed = spark.table(table_name)
    assert {r.vin_hash for r in landed.collect()} == {"VIN0", "VIN1"}
    buckets = landed.select("flow_aui_bucket", iceberg_bucket(16, "flow_aui")).collect()
    assert all(stored == bucket for stored, bucket in buckets)


def test_continuous_publishing_needs_a_checkpoint(spark):
    with pytest.raises(SystemExit):
        run(spark, parse("publish-events", "--per-second", 5, "--directory", "/d"))
    paced = parse("publish-events", "--per-second", 5, "--directory", "/d", "--checkpoint", "c")
    assert paced.every == "1 second"


def test_own_message_type(tmp_path):
    (tmp_path / "d").write_bytes(b"set")
    topic = ["publish-telemetry", "--directory", "/d"]
    assert chosen_format(parse(*topic)) is None
    named = parse(*topic, "--message", "a.B", "--descriptors", tmp_path / "d")
    assert chosen_format(named) == MessageFormat("a.B", descriptors=b"set")
    assert chosen_format(parse(*topic, "--message", "a.B")) == MessageFormat("a.B")
    with pytest.raises(SystemExit):
        chosen_format(parse(*topic, "--descriptors", "d"))


def test_copy_job(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n")
    copy = ["copy-csv", "--source", tmp_path / "in.csv", "--target", tmp_path / "out"]
    run(spark, parse(*copy, "--output-files", 1))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("1", "2")]


def test_word_job(spark, tmp_path):
    words = ["write-words", "--output", tmp_path / "out", "--checkpoint", tmp_path / "c"]
    run(spark, parse(*words, "--drain"))
    assert (tmp_path / "out/_spark_metadata").is_dir()


def test_main_stops_its_session(monkeypatch):
    events = []

    class Session:
        def stop(self):
            events.append("stopped")

    monkeypatch.setattr(cli, "build_session", lambda app, conf: events.append(app) or Session())
    monkeypatch.setattr(cli, "run", lambda spark, args: events.append(args.job))
    cli.main(["copy-csv", "--source", "a", "--target", "b"])
    assert events == ["eventlake-copy-csv", "copy-csv", "stopped"]
