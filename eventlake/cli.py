"""Command line for the jobs: `python -m eventlake <job> …`, or through `spark-submit`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from eventlake.functions.protobuf import READ_OPTIONS, MessageFormat
from eventlake.operators.encode import sample_telemetry
from eventlake.plans.copy import csv_to_parquet
from eventlake.plans.ingest import ingest_events, ingest_telemetry
from eventlake.plans.produce import (
    publish_synthetic_events,
    publish_telemetry,
    stream_synthetic_events,
    write_words,
)
from eventlake.session import build_session
from eventlake.settings import ObjectStore, RestCatalog, session_conf
from eventlake.sinks.tables import (
    LakeTable,
    event_table,
    flow_table,
    open_table,
    quarantine_table,
)
from eventlake.sources.generated import rate_rows
from eventlake.sources.topics import DirectoryTopic, KafkaTopic, Topic
from eventlake.streaming.batches import BatchMetric
from eventlake.streaming.control import (
    JSON_EVENT_INTERVAL,
    PUBLISH_INTERVAL,
    TELEMETRY_INTERVAL,
    WORD_INTERVAL,
)


def named_value(text: str) -> tuple[str, str]:
    name, equal, value = text.partition("=")
    if not (name and equal):
        raise argparse.ArgumentTypeError(f"{text} is not NAME=VALUE")
    return name, value


def add_topic(job: argparse.ArgumentParser) -> None:
    where = job.add_mutually_exclusive_group(required=True)
    where.add_argument("--servers", help="Kafka bootstrap servers; needs --topic")
    where.add_argument("--directory", help="directory of envelope files, without a broker")
    job.add_argument("--topic", help="Kafka topic")
    job.add_argument(
        "--option", type=named_value, action="append", default=[], metavar="NAME=VALUE",
        help="Kafka option of the job, such as kafka.security.protocol=SSL; may be repeated",
    )


def add_reading(job: argparse.ArgumentParser) -> None:
    job.add_argument(
        "--starting", default="earliest", help="Kafka offsets of the first run (default earliest)"
    )
    job.add_argument("--min-partitions", type=int, help="tasks that read Kafka, at least")
    limit = job.add_mutually_exclusive_group()
    limit.add_argument("--max-per-batch", type=int, help="messages (or files) per micro-batch")
    limit.add_argument("--max-bytes", type=int, help="bytes of files per micro-batch")


def add_stream(job: argparse.ArgumentParser, every: str) -> None:
    job.add_argument("--checkpoint", required=True)
    pace = job.add_mutually_exclusive_group()
    pace.add_argument("--every", default=every, help=f"micro-batch interval (default {every})")
    pace.add_argument(
        "--drain", action="store_const", const=None, dest="every", help="read the backlog, stop"
    )


def add_table(job: argparse.ArgumentParser) -> None:
    job.add_argument("--table", required=True)
    job.add_argument("--location", help="folder of a Parquet table, without an Iceberg catalog")
    job.add_argument(
        "--rebalance",
        action=argparse.BooleanOptionalAction,
        help="shuffle each batch into few, full files (default: for partitioned Parquet tables)",
    )


def add_quarantine(job: argparse.ArgumentParser) -> None:
    job.add_argument("--quarantine", help="table for messages that cannot be read")
    job.add_argument("--quarantine-location", help="folder of that table, if it is a Parquet one")


def add_message(job: argparse.ArgumentParser) -> None:
    job.add_argument("--message", help="full name of your Protobuf message type or its JVM class")
    job.add_argument("--descriptors", help="local file with the descriptor set of --message")


def add_decoding(job: argparse.ArgumentParser) -> None:
    job.add_argument(
        "--decode-option", type=named_value, action="append", default=[], metavar="NAME=VALUE",
        help="Protobuf reader option, such as mode=PERMISSIVE; may be repeated",
    )


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="eventlake", description=__doc__)
    root.add_argument("--catalog-uri", help="Iceberg REST catalog")
    root.add_argument("--catalog-name", default="spark_catalog")
    root.add_argument("--warehouse", help="warehouse path of the catalog")
    root.add_argument("--store-endpoint", help="S3-compatible store; keys: AWS_* variables")
    jobs = root.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest-events", help="land JSON events")
    add_topic(job)
    add_reading(job)
    add_table(job)
    add_quarantine(job)
    add_stream(job, JSON_EVENT_INTERVAL)

    job = jobs.add_parser("ingest-telemetry", help="land Protobuf telemetry")
    add_topic(job)
    add_reading(job)
    add_decoding(job)
    add_table(job)
    add_quarantine(job)
    add_stream(job, TELEMETRY_INTERVAL)
    add_message(job)
    job.add_argument("--drop-null", action="store_true", help="skip messages without a payload")

    job = jobs.add_parser("write-words", help="write generated words to CSV files")
    job.add_argument("--output", required=True)
    job.add_argument("--per-second", type=int, default=1)
    add_stream(job, WORD_INTERVAL)

    job = jobs.add_parser("copy-csv", help="copy headered CSV to Parquet")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--preview", action="store_true")
    job.add_argument("--output-files", type=int)

    job = jobs.add_parser("publish-events", help="publish random JSON events")
    amount = job.add_mutually_exclusive_group()
    amount.add_argument("--count", type=int, default=1)
    amount.add_argument("--per-second", type=int, help="keep publishing; needs --checkpoint")
    job.add_argument("--checkpoint")
    job.add_argument("--every", default=PUBLISH_INTERVAL, help="micro-batch interval")
    add_topic(job)

    job = jobs.add_parser("publish-telemetry", help="publish sample telemetry")
    job.add_argument("--count", type=int, default=2)
    add_topic(job)
    add_message(job)
    return root


def chosen_topic(args: argparse.Namespace) -> Topic:
    limit, size = getattr(args, "max_per_batch", None), getattr(args, "max_bytes", None)
    if args.directory:
        if args.option:
            raise SystemExit("--option needs --servers")
        return DirectoryTopic(args.directory, max_files=limit, max_bytes=size)
    if not args.topic:
        raise SystemExit("--servers needs --topic")
    if size is not None:
        raise SystemExit("--max-bytes needs --directory")
    return KafkaTopic(
        args.servers,
        args.topic,
        starting_offsets=getattr(args, "starting", "earliest"),
        max_offsets=limit,
        min_partitions=getattr(args, "min_partitions", None),
        options=dict(args.option),
    )


def chosen_format(args: argparse.Namespace) -> MessageFormat | None:
    if args.message is None:
        if args.descriptors:
            raise SystemExit("--descriptors needs --message")
        return None
    descriptors = Path(args.descriptors).read_bytes() if args.descriptors else None
    return MessageFormat(args.message, descriptors=descriptors)


def chosen_conf(args: argparse.Namespace) -> dict[str, str]:
    catalog = store = None
    if args.store_endpoint:
        store = ObjectStore(args.store_endpoint)
    if args.catalog_uri:
        if not args.warehouse:
            raise SystemExit("--catalog-uri needs --warehouse")
        catalog = RestCatalog(args.catalog_uri, args.warehouse, args.catalog_name)
    return session_conf(catalog, store)


def print_batch(metric: BatchMetric) -> None:
    aside = f", {metric.quarantined} messages set aside" if metric.quarantined else ""
    print(f"batch {metric.batch}: {metric.rows} rows landed{aside}", flush=True)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    def table(spec) -> LakeTable:
        return open_table(spark, spec(args.table), args.location, args.rebalance)

    def quarantine() -> LakeTable | None:
        if not args.quarantine:
            return None
        return open_table(spark, quarantine_table(args.quarantine), args.quarantine_location)

    if args.job == "ingest-events":
        ingest_events(
            spark,
            chosen_topic(args),
            table(event_table),
            args.checkpoint,
            args.every,
            on_batch=print_batch,
            quarantine=quarantine(),
        ).awaitTermination()
    elif args.job == "ingest-telemetry":
        ingest_telemetry(
            spark,
            chosen_topic(args),
            table(flow_table),
            args.checkpoint,
            args.every,
            drop_null=args.drop_null,
            form=chosen_format(args),
            options={**READ_OPTIONS, **dict(args.decode_option)},
            on_batch=print_batch,
            quarantine=quarantine(),
        ).awaitTermination()
    elif args.job == "write-words":
        numbers = rate_rows(spark, args.per_second)
        write_words(numbers, args.output, args.checkpoint, args.every).awaitTermination()
    elif args.job == "copy-csv":
        csv_to_parquet(spark, args.source, args.target, args.preview, args.output_files)
    elif args.job == "publish-events" and args.per_second:
        if not args.checkpoint:
            raise SystemExit("--per-second needs --checkpoint")
        numbers = rate_rows(spark, args.per_second)
        stream_synthetic_events(
            numbers, chosen_topic(args), args.checkpoint, args.every
        ).awaitTermination()
    elif args.job == "publish-events":
        publish_synthetic_events(spark.range(args.count), chosen_topic(args))
    else:
        rows = sample_telemetry(spark.range(args.count))
        publish_telemetry(rows, chosen_topic(args), "id", chosen_format(args))


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"eventlake-{args.job}", chosen_conf(args))
    try:
        run(spark, args)
    finally:
        spark.stop()
