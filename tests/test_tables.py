from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from pathlib import Path
from statistics import median

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventlake.functions.buckets import bucket_of
from eventlake.schemas import EVENT_COLUMNS, FLOW_COLUMNS, INT, TEXT, columns
from eventlake.sinks import tables
from eventlake.sinks.tables import (
    Bucket,
    IcebergTable,
    ParquetTable,
    TableSpec,
    event_table,
    flow_table,
    hot_pieces,
    open_table,
    partition_mark,
)

FLOW_DECLARED = (
    "`tmc_arrival_timestamp` timestamp, `vin_hash` string, `data_uris` array<string>, "
    "`device_type` string, `region` string, `protocol_version` string, `flow_name` string, "
    "`flow_timestamp` timestamp, `correlation_ids` array<string>, `asset_id` string, "
    "`expiration_length_types` array<string>, `year` int, `month` int, `day` int, `hour` int, "
    "`flow_aui` string"
)


def flows(spark, count, keys, hours=1):
    """`count` landed rows over the given flow ids and ingest hours."""
    turn = (F.col("id") % len(keys) + 1).cast("int")
    key = F.element_at(F.array(*[F.lit(k) for k in keys]), turn)
    filled = {
        "correlation_ids": F.array(F.col("id").cast("string")),
        "year": F.lit(2024),
        "month": F.lit(1),
        "day": F.lit(2),
        "hour": (F.col("id") % hours).cast("int"),
        "flow_aui": key,
    }
    return spark.range(count).select(
        *[
            filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in FLOW_COLUMNS
        ]
    )


def numbers(rows):
    return sorted(int(r[0]) for r in rows.select(F.col("correlation_ids")[0]).collect())


def test_iceberg_ddl():
    assert event_table("lake.db.events").iceberg_ddl() == (
        "CREATE TABLE IF NOT EXISTS lake.db.events (`id` string, `timestamp` timestamp, "
        "`value` double, `doubled_value` double, `processing_time` timestamp) USING iceberg"
    )
    assert flow_table("lake.db.flows").iceberg_ddl() == (
        f"CREATE TABLE IF NOT EXISTS lake.db.flows ({FLOW_DECLARED}) USING iceberg "
        "PARTITIONED BY (bucket(16, `flow_aui`), `year`, `month`, `day`, `hour`)"
    )


def test_parquet_ddl():
    assert flow_table("flows").parquet_ddl("/lake/flows") == (
        f"CREATE TABLE IF NOT EXISTS flows ({FLOW_DECLARED}, `flow_aui_bucket` int, "
        "`ingest_run` string, `ingest_batch` bigint) USING parquet PARTITIONED BY (`ingest_run`, "
        "`ingest_batch`, `flow_aui_bucket`, `year`, `month`, `day`, `hour`) LOCATION '/lake/flows'"
    )


def test_table_format_follows_the_catalog(spark, monkeypatch):
    spec = event_table("spark_catalog.default.events")
    assert open_table(spark, spec, "/lake/events") == ParquetTable(spec, "/lake/events")
    with pytest.raises(ValueError, match="location"):
        open_table(spark, spec)
    spark.conf.set("spark.sql.catalog.elsewhere", "org.apache.iceberg.spark.SparkCatalog")
    try:
        spec = event_table("elsewhere.db.events")
        assert open_table(spark, spec) == IcebergTable(spec)
    finally:
        spark.conf.unset("spark.sql.catalog.elsewhere")


def test_create_twice_keeps_rows_and_columns(spark, tmp_path, table_name):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    table.append(flows(spark, 10, ["a"]), "run", 0)
    table.create(spark)
    found = table.read(spark)
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in FLOW_COLUMNS
    ]
    assert found.count() == 10


def test_fully_qualified_names(spark, tmp_path, table_name):
    spec = flow_table(f"spark_catalog.default.{table_name}")
    table = open_table(spark, spec, str(tmp_path / "t"))
    for _ in range(2):
        table.create(spark)
        table.append(flows(spark, 10, ["a"]), "run", 0)
    assert numbers(table.read(spark, flow_aui="a")) == list(range(10))


def test_a_new_catalog_finds_landed_rows(spark, tmp_path, table_name):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    table.append(flows(spark, 10, ["a", None]), "run", 0)
    spark.sql(f"DROP TABLE {table_name}")
    table.create(spark)
    assert numbers(table.read(spark)) == list(range(10))


def test_append_matches_by_name(spark, tmp_path, table_name):
    table = ParquetTable(event_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    row = ("a", dt.datetime(2024, 1, 1), 1.0, 2.0, dt.datetime(2024, 1, 2))
    rows = spark.createDataFrame([row], EVENT_COLUMNS)
    table.append(rows.select(*reversed(rows.columns)), "run", 0)
    assert tuple(table.read(spark).collect()[0]) == row


def test_landed_times_carry_statistics(spark, tmp_path, table_name):
    table = ParquetTable(event_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    when = dt.datetime(2024, 1, 1, 0, 0, 0, 7)
    rows = spark.createDataFrame([("a", when, 1.0, 2.0, when)], EVENT_COLUMNS).coalesce(1)
    table.append(rows, "run", 0)
    (file,) = (tmp_path / "t").rglob("*.parquet")
    column = pq.read_metadata(file).row_group(0).column(1)
    assert column.path_in_schema == "timestamp" and column.physical_type == "INT64"
    assert column.statistics.min.replace(tzinfo=None) == when


@pytest.mark.parametrize("change", ["drop", "add"])
def test_append_refuses_other_columns(spark, tmp_path, table_name, change):
    table = ParquetTable(event_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    rows = spark.createDataFrame([], EVENT_COLUMNS)
    rows = rows.drop("value") if change == "drop" else rows.withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="value" if change == "drop" else "more"):
        table.append(rows, "run", 0)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_replayed_batch_replaces_itself(spark, tmp_path, table_name, mode):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    table.append(flows(spark, 10, ["a", "b"]), "run", 0)
    table.append(flows(spark, 5, ["c"]), "run", 1)
    table.append(flows(spark, 5, ["c"]), "other run", 0)
    # The replay touches fewer partitions than the first attempt; nothing of that may stay.
    table.append(flows(spark, 4, ["b"]), "run", 0)
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert numbers(table.read(spark)) == sorted([*range(4), *range(5), *range(5)])
    assert table.read(spark, flow_aui="a").isEmpty()


def test_reads_prune_by_partition_and_bucket(spark, tmp_path, table_name):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    keys = ["flow_123", "iceberg", None]
    table.append(flows(spark, 90, keys, hours=5), "run", 0)
    whole = table.read(spark)
    assert numbers(whole) == list(range(90))

    one_hour = table.read(spark, hour=3)
    plan = one_hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    assert numbers(one_hour) == [n for n in range(90) if n % 5 == 3]

    for i, (key, bucket) in enumerate([("flow_123", 12), ("iceberg", 9), (None, None)]):
        found = table.read(spark, flow_aui=key)
        assert numbers(found) == [n for n in range(90) if n % 3 == i]
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        expected = f"= {bucket})" if key else "isnull(flow_aui_bucket"
        assert expected in filters


def test_partition_directories_hold_the_bucket(spark, tmp_path, table_name):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    table.append(flows(spark, 10, ["flow_123", None]), "run", 0)
    batch = tmp_path / "t/ingest_run=run/ingest_batch=0"
    buckets = {path.name for path in batch.iterdir() if path.is_dir()}
    assert buckets == {"flow_aui_bucket=12", "flow_aui_bucket=__HIVE_DEFAULT_PARTITION__"}


def test_a_hot_partition_is_split_over_writers(spark, tmp_path, table_name):
    spec = TableSpec(table_name, columns(key=TEXT, part=INT, pad=TEXT), (Bucket("key", 16), "part"))
    table = ParquetTable(spec, str(tmp_path / "t"))
    table.create(spark)
    other = F.concat(F.lit("k"), F.col("id") % 97)
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(other).alias("key"),
        F.lit(1).alias("part"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "500k")
    try:
        table.append(rows, "run", 0)
    finally:
        spark.conf.unset(size)
    hot_files = list((tmp_path / "t").rglob(f"key_bucket={bucket_of(16, 'hot')}/**/*.parquet"))
    assert max(pq.read_metadata(file).num_rows for file in hot_files) <= 10_000
    assert table.read(spark).count() == 60_000


@pytest.mark.parametrize("sketch_first", [True, False])
def test_a_hot_flow_from_two_map_tasks_is_written_by_many(spark, tmp_path, table_name, sketch_first):
    """Two thirds of the rows are one flow's. The second batch knows it from the first."""
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"), sketch_first=sketch_first)
    table.create(spark)
    keys = ["hot", "hot"] * 40 + [f"k{i}" for i in range(40)]
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for batch in range(1 if sketch_first else 2):
            pad = F.sha2(F.col("correlation_ids")[0], 512)
            rows = flows(spark, 60_000, keys).withColumn("vin_hash", pad).coalesce(2)
            assert table.append(rows, "run", batch) == 60_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    rows_of_tasks = Counter()
    for file in (tmp_path / "t" / "ingest_run=run" / f"ingest_batch={batch}").rglob("*.parquet"):
        # part-<task>-…: what one task wrote, over all partitions.
        rows_of_tasks[file.name.split("-")[1]] += pq.read_metadata(file).num_rows
    assert len(rows_of_tasks) > 8
    assert max(rows_of_tasks.values()) <= 2 * median(rows_of_tasks.values())
    assert table.read(spark).count() == 60_000 * (batch + 1)
    mark = spark.range(1).select(partition_mark([F.lit(bucket_of(16, "hot"))])).first()[0]
    assert table.hot[mark] == max(table.hot.values()) > 30


def test_no_partition_is_hot_among_equals():
    assert hot_pieces([(1, 10), (2, 11), (3, 9)], 30, 200) == {}
    assert hot_pieces([(1, 100), (2, 10), (3, 10)], 120, 12) == {1: 10}
    assert hot_pieces([(7, 50)], 50, 8) == {7: 8}
    assert hot_pieces([], 0, 8) == {}


def test_hot_rows_land_once_after_lost_tasks(spark, tmp_path, table_name):
    """The salt is a hash of the row, so a task that runs again sends it to the same writer."""
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"), sketch_first=True)
    table.create(spark)
    rows = flows(spark, 3000, ["hot", "hot", "b", "c", "d"])
    rows = rows.withColumn("vin_hash", fails_at_first(F.col("asset_id")))
    assert table.append(rows, "run", 0) == 3000
    assert table.hot
    assert numbers(table.read(spark)) == list(range(3000))


def test_joins_read_the_buckets_of_their_keys(spark, tmp_path, table_name, monkeypatch):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    keys = [*"abcdefghij", None]
    table.append(flows(spark, 110, keys), "run", 0)
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("c", 1), (None, 1), ("none", 1)], "flow_aui string, n int")
    expected = [i for i in range(110) if keys[i % 11] in ("a", "c")]
    found = table.matching(spark, wanted, "flow_aui")
    assert found.columns == table.spec.columns.names
    assert numbers(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    buckets = {bucket_of(16, key) for key in ("a", "c", "none")}
    scanned = {str(Path(file).parent).split("flow_aui_bucket=")[1].split("/")[0] for file in found.inputFiles()}
    assert len(buckets) < len({bucket_of(16, key) for key in "abcdefghij"}) and scanned
    monkeypatch.setattr(tables, "BROADCAST_KEYS", 1)
    many = table.matching(spark, wanted, "flow_aui")
    assert numbers(many) == expected
    plan = many._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert all(str(number) in filters for number in buckets) and "flow_aui_bucket" in filters
    assert numbers(table.matching(spark, wanted.where("n > 5"), "flow_aui")) == []


@pytest.mark.parametrize("spec", [event_table, flow_table])
def test_append_counts_rows_and_takes_empty_batches(spark, tmp_path, table_name, spec):
    table = ParquetTable(spec(table_name), str(tmp_path / "t"))
    table.create(spark)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.spec.columns]
    filtered_away = spark.range(10).where("id * 2 = 7").select(*nulls)
    assert table.append(spark.range(12).select(*nulls), "run", 0) == 12
    assert table.append(filtered_away, "run", 1) == 0
    assert table.append(spark.createDataFrame([], table.spec.columns), "run", 2) == 0
    assert table.read(spark).count() == 12


@pytest.fixture
def written_plans(spark, monkeypatch):
    """The physical plans of the frames that SQL statements are given."""
    plans, run_sql = [], type(spark).sql

    def watched(session, text, **frames):
        plans.extend(f._jdf.queryExecution().executedPlan().toString() for f in frames.values())
        return run_sql(session, text, **frames)

    monkeypatch.setattr(type(spark), "sql", watched)
    return plans


def test_rows_are_counted_above_the_shuffle(spark, tmp_path, table_name, written_plans):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    table.append(flows(spark, 10, ["a"]), "run", 0)
    (plan,) = written_plans
    assert plan.index("CollectMetrics") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def test_without_aqe_there_is_no_skewed_shuffle(spark, tmp_path, table_name, written_plans):
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert table.append(flows(spark, 10, ["a"]), "run", 0) == 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (plan,) = written_plans
    assert "Exchange" not in plan


@pytest.mark.parametrize(
    "spec, rebalance, files",
    [(event_table, None, 8), (event_table, True, 1), (flow_table, None, 1), (flow_table, False, 8)],
)
def test_rebalancing_is_a_choice(spark, tmp_path, table_name, spec, rebalance, files):
    table = ParquetTable(spec(table_name), str(tmp_path / "t"), rebalance)
    table.create(spark)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.spec.columns]
    assert table.append(spark.range(80, numPartitions=8).select(*nulls), "run", 0) == 80
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == files


@F.udf(TEXT)
def fails_at_first(text):
    from pyspark import TaskContext

    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
    return text


@pytest.mark.parametrize("spec", [event_table, flow_table])
def test_lost_tasks_neither_drop_nor_repeat_rows(spark, tmp_path, table_name, spec):
    table = ParquetTable(spec(table_name), str(tmp_path / "t"))
    table.create(spark)
    text = table.spec.columns.names[-1] if spec is flow_table else "id"
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in table.spec.columns}
    number = fails_at_first(F.col("number").cast("string"))
    rows = spark.range(100, numPartitions=4).withColumnRenamed("id", "number")
    rows = rows.withColumns(nulls | {text: number}).drop("number")
    assert table.append(rows, "run", 0) == 100
    landed = [int(row[0]) for row in table.read(spark).select(text).collect()]
    assert sorted(landed) == list(range(100))


class Lake:
    """Stands in for a session with an Iceberg table, its snapshots and its ledger.

    It is the frame and the writer of an append as well. Tables are asked as frames of Spark's.
    """

    def __init__(self, spark):
        self.spark, self.calls, self.clock = spark, [], dt.datetime(2024, 1, 1)
        self.sparkSession, self.columns = self, EVENT_COLUMNS.names
        self.snapshots, self.entries, self.tags, self.crash = [], {}, {}, None

    def tick(self):
        self.clock += dt.timedelta(minutes=1)
        return self.clock

    def table(self, name):
        if name == "lake.db.events.snapshots":
            kind = "summary map<string, string>, committed_at timestamp, parent_id long"
            return self.spark.createDataFrame(self.snapshots, kind)
        assert name == "lake.db.events_ledger"
        rows = [(run, *entry) for run, entry in self.entries.items()]
        kind = "ingest_run string, ingest_batch long, landed_rows long, landed_at timestamp"
        return self.spark.createDataFrame(rows, kind)

    def createDataFrame(self, rows, kind):
        ((run, batch, n),) = rows
        return Entry(self, run, batch, n)

    def expire(self, keep):
        self.snapshots = self.snapshots[-keep:]

    def select(self, *names):
        return self

    def writeTo(self, name):
        assert name == "lake.db.events"
        self.tags = {}
        return self

    def option(self, name, value):
        self.tags[name.removeprefix("snapshot-property.")] = value
        return self

    def append(self):
        parent = len(self.calls) or None
        self.calls.append(dict(self.tags))
        self.snapshots.append((self.tags | {"added-records": "5"}, self.tick(), parent))


class Entry:
    def __init__(self, lake, *values):
        self.lake, self.values = lake, values

    def select(self, *columns):
        return self

    def writeTo(self, name):
        assert name == "lake.db.events_ledger"
        return self

    def overwritePartitions(self):
        if self.lake.crash:
            raise self.lake.crash
        run, batch, n = self.values
        self.lake.entries[run] = (batch, n, self.lake.tick())


@pytest.fixture
def lake(spark):
    return Lake(spark)


ICEBERG = IcebergTable(event_table("lake.db.events"))


def test_iceberg_append_lands_a_batch_once(lake):
    assert [ICEBERG.append(lake, "run", batch) for batch in (6, 7, 7)] == [5, 5, 5]
    assert ICEBERG.append(lake, "run", 6) == 0
    assert lake.calls == [{"ingest-run": "run", "ingest-batch": b} for b in ("6", "7")]
    assert ICEBERG.append(lake, "other", 0) == 5
    assert {run: entry[0] for run, entry in lake.entries.items()} == {"run": 7, "other": 0}


def test_iceberg_replay_after_the_tags_are_gone(lake):
    for batch in range(3):
        ICEBERG.append(lake, "run", batch)
    lake.snapshots.append(({}, lake.tick(), 3))
    lake.expire(1)
    assert ICEBERG.append(lake, "run", 2) == 5
    assert len(lake.calls) == 3


def test_iceberg_crash_between_table_and_ledger(lake):
    ICEBERG.append(lake, "run", 0)
    lake.crash = RuntimeError("crash")
    with pytest.raises(RuntimeError, match="crash"):
        ICEBERG.append(lake, "run", 1)
    lake.crash = None
    # The tags tell, and the ledger is mended.
    assert ICEBERG.append(lake, "run", 1) == 5
    assert len(lake.calls) == 2 and lake.entries["run"][0] == 1


def test_iceberg_says_so_if_nobody_can_tell(lake):
    ICEBERG.append(lake, "run", 0)
    lake.crash = RuntimeError("crash")
    with pytest.raises(RuntimeError, match="crash"):
        ICEBERG.append(lake, "run", 1)
    lake.crash = None
    lake.snapshots.append(({}, lake.tick(), 2))
    lake.expire(1)
    with pytest.raises(RuntimeError, match="batch 1 of run run may have landed"):
        ICEBERG.append(lake, "run", 1)
    assert len(lake.calls) == 2


def test_iceberg_expiry_before_the_last_entry_is_no_doubt(lake):
    for batch in range(4):
        ICEBERG.append(lake, "run", batch)
    lake.expire(2)
    assert ICEBERG.append(lake, "run", 4) == 5
    assert len(lake.calls) == 5


def test_iceberg_ledger_is_asked_by_partition_only():
    assert ICEBERG.ledger.iceberg_ddl() == (
        "CREATE TABLE IF NOT EXISTS lake.db.events_ledger (`ingest_run` string, `ingest_batch` "
        "bigint, `landed_rows` bigint, `landed_at` timestamp) USING iceberg PARTITIONED BY (`ingest_run`)"
    )


def test_iceberg_reads_by_key(spark):
    name = f"v_{id(spark)}"
    flows(spark, 9, ["a", "b", None]).createOrReplaceTempView(name)
    table = IcebergTable(flow_table(name))
    assert numbers(table.read(spark, flow_aui="b", hour=0)) == [1, 4, 7]
    assert numbers(table.read(spark, flow_aui=None)) == [2, 5, 8]


def test_an_observation_that_never_comes_does_not_stop_the_append(
    spark, tmp_path, table_name, monkeypatch
):
    monkeypatch.setattr(tables, "told", lambda observation: False)
    monkeypatch.setattr(tables, "METRIC_WAIT", 0.2)
    table = ParquetTable(flow_table(table_name), str(tmp_path / "t"))
    table.create(spark)
    assert table.append(flows(spark, 12, ["a", "b", None]), "run", 0) == 12
    assert table.append(flows(spark, 5, ["a"]), "run", 1) == 5
    assert table.append(flows(spark, 4, ["b"]), "run", 1) == 4
    assert table.read(spark).count() == 16
