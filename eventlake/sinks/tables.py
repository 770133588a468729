"""Lake tables: declaration, layout, appending micro-batches, pruned reads.

`IcebergTable` leaves layout and commits to Iceberg. `ParquetTable` serves sessions without the
Iceberg package: a Parquet table in Spark's own catalog whose leading partition columns name the
stream and the micro-batch a row came from. Both append by column name, and both land a replayed
micro-batch once.
"""

from __future__ import annotations

import json
import math
import time
from dataclasses import dataclass, field
from statistics import median

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from eventlake.functions.buckets import bucket_of, iceberg_bucket
from eventlake.schemas import (
    EVENT_COLUMNS,
    FLOW_BUCKETS,
    FLOW_COLUMNS,
    LONG,
    QUARANTINE_COLUMNS,
    TEXT,
    TIME,
    columns,
)
from eventlake.session import make_folder

RUN, BATCH = "ingest_run", "ingest_batch"

#: The last batch of each run that an Iceberg table has landed.
LEDGER_COLUMNS = columns(
    **{RUN: TEXT, BATCH: LONG}, landed_rows=LONG, landed_at=TIME
)

#: Seconds that an append waits for its count once the rows have landed.
METRIC_WAIT = 10.0


def told(observation: Observation) -> bool:
    """Whether Spark has said what was observed; asking before that would wait, maybe for ever."""
    return observation._jo.future().isCompleted()


def observed(observation: Observation, seconds: float) -> dict | None:
    """What was observed, or None if Spark does not say within that time."""
    end = time.monotonic() + seconds
    while not told(observation):
        if time.monotonic() > end:
            return None
        time.sleep(0.002)
    return observation.get


#: Partitions whose rows the sketch of a batch counts.
SKETCHED = 64

SALT = "rebalance_salt"


def hot_pieces(counts: list[tuple[int, int]], rows: int, tasks: int) -> dict[int, int]:
    """Into how many pieces to cut each partition that has over twice the rows of a usual one.

    A piece is what each of so many tasks would get of all rows.
    """
    found = {}
    for key, n in counts:
        others = [m for other, m in counts if other != key]
        if n > 2 * (median(others) if others else 0):
            found[key] = math.ceil(n * tasks / max(rows, 1))
    return {key: pieces for key, pieces in found.items() if pieces > 1}


@dataclass(frozen=True)
class Bucket:
    """Partition by a hash bucket of a string column."""

    column: str
    count: int

    @property
    def derived(self) -> str:
        return f"{self.column}_bucket"


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and partitioning, independent of the table format."""

    name: str
    columns: StructType
    partitions: tuple[str | Bucket, ...] = ()

    @property
    def buckets(self) -> tuple[Bucket, ...]:
        return tuple(p for p in self.partitions if isinstance(p, Bucket))

    def declared(self) -> list[str]:
        return [f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns.fields]

    def iceberg_ddl(self) -> str:
        transforms = [
            f"bucket({p.count}, `{p.column}`)" if isinstance(p, Bucket) else f"`{p}`"
            for p in self.partitions
        ]
        layout = f" PARTITIONED BY ({', '.join(transforms)})" if transforms else ""
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(self.declared())}) "
            f"USING iceberg{layout}"
        )

    def parquet_partitions(self) -> list[str]:
        """Partition columns of the Parquet layout below the run and batch levels."""
        return [p.derived if isinstance(p, Bucket) else p for p in self.partitions]

    def parquet_ddl(self, location: str) -> str:
        derived = [f"`{b.derived}` int" for b in self.buckets]
        lineage = [f"`{RUN}` string", f"`{BATCH}` bigint"]
        layout = [f"`{name}`" for name in (RUN, BATCH, *self.parquet_partitions())]
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            f"({', '.join(self.declared() + derived + lineage)}) "
            f"USING parquet PARTITIONED BY ({', '.join(layout)}) LOCATION '{location}'"
        )

    def conform(self, rows: DataFrame) -> DataFrame:
        """`rows` in table order, matched by name; a missing or surplus column is an error."""
        names = set(self.columns.names)
        if names != set(rows.columns):
            missing, surplus = names - set(rows.columns), set(rows.columns) - names
            raise ValueError(
                f"{self.name}: missing columns {sorted(missing)}, surplus {sorted(surplus)}"
            )
        return rows.select(*self.columns.names)


def event_table(name: str) -> TableSpec:
    return TableSpec(name, EVENT_COLUMNS)


def flow_table(name: str) -> TableSpec:
    partitions = (Bucket("flow_aui", FLOW_BUCKETS), "year", "month", "day", "hour")
    return TableSpec(name, FLOW_COLUMNS, partitions)


def quarantine_table(name: str) -> TableSpec:
    return TableSpec(name, QUARANTINE_COLUMNS)


#: Keys that may be broadcast: some megabytes.
BROADCAST_KEYS = 100_000


def partition_mark(names: list[str]) -> Column:
    return F.xxhash64(*names)


def sketch(names: list[str]) -> Column:
    """The most frequent partitions of a batch with their rows, as JSON."""
    return F.to_json(F.call_function("approx_top_k", partition_mark(names), F.lit(SKETCHED))).alias(
        "sketch"
    )


def rebalanced(
    rows: DataFrame, partitions: list[str], cuts: list[str], hot: dict[int, int]
) -> DataFrame:
    """Rows of a partition together, those of hot ones in pieces by a hash of the row."""
    if not hot:
        return rows.hint("rebalance", *partitions)
    whole = [f.name for f in rows.schema if not isinstance(f.dataType, MapType)]
    pieces = F.lit(1)
    for mark, n in hot.items():
        pieces = F.when(partition_mark(cuts) == mark, n).otherwise(pieces)
    salted = rows.withColumn(SALT, F.pmod(F.xxhash64(F.lit(SALT), *whole), pieces.cast("long")))
    return salted.hint("rebalance", *partitions, SALT).drop(SALT)


def equals(name: str, value: object) -> Column:
    return F.col(name).isNull() if value is None else F.col(name) == F.lit(value)


@dataclass(frozen=True)
class IcebergTable:
    """An Iceberg table; needs the Iceberg runtime package and a configured catalog.

    Each snapshot carries the run and batch that it lands. As snapshots expire, a second table, the
    ledger, keeps the last batch that each run has landed: one row a run, in a partition of its own.
    """

    spec: TableSpec

    @property
    def ledger(self) -> TableSpec:
        return TableSpec(f"{self.spec.name}_ledger", LEDGER_COLUMNS, (RUN,))

    def create(self, spark: SparkSession) -> None:
        spark.sql(self.spec.iceberg_ddl())
        spark.sql(self.ledger.iceberg_ddl())

    def append(self, rows: DataFrame, run: str, batch: int) -> int:
        """Commit the batch unless the ledger or a snapshot knows it; gives its row count.

        The ledger is written behind the table, so a crash in between leaves the batch to the
        snapshot's tags. If the snapshots since the run's last entry have expired by then, nobody
        can tell, and that is an error rather than a guess.
        """
        spark = rows.sparkSession
        entry = spark.table(self.ledger.name).where(F.col(RUN) == run).first()
        if entry is not None and entry[BATCH] >= batch:
            return entry["landed_rows"] if entry[BATCH] == batch else 0
        landed = self._landed(spark, run, batch)
        if landed is None:
            if entry is not None and self._forgotten(spark, entry["landed_at"]):
                raise RuntimeError(
                    f"{self.spec.name}: batch {batch} of run {run} may have landed in a snapshot "
                    f"that has expired since batch {entry[BATCH]}; look for its rows"
                )
            writer = self.spec.conform(rows).writeTo(self.spec.name)
            for tag, value in self._tags(run, batch).items():
                writer = writer.option(f"snapshot-property.{tag}", value)
            writer.append()
            landed = self._landed(spark, run, batch) or 0
        entries = spark.createDataFrame([(run, batch, landed)], f"{RUN} string, {BATCH} long, n long")
        entries = entries.select(
            RUN, BATCH, F.col("n").alias("landed_rows"), F.current_timestamp().alias("landed_at")
        )
        # Replaces the partitions of the runs in it: this one's.
        entries.writeTo(self.ledger.name).overwritePartitions()
        return landed

    def _forgotten(self, spark: SparkSession, since: object) -> bool:
        """Whether snapshots that were taken after that time have expired."""
        snapshots = spark.table(f"{self.spec.name}.snapshots")
        first = snapshots.orderBy("committed_at").select("committed_at", "parent_id").first()
        return (
            first is not None and first["parent_id"] is not None and first["committed_at"] > since
        )

    @staticmethod
    def _tags(run: str, batch: int) -> dict[str, str]:
        return {"ingest-run": run, "ingest-batch": str(batch)}

    def _landed(self, spark: SparkSession, run: str, batch: int) -> int | None:
        """Rows that the snapshot of this batch added, from the table's metadata alone."""
        snapshots = spark.table(f"{self.spec.name}.snapshots")
        for tag, value in self._tags(run, batch).items():
            snapshots = snapshots.where(F.col("summary")[tag] == value)
        added = F.coalesce(F.col("summary")["added-records"].cast("bigint"), F.lit(0))
        found = snapshots.select(added.alias("added")).first()
        return None if found is None else found["added"]

    def read(self, spark: SparkSession, **keys: object) -> DataFrame:
        """The rows with the given column values; Iceberg turns them into partition filters."""
        rows = spark.table(self.spec.name)
        for name, value in keys.items():
            rows = rows.where(equals(name, value))
        return rows


@dataclass(frozen=True)
class ParquetTable:
    """A partitioned Parquet table in the session catalog.

    `rebalance` shuffles a batch before it is written, for few, full files. By default only a
    table with partitions of its own does so. Asking for it pays off where frequent small
    batches come from many topic partitions; denying it, where a batch fills all partitions.

    Spark cuts what a hot partition is written from where map tasks end. Where few map tasks hold much
    of it, that is not fine enough. So each batch is sketched while it is written, and partitions
    that were hot are cut by a hash of the row in the next one. `sketch_first` reads the first batch
    of this object once more to know its hot partitions too, which suits single, large appends.
    """

    spec: TableSpec
    location: str
    rebalance: bool | None = None
    sketch_first: bool = False
    #: What the last batch showed, once there was one: see `hot`.
    seen: dict[str, dict[int, int]] = field(default_factory=dict, compare=False, repr=False)

    @property
    def hot(self) -> dict[int, int]:
        """Into how many pieces each hot partition is cut, by the hash of its values."""
        return self.seen.get("hot", {})

    def create(self, spark: SparkSession) -> None:
        """Create the table if absent, picking up partitions that an earlier session landed."""
        if not spark.catalog.tableExists(self.spec.name):
            make_folder(spark, self.location)
            spark.sql(self.spec.parquet_ddl(self.location))
            spark.sql(f"MSCK REPAIR TABLE {self.spec.name}")

    def append(self, rows: DataFrame, run: str, batch: int) -> int:
        """Write the batch into its own partition, replacing what a failed attempt left there.

        Gives the row count, taken while writing. It is taken after the shuffle, in the stage
        whose tasks Spark counts once, so that a lost executor does not inflate it. Spark may drop
        the event that carries the count; the landed files are counted then.
        """
        rows = self.spec.conform(rows)
        dynamic = self.spec.parquet_partitions()
        for bucket in self.spec.buckets:
            rows = rows.withColumn(bucket.derived, iceberg_bucket(bucket.count, bucket.column))
        # The clock's partitions change with every hour, the buckets' do not.
        cuts = [bucket.derived for bucket in self.spec.buckets] or dynamic
        metrics = [F.count(F.lit(1)).alias("rows")]
        if self.rebalance or (self.rebalance is None and dynamic):
            # AQE merges small partitions, and splits one that outgrows the advisory size over
            # several tasks, so that one hot flow does not end up in a single writer.
            if cuts:
                if self.sketch_first and not self.seen:
                    self.learn(rows.agg(*metrics, sketch(cuts)).first().asDict(), rows.sparkSession)
                metrics.append(sketch(cuts))
            rows = rebalanced(rows, dynamic, cuts, self.hot)
        counted = Observation()
        rows = rows.observe(counted, *metrics)
        target = [f"{RUN} = '{run}'", f"{BATCH} = {batch}", *(f"`{name}`" for name in dynamic)]
        # Static mode clears the whole batch, even if this attempt fills fewer partitions.
        rows.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.spec.name} WITH ('partitionOverwriteMode' = 'static') "
            f"PARTITION ({', '.join(target)}) BY NAME SELECT * FROM {{rows}}",
            rows=rows,
        )
        rows_counted = observed(counted, METRIC_WAIT)
        if rows_counted is None:
            spark = rows.sparkSession
            spark.catalog.refreshTable(self.spec.name)
            landed = spark.table(self.spec.name).where(equals(RUN, run) & equals(BATCH, batch))
            return landed.count()
        self.learn(rows_counted, rows.sparkSession)
        return rows_counted["rows"]

    def learn(self, told: dict, spark: SparkSession) -> None:
        """Keep the hot partitions of a batch, from its row count and its sketch."""
        if not told["rows"] or "sketch" not in told:
            return
        counts = [(entry["item"], entry["count"]) for entry in json.loads(told["sketch"])]
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.seen["hot"] = hot_pieces(counts, told["rows"], tasks)

    def matching(self, spark: SparkSession, keys: DataFrame, column: str) -> DataFrame:
        """The rows whose bucketed `column` has a value that is in the same column of `keys`.

        The keys' buckets are partition values, so only those partitions are read. Up to
        `BROADCAST_KEYS` keys are broadcast, and Spark takes the buckets from the broadcast while
        the query runs. More are joined by a shuffle, with the buckets they have read beforehand. NULL
        matches nothing.
        """
        (bucket,) = [bucket for bucket in self.spec.buckets if bucket.column == column]
        number = iceberg_bucket(bucket.count, column).alias(bucket.derived)
        wanted = keys.select(column).distinct().select(column, number)
        # Spark prunes by a side that it takes to be selective, as one with a comparison.
        wanted = wanted.where(F.col(bucket.derived) >= 0)
        spark.catalog.refreshTable(self.spec.name)
        rows = spark.table(self.spec.name)
        if len(wanted.limit(BROADCAST_KEYS + 1).select(F.lit(1)).collect()) <= BROADCAST_KEYS:
            wanted = F.broadcast(wanted)
        else:
            # There are no more numbers than buckets.
            found = [row[0] for row in wanted.select(bucket.derived).distinct().collect()]
            rows = rows.where(F.col(bucket.derived).isin(found))
        found = rows.join(wanted, [bucket.derived, column], "left_semi")
        return found.select(*self.spec.columns.names)

    def read(self, spark: SparkSession, **keys: object) -> DataFrame:
        """The rows with the given column values; a bucketed column also prunes by its bucket."""
        spark.catalog.refreshTable(self.spec.name)
        rows = spark.table(self.spec.name)
        for name, value in keys.items():
            rows = rows.where(equals(name, value))
        for bucket in self.spec.buckets:
            if bucket.column in keys:
                number = bucket_of(bucket.count, keys[bucket.column])
                rows = rows.where(equals(bucket.derived, number))
        return rows.select(*self.spec.columns.names)


LakeTable = IcebergTable | ParquetTable


def open_table(
    spark: SparkSession,
    spec: TableSpec,
    location: str | None = None,
    rebalance: bool | None = None,
) -> LakeTable:
    """The Iceberg table where the catalog of `spec.name` is Iceberg, else a Parquet one."""
    catalog = spec.name.split(".")[0] if spec.name.count(".") > 1 else "spark_catalog"
    implementation = spark.conf.get(f"spark.sql.catalog.{catalog}", "")
    if implementation.startswith("org.apache.iceberg."):
        return IcebergTable(spec)
    if location is None:
        raise ValueError(f"{catalog} is not an Iceberg catalog: a Parquet table needs a location")
    return ParquetTable(spec, location, rebalance)
