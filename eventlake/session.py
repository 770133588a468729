"""Session start-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

from eventlake.schemas import FLOW_BUCKETS

# UTC makes landed date parts independent of the machine. AQE splits hot write partitions. Parquet
# timestamps in microseconds carry the statistics that Spark's default type lacks, so filters on
# time skip row groups. A task of a partitioned write keeps a file open per bucket of the hour, and
# sorts only what goes beyond that.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.maxConcurrentOutputFileWriters": str(FLOW_BUCKETS + 1),
    "spark.ui.enabled": "false",
}


def build_session(app: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach, below `spark.checkpoint.dir`.

    Only a local-mode session may go without that setting, since there the driver's own
    temporary folder is reachable by all of its tasks.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="eventlake-")
    return f"{shared.rstrip('/')}/eventlake-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Create `path`, if absent, on whichever file system it names."""
    folder, file_system = _hadoop_path(spark, path)
    file_system.mkdirs(folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, file_system = _hadoop_path(spark, path)
    return file_system.exists(folder)


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and size of the files in a folder; none if it does not exist."""
    folder, file_system = _hadoop_path(spark, path)
    if not file_system.exists(folder):
        return {}
    found = [status for status in file_system.listStatus(folder) if status.isFile()]
    return {status.getPath().getName(): status.getLen() for status in found}


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file. Stores that copy for it show the copy when it is whole."""
    path, file_system = _hadoop_path(spark, source)
    if not file_system.rename(path, _hadoop_path(spark, target)[0]):
        raise OSError(f"{source} could not be renamed to {target}")


#: Ends a note, so that one that was cut short is told from a whole one.
NOTE_END = "end"


def write_note(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Write a small text file, in place of one that is there."""
    file, file_system = _hadoop_path(spark, path)
    out = file_system.create(file, True)
    try:
        out.write("".join(f"{line}\n" for line in [*lines, NOTE_END]).encode())
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> list[str] | None:
    """The lines of a note; None if it is not there, or not whole."""
    file, file_system = _hadoop_path(spark, path)
    if not file_system.exists(file):
        return None
    source = file_system.open(file)
    try:
        lines = bytes(source.readAllBytes()).decode().splitlines()
    finally:
        source.close()
    return lines[:-1] if lines[-1:] == [NOTE_END] else None


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it exists."""
    folder, file_system = _hadoop_path(spark, path)
    file_system.delete(folder, True)


def full_path(spark: SparkSession, path: str) -> str:
    """`path` with its file system and without a trailing slash."""
    folder, file_system = _hadoop_path(spark, path)
    return file_system.makeQualified(folder).toString()
