"""What the operators share on the driver's side: tables, folds, committed steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import remove_folder, scratch_folder

#: Documents whose id hashes to this remainder are kept out of all training.
FOLDS, HELD_OUT = 5, 0


def read_table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables.rstrip('/')}/{name}.parquet")


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def held_out(doc_id: str) -> Column:
    """Whether the row is kept out of training by its id. A NULL id is not in the held-out fold."""
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def trained_on(doc_id: str) -> Column:
    """Whether a row may be learned from. A row with a NULL id has no fold and is not."""
    return F.coalesce(fold(doc_id) != HELD_OUT, F.lit(False))


#: Folders that operators of this process have written, oldest first.
FOLDERS: list[str] = []


def new_folder(spark: SparkSession) -> str:
    FOLDERS.append(scratch_folder(spark))
    return FOLDERS[-1]


def remove_folders(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Delete these of `FOLDERS`; results that still read them are lost."""
    for path in FOLDERS[first:last]:
        remove_folder(spark, path)
    del FOLDERS[first:last]


def committed(rows: DataFrame) -> DataFrame:
    """`rows`, written below the shared scratch folder and read back.

    Later steps then read one fixed copy: a lost executor neither repeats the work before it nor
    changes what a second reader sees.
    """
    path = new_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
