"""Exact duplicates, whatever their white space, with DataFrame operations only.

Rows are written once with a number and the digest of their normalised text. Then, by digest and by
the full normalised text at every stage:

1. each task groups the rows it reads, before anything moves;
2. these groups meet by digest, salt and text. The salt is the task that wrote the row, for digests
   that hold more than a thousandth of all rows, so a hot group meets in many tasks, to each of which
   every writer sends one row at most;
3. the salts' winners meet by digest and text.

Every row then gets the outcome of its digest. That takes no texts, as a digest nearly always stands
for one text; where it stands for several, the rows of that digest are matched by their text instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import committed

#: Characters that texts are compared without: `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"

#: A digest is hot if more than one in so many rows has it; so there are fewer hot ones than this.
HOT_SHARE = 1_000

#: Rows that a digest may always have without being hot.
FEW = 1_000

#: Parts of a hot group that meet side by side.
SALTS = 64


def normalised(text: Column) -> Column:
    """The text without blanks; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of these keys and one text: how many, and the one that stays."""
    # The longest text first, then the smallest id (complements grow as ids shrink, NULL comes
    # last), then the smallest number.
    best = F.struct("_length", F.bitwise_not("_id").alias("_late"), (-F.col("_n")).alias("_back"))
    return rows.groupBy(*keys, "_content").agg(
        F.count(F.lit(1)).alias("_size"), F.max(best).alias("_best")
    )


def merged(groups: DataFrame, *keys: str) -> DataFrame:
    return groups.groupBy(*keys).agg(
        F.sum("_size").alias("_size"),
        F.max("_best").alias("_best"),
        F.count(F.lit(1)).alias("_merged"),
    )


def classes_of(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """`_digest`, `_content`, `_size` and `_best` of every distinct text."""
    with_text = rows.select(
        "_digest", "_length", "_id", "_n", normalised(F.col("_text")).alias("_content")
    )
    task = F.shiftrightunsigned("_n", 33)
    cold = with_text.join(F.broadcast(hot), "_digest", "left_anti")
    salted = with_text.join(F.broadcast(hot), "_digest", "left_semi").withColumn(
        "_salt", F.pmod(task, F.lit(SALTS))
    )
    winners = merged(grouped(salted, "_digest", "_salt"), "_digest", "_content").drop("_merged")
    return grouped(cold, "_digest").unionByName(winners)


def with_outcome(
    rows: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """`_row` (the whole row), `_digest`, `_keep_id`, `_size` and `_kept` of every row.

    Texts are equal if they are identical without blanks; NULL and empty texts, and those of blanks
    alone, are all equal. Of a group of equal texts the row with the most code points in its own text
    stays, then the one with the smallest id, an id of NULL after all others; of repeated rows any
    one. `_keep_id` is that row's id and `_size` the number of rows in the group. Ids need not be
    distinct. An empty table gives an empty one; columns of `rows` may have any name, as they travel
    inside `_row`. `digest` only decides which rows are compared.
    """
    numbered = committed(
        rows.select(
            F.struct(F.col("*")).alias("_row"),
            F.col(text).alias("_text"),
            F.col(doc_id).cast("long").alias("_id"),
        ).select(
            F.monotonically_increasing_id().alias("_n"),
            "_row",
            "_id",
            F.coalesce(F.length("_text"), F.lit(0)).alias("_length"),
            digest(normalised(F.col("_text"))).alias("_digest"),
        )
    ).withColumn("_text", F.col("_row").getField(text))
    often = max(FEW, numbered.count() // HOT_SHARE)
    hot = committed(
        numbered.groupBy("_digest").count().where(F.col("count") > often).select("_digest")
    )
    # One row a digest. Outcomes hold where a single text was merged.
    outcomes = committed(
        merged(classes_of(numbered, hot), "_digest").select(
            "_digest", "_size", "_best", "_merged"
        )
    )
    narrow = numbered.select("_n", "_row", "_digest")
    single = outcomes.where("_merged = 1").drop("_merged")
    of_hot = single.join(F.broadcast(hot), "_digest", "left_semi")
    told = (
        narrow.join(F.broadcast(hot), "_digest", "left_anti")
        .join(single, "_digest")
        .unionByName(narrow.join(F.broadcast(of_hot), "_digest"))
    )
    several = outcomes.where("_merged > 1").select("_digest")
    if not several.isEmpty():
        alike = committed(numbered.join(several, "_digest", "left_semi"))
        classes = committed(classes_of(alike, hot))
        by_text = alike.withColumn("_content", normalised(F.col("_text"))).join(
            classes, ["_digest", "_content"]
        )
        told = told.unionByName(by_text.select(told.columns))
    return told.select(
        "_row",
        "_digest",
        F.bitwise_not("_best._late").alias("_keep_id"),
        "_size",
        (F.col("_n") == -F.col("_best._back")).alias("_kept"),
    )


def without_copies(rows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, as they are; see `with_outcome`."""
    return with_outcome(rows, doc_id, text).where("_kept").select("_row.*")


def duplicate_report(documents: DataFrame) -> DataFrame:
    """What becomes of every document, dropped or kept."""
    told = with_outcome(documents.select("doc_id", "text"))
    return told.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )
