"""A training corpus out of raw documents: stages that each call one operator of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import bpe, jaccard, langid, mixing, secrets
from eventlake.llm.queries import vocabulary_file
from eventlake.llm.tables import FOLDERS, committed, read_table, remove_folders


def whole(docs: DataFrame, *needed: Column | str) -> DataFrame:
    """The rows as one column, which results of any name cannot clash with, and what is needed."""
    return docs.select(F.struct(*docs.columns).alias("_row"), *needed)


def known_languages(spark: SparkSession, docs: DataFrame, tables: str) -> DataFrame:
    """Documents whose language the identifier accepts; it learns from the labels at hand."""
    found = langid.identify(whole(docs, "text"), langid.train(docs))
    return found.where("accepted").select("_row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, tables: str) -> DataFrame:
    """Of each group of near duplicates (five words, 80 %) the document with the smallest id.

    Rows are compared one by one, whatever their ids: rows of one id with different texts are in
    different groups, and rows without an id are in groups like others, where they come last. A row
    goes only if it is linked to one that stays. Texts without words are no duplicates.
    """
    numbered = committed(whole(docs, F.monotonically_increasing_id().alias("_n")))
    ids = numbered.select("_n", F.col("_row.doc_id").alias("_id"))
    groups = jaccard.similar_groups(numbered.select("_n", "_row.text"), doc_id="_n")
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_n")).getField("_n")
    kept = (
        groups.withColumnRenamed("doc_id", "_n")
        .join(ids, "_n")
        .groupBy("component_id")
        .agg(first.alias("_n"))
    )
    return numbered.join(kept.select("_n"), "_n", "left_semi").select("_row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, tables: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced. NULL texts stay NULL."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed_sources(spark: SparkSession, docs: DataFrame, tables: str) -> DataFrame:
    """What the mix takes, as often as it takes it. Documents without words are not taken."""
    mixed = mixing.mix(whole(docs, "source", mixing.word_count("text").alias("size")))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.where("copies > 0").select("_row", copies.alias("_copy")).select("_row.*")


def token_ids(spark: SparkSession, docs: DataFrame, tables: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; NULL counts as empty."""
    found = bpe.round_trip(docs, bpe.load(vocabulary_file("byte_bpe_50k.json")))
    return found.select(
        "doc_id",
        "lang",
        "source",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("exact"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", known_languages),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mix", mixed_sources),
    ("tokens", token_ids),
]

#: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, tables: str) -> DataFrame:
    """Apply the stages to the documents; each result is written and read again by the next.

    What a stage has read and written on its way goes once its result is written. Every stage gives no
    rows for none, and takes other columns of any name and type along, but for those it names itself.
    """
    docs, first = read_table(spark, tables, "documents"), len(FOLDERS)
    for _, stage in STAGES:
        docs = committed(stage(spark, docs, tables))
        remove_folders(spark, first, -1)
    return docs
