"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in shuffled order. A document's virtual finish time is the words of
its source up to and including it, divided by the source's target, so that every source has reached
its target at time 1. As documents are taken whole, half of each document's words count as finished
before its time: a source then misses its target by about half a document, not a whole one. A source
that is to be taken more than once queues again behind itself. All documents are sorted by their
time, and the mix is what comes before the total budget is used up.

Running sums are taken in two steps, over the sums of chunks and then within a chunk. A chunk is a
range of the shuffle key in a source, or a partition of the sorted queue, so a source that holds most
documents is dealt to many tasks. The key is a hash of the row, so that reruns agree; rows that are
equal very often are cut by their numbers instead. Only tables with a row per source, chunk or
partition are summed in one task. The queue holds numbers, not texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventlake.llm.sharding import uniform
from eventlake.llm.tables import committed

#: Fixed value: a word is a run of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (1, 2, 3)  # of the sources in code point order, repeating
    share: float = 1.0  # of all words: the budget
    repeats: int = 3  # of a document, at most
    chunk_rows: int = 2_000  # of a source, about
    hot_share: int = 1_000  # rows that are equal more often than one in so many are hot
    seed: int = 23


def word_count(text: str) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, settings: Settings) -> DataFrame:
    """Per source (one row each): its rank, words, rows and target.

    Targets share the budget by weight, but none exceeds `repeats` times its source's words; what
    is over goes to the others by weight, until none is above. The sources that fill up come first
    in the order of words per weight, so the level that the rest reach follows from running sums.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    weights = F.array(*map(F.lit, settings.weights))
    ranked = (
        sized.groupBy("_source")
        .agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_rank", F.row_number().over(by_name).cast("int"))
        .withColumn(
            "_weight", F.element_at(weights, (F.col("_rank") - 1) % len(settings.weights) + 1)
        )
        .withColumn("_most", F.col("_words") * settings.repeats)
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("_words") / F.col("_weight"), "_rank")
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("_words").over(everything) * settings.share
        - F.coalesce(F.sum("_most").over(earlier), F.lit(0))
    ) / F.sum("_weight").over(onward)
    reached = F.min_by(
        F.when(F.col("_most") > F.col("_level") * F.col("_weight"), F.col("_level")),
        F.when(F.col("_most") > F.col("_level") * F.col("_weight"), F.col("_place")),
    ).over(everything)
    return (
        ranked.withColumn("_level", level)
        .withColumn("_place", F.row_number().over(filling))
        .withColumn("_reached", reached)
        .withColumn(
            "_target",
            F.least(
                F.col("_most").cast("double"),
                F.coalesce(F.col("_reached") * F.col("_weight"), F.col("_most").cast("double")),
            ),
        )
        .withColumn("_chunks", F.ceil(F.col("_rows") / settings.chunk_rows).cast("long"))
        .select("_source", "_rank", "_words", "_target", "_chunks")
    )


def running_total(
    rows: DataFrame, group: str, chunk: list[str], order: list[str], value: str
) -> DataFrame:
    """Add `_total`, the sum of `value` in the group up to each row; chunks are in group order."""
    earlier = Window.partitionBy(group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    before = committed(
        rows.groupBy(group, *chunk)
        .agg(F.sum(value).alias("_chunk_total"))
        .withColumn("_before", F.coalesce(F.sum("_chunk_total").over(earlier), F.lit(0)))
        .drop("_chunk_total")
    )
    within = (
        Window.partitionBy(group, *chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_within", F.sum(value).over(within))
        .join(before, [group, *chunk])
        .withColumn("_total", F.col("_before") + F.col("_within"))
        .drop("_before", "_within")
    )


def holds_map(kind: T.DataType) -> bool:
    """Whether values of the type cannot be hashed."""
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def hashable_parts(column: Column, kind: T.DataType) -> list[Column]:
    if isinstance(kind, T.StructType):
        return [
            part
            for field in kind.fields
            for part in hashable_parts(column.getField(field.name), field.dataType)
        ]
    return [] if holds_map(kind) else [column]


def sliced(placed: DataFrame, rows: int, settings: Settings) -> DataFrame:
    """Cut chunks further where rows are hot: `_after`, how many hot keys a row comes behind (twice,
    and one if it has one itself), and `_slice`, a range of numbers among rows of a hot key.

    There are fewer than `hot_share` hot keys, so each source's fit into one row.
    """
    often = max(settings.chunk_rows, rows // settings.hot_share)
    place = F.struct("_order", "_key")
    hot = committed(
        placed.groupBy("_rank", "_order", "_key")
        .count()
        .where(F.col("count") > often)
        .groupBy("_rank")
        .agg(F.collect_list(place).alias("_hot"))
    )
    before = F.size(F.filter("_hot", lambda key: key < place))
    own = F.array_contains("_hot", place)
    return (
        placed.join(F.broadcast(hot), "_rank", "left")
        .withColumn("_after", F.coalesce(2 * before + own.cast("int"), F.lit(0)))
        .withColumn(
            "_slice",
            F.when(own, F.floor(F.col("_n") / settings.chunk_rows).cast("long")).otherwise(0),
        )
        .drop("_hot")
    )


def cut_of(queue: DataFrame, budget: float) -> tuple[float, int] | None:
    """Finish time and key of the first entry that exceeds the budget; None if all fit."""
    ordered = committed(
        queue.orderBy("_finish", "_key").withColumn(
            "_part", F.shiftrightunsigned(F.monotonically_increasing_id(), 33)
        )
    )
    so_far = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = (
        ordered.groupBy("_part")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn("_through", F.sum("_sum").over(so_far))
        .where(F.col("_through") > budget)
        .orderBy("_part")
        .first()
    )
    if over is None:
        return None
    left = budget - (over["_through"] - over["_sum"])
    # One partition of the sorted queue holds the cut.
    running = Window.orderBy("_finish", "_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cut = (
        ordered.where(F.col("_part") == over["_part"])
        .withColumn("_running", F.sum("_size").over(running))
        .where(F.col("_running") > left)
        .orderBy("_finish", "_key")
        .first()
    )
    return cut["_finish"], cut["_key"]


def mix(
    documents: DataFrame,
    settings: Settings = Settings(),
    size: str = "size",
    source: str = "source",
) -> DataFrame:
    """Add source_size, target, copies and taken, replacing such columns.

    `size` names the column with each document's words, see `word_count`. `copies` is how often the
    mix takes a document, `taken` its words times that. Rows stay as they are, and their columns may
    have any other name and type. NULL is a source of its own, after all others. A document of size 0
    or NULL is not taken. Equal rows, those that differ in maps alone among them, queue one after the
    other in no particular order, which changes nothing that can be seen. Reruns over the same rows
    agree. An empty table gives an empty one.
    """
    new = ("source_size", "target", "copies", "taken")
    kept = [name for name in documents.columns if name.lower() not in new]
    hashable = [
        leaf
        for field in documents.schema
        if field.name in kept
        for leaf in hashable_parts(F.col(field.name), field.dataType)
    ]
    numbered = committed(
        documents.select(
            F.struct(*kept).alias("_row"),
            F.col(source).alias("_source"),
            F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size"),
            F.xxhash64(F.lit(settings.seed), *hashable).alias("_key"),
            F.monotonically_increasing_id().alias("_n"),
        )
    )
    sized = numbered.drop("_row")
    sources = committed(source_targets(sized.select("_source", "_size"), settings))
    budget = sources.agg(F.sum("_words")).first()[0] or 0
    known = sources.withColumnRenamed("_source", "_named")
    placed = (
        sized.join(known, F.col("_source").eqNullSafe(F.col("_named")))
        .drop("_named", "_source")
        .withColumn("_order", uniform(F.lit(settings.seed), F.col("_key")))
        .withColumn("_chunk", F.floor(F.col("_order") * F.col("_chunks")).cast("long"))
    )
    placed = sliced(placed, numbered.count(), settings)
    chunk = ["_chunk", "_after", "_slice"]
    queued = committed(
        running_total(placed, "_rank", chunk, ["_order", "_key", "_n"], "_size").select(
            "_n", "_key", "_size", "_words", "_target", "_total"
        )
    )
    rounds = F.sequence(F.lit(0), F.lit(settings.repeats - 1))
    finishes = F.transform(
        rounds,
        lambda i: (i * F.col("_words") + F.col("_total") - F.col("_size") / 2) / F.col("_target"),
    )
    real = (F.col("_size") > 0) & (F.col("_target") > 0)
    entries = queued.where(real).select(
        F.explode(finishes).alias("_finish"), "_key", "_size"
    )
    cut = cut_of(entries, budget * settings.share)
    if cut is None:
        copies = F.lit(settings.repeats)
    else:
        time, key = F.lit(cut[0]), F.lit(cut[1])
        copies = F.size(
            F.filter(
                finishes, lambda t: (t < time) | ((t == time) & (F.col("_key") < key))
            )
        )
    told = queued.select(
        "_n",
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        F.when(real, copies).otherwise(0).alias("copies"),
        F.when(real, F.col("_size") * copies).otherwise(0).alias("taken"),
    )
    return numbered.select("_n", "_row").join(told, "_n").select("_row.*", *new)


def mix_report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """What the mix takes of every document."""
    sized = committed(documents.select("doc_id", "source", word_count("text").alias("size")))
    return mix(sized, settings).select("doc_id", "size", "source_size", "target", "taken")
