"""A uniform shuffle into shards of exact sizes, with DataFrame operations only.

Every partition permutes its rows. How many rows each partition sends to each shard is drawn from the
law that a uniform permutation of all rows gives these counts: the matrix of counts is
hypergeometric, with the partitions' sizes as row sums and the shards' sizes as column sums. A
partition then deals its permuted rows out by its row of the matrix, the rows are exchanged, and each
shard is permuted again: by a random key, whose leading part deals a shard to many tasks.

The matrix is drawn by halving: the shards' counts of a range of partitions are split between both
halves of the range, shard by shard, each split one hypergeometric draw. Levels are DataFrame steps,
so ranges of one level are drawn side by side: every few levels they are dealt to as many tasks as
there are ranges, up to `DRAWERS`. Draws are fixed by the seed, so a lost one comes out the same. A
draw inverts its distribution function over the counts within twelve standard deviations (and twenty)
of the mode, beyond which no probability is left in double precision, with a uniform number hashed
from seed, range and shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlake.llm.tables import committed

#: Rows of a block that is permuted after the exchange, about. Many small blocks even out the tasks.
BLOCK_ROWS = 1_000


#: Levels of the matrix that are drawn before its ranges are dealt to tasks anew, and such tasks.
DEAL_LEVELS, DRAWERS = 4, 512

#: Bytes of a matrix that may be broadcast.
BROADCAST_BYTES = 64 << 20


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def uniform(*parts: Column) -> Column:
    """A number from 0 to 1, both excluded, fixed by what it is hashed from."""
    mixed = F.xxhash64(F.xxhash64(*parts), F.lit(0x5EED))
    return (F.shiftrightunsigned(mixed, 11).cast("double") + 0.5) * F.lit(2.0**-53)


def hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """How many of `drawn` items out of `total` are among the `marked` ones, by inversion."""

    def up(a: Column, x: Column) -> Column:
        """Weight of x + 1 by that of x."""
        return (a["k"] - x) * (a["d"] - x) / ((x + 1) * (a["rest"] - a["d"] + x + 1))

    def down(a: Column, x: Column) -> Column:
        """Weight of x - 1 by that of x."""
        return x * (a["rest"] - a["d"] + x) / ((a["k"] - x + 1) * (a["d"] - x + 1))

    def steps(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(
            F.array().cast("array<int>")
        )

    def summed(a: Column, count: Column, ratio, sign: int) -> Column:
        """Weights of the counts on one side of the mode, as a multiple of the mode's."""
        return F.aggregate(
            steps(count),
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
            lambda s, i: let(
                s["w"] * ratio(a, a["mode"] + sign * (i - 1)),
                lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")),
            ),
            lambda s: s["sum"],
        )

    def pick(a: Column, count: Column, ratio, sign: int, goal: Column) -> Column:
        """The count at which the weights, summed from the mode, reach `goal`."""
        return F.aggregate(
            steps(count),
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("at")),
            lambda s, i: let(
                s["w"] * ratio(a, a["mode"] + sign * (i - 1)),
                lambda w: F.struct(
                    w.alias("w"),
                    (s["sum"] + w).alias("sum"),
                    F.when(s["sum"] < goal, i.cast("double")).otherwise(s["at"]).alias("at"),
                ),
            ),
            lambda s: a["mode"] + sign * s["at"],
        )

    def bounds(a: Column) -> Column:
        n, k, d = a["n"], a["k"], a["d"]
        low, high = F.greatest(F.lit(0.0), d - (n - k)), F.least(d, k)
        mode = F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")
        spread = F.sqrt(d * k * (n - k) * (n - d) / F.greatest(n * n * (n - 1), F.lit(1.0)))
        return F.struct(
            k.alias("k"),
            d.alias("d"),
            (n - k).alias("rest"),
            low.alias("low"),
            high.alias("high"),
            F.least(high, F.greatest(low, mode)).alias("mode"),
            (F.ceil(spread * 12).cast("double") + 20).alias("reach"),
        )

    def draw(a: Column) -> Column:
        over = F.least(a["high"] - a["mode"], a["reach"])
        under = F.least(a["mode"] - a["low"], a["reach"])

        def chosen(weights: Column) -> Column:
            above, goal = weights["above"], chance * (1 + weights["above"] + weights["below"])
            return (
                F.when(goal <= 1, a["mode"])
                .when(goal <= 1 + above, pick(a, over, up, 1, goal - 1))
                .otherwise(pick(a, under, down, -1, goal - 1 - above))
            )

        sums = F.struct(
            summed(a, over, up, 1).alias("above"), summed(a, under, down, -1).alias("below")
        )
        return let(sums, chosen)

    given = F.struct(
        total.cast("double").alias("n"),
        marked.cast("double").alias("k"),
        drawn.cast("double").alias("d"),
    )
    return let(given, lambda a: let(bounds(a), draw)).cast("long")


def split_counts(columns: Column, drawn: Column, *seeds: Column) -> Column:
    """The counts of `drawn` rows in each column: a multivariate hypergeometric draw."""
    start = F.struct(
        F.aggregate(columns, F.lit(0).cast("long"), lambda s, x: s + x).alias("total"),
        drawn.cast("long").alias("drawn"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def step(state: Column, marked: Column) -> Column:
        chance = uniform(*seeds, F.size(state["out"]))
        return let(
            hypergeometric(state["total"], marked, state["drawn"], chance),
            lambda taken: F.struct(
                (state["total"] - marked).alias("total"),
                (state["drawn"] - taken).alias("drawn"),
                F.concat(state["out"], F.array(taken)).alias("out"),
            ),
        )

    return F.aggregate(columns, start, step, lambda state: state["out"])


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """From rows (part, n): part, and `counts`, how many rows it sends to each shard.

    The only thing in one place is an array of the parts' sizes, a few bytes for each partition, and
    the draws of the first levels. Ranges have equal numbers of parts, so tasks have equal work.
    """
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["n"])
    # Ranges are numbered from 0 on each level, in order.
    nodes = sizes.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts")).select(
        F.lit(0).cast("long").alias("node"),
        "parts",
        F.transform(
            F.sequence(F.lit(0), F.lit(shards - 1)),
            lambda i: (
                F.floor(total / shards) + F.when(i < F.pmod(total, F.lit(shards)), 1).otherwise(0)
            ).cast("long"),
        ).alias("counts"),
    )
    for level in range(max(0, sizes.count() - 1).bit_length()):
        if level and level % DEAL_LEVELS == 0:
            tasks = min(1 << level, DRAWERS)
            nodes = nodes.repartitionById(tasks, F.pmod("node", F.lit(tasks)).cast("int"))
        half = F.floor(F.size("parts") / 2).cast("int")
        left = F.slice("parts", 1, half)
        taken = split_counts(
            F.col("counts"),
            F.aggregate(left, F.lit(0).cast("long"), lambda s, p: s + p["n"]),
            F.lit(seed),
            F.element_at("parts", 1)["part"],
            F.element_at("parts", -1)["part"],
        )
        halves = F.array(
            F.struct(
                (F.col("node") * 2).alias("node"), left.alias("parts"), F.col("taken").alias("counts")
            ),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                F.slice("parts", half + 1, F.size("parts")).alias("parts"),
                F.zip_with("counts", "taken", lambda all_, some: all_ - some).alias("counts"),
            ),
        )
        single = F.size("parts") < 2
        nodes = (
            nodes.withColumn("taken", F.when(~single, taken))
            .select(
                F.explode(
                    F.when(
                        single,
                        F.array(F.struct((F.col("node") * 2).alias("node"), "parts", "counts")),
                    ).otherwise(halves)
                ).alias("half")
            )
            .select("half.*")
        )
    return nodes.where(F.size("parts") > 0).select(
        F.element_at("parts", 1)["part"].alias("part"), "counts"
    )


def shuffle_into_shards(
    rows: DataFrame, shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add `shard int` (from 0) and `slot long` (from 0, gapless in its shard), replacing such.

    Shard sizes differ by one row at most and every assignment of rows to slots is equally likely.
    Rows are placed one by one: neither NULLs nor equal rows are treated apart. An empty table stays
    empty; with fewer rows than shards the last shards are empty.
    """
    kept = [name for name in rows.columns if name.lower() not in ("shard", "slot")]
    # Permute locally. The written copy fixes each row's partition and place in it.
    local = committed(
        rows.select(F.struct(*kept).alias("_row"))
        .sortWithinPartitions(F.rand(seed))
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_place", 33).cast("int")
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = committed(local.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")))
    ends = F.aggregate(
        "counts",
        F.array().cast("array<bigint>"),
        lambda s, n: F.concat(s, F.array(n + F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)))),
    )
    matrix = committed(
        communication_matrix(sizes, shards, seed).select(
            F.col("part").alias("_part"), ends.alias("_ends")
        )
    )
    if sizes.count() * shards * 8 <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    # Deal out: the places of a part up to the first end are the first shard's, and so on.
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (shards * block_rows)))
    key = uniform(F.lit(seed), F.col("_place"))
    dealt = local.join(matrix, part == F.col("_part")).select(
        "_row",
        F.size(F.filter("_ends", lambda end: end <= place)).alias("shard"),
        F.floor(key * blocks).cast("int").alias("_block"),
        key.alias("_key"),
        "_place",
    )
    earlier = (
        Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = committed(
        dealt.groupBy("shard", "_block")
        .count()
        .withColumn("_first", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    # Exchange, and permute again.
    order = Window.partitionBy("shard", "_block").orderBy("_key", "_place")
    return (
        dealt.withColumn("_rank", F.row_number().over(order) - 1)
        .join(first, ["shard", "_block"])
        .select("_row.*", "shard", (F.col("_first") + F.col("_rank")).cast("long").alias("slot"))
    )


def shard_report(documents: DataFrame, shards: int = 40) -> DataFrame:
    """Shard and slot of every document, by the law of equal row counts. NULL has no bytes."""
    spread = shuffle_into_shards(documents.select("doc_id", "text"), shards)
    return spread.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
