"""Exact work on blocks of vectors, shared by the searches: shards, routing, and the best k.

Rows are told apart by a number, as ids may repeat. Candidates are dealt to shards by median splits,
learned from a bounded sample, of the space in which the measure is an inner product, so a shard's
bounding box is tight where vectors cluster; a shard that still holds too many, as of equal vectors, is
cut by a hash of the number. A task reads a shard's candidates, builds an index over them, and then
streams the queries sent to that shard past it, so it holds one shard and one block of queries however
many there are. Each query first searches the shard it lives in; the score of its k-th best there goes
with it to the other shards whose box reaches that score, which return only what is not worse.
Queries travel in blocks: a row a block and shard, not a row a query and shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlake.llm.tables import committed

#: Queries that an index gets at once, at most.
QUERY_BLOCK = 256

#: Shards that rows are dealt to for the sake of many tasks, and shards that there may be at most:
#: beyond `LARGE_ROWS` a shard grows rather.
SPREAD, MOST_SHARDS, LARGE_ROWS = 256, 16_384, 65_536

#: Vectors that the splits are learned from, and their bytes, at most.
SAMPLE_ROWS, SAMPLE_BYTES, SEED = 20_000, 64 << 20, 31


class Index(Protocol):
    """Made of the candidates' ids, numbers and vectors."""

    def search(
        self, numbers: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
    ) -> Iterator[tuple[int, list[tuple[int, float]]]]:
        """Per query its place and its best (id, score); none scores below its `least`.

        The candidate of a query's own number is left out.
        """


MakeIndex = Callable[[np.ndarray, np.ndarray, np.ndarray], Index]

#: Vectors to where the measure is an inner product, rows of doubles or of objects.
Space = Callable[[np.ndarray], np.ndarray]


def taking_part(table: DataFrame, vec_id: str, vector: str, zero: bool) -> DataFrame:
    """vec_id and vector (doubles) of the rows that can be searched.

    Rows with a NULL id, a NULL or empty vector, or a NULL or non-finite component take no part,
    nor do zero vectors unless `zero`. Rows that repeat an id, or are wholly equal, all do.
    """
    real = F.col("vector").isNotNull() & (F.size("vector") > 0)
    real &= F.forall(
        "vector", lambda x: F.coalesce(F.abs(x) <= F.lit(1.7976931348623157e308), F.lit(False))
    ) & ~F.exists("vector", lambda x: F.isnan(x))
    if not zero:
        real &= F.exists("vector", lambda x: x != 0)
    return table.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & real)


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of one width as a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


# --- shards -------------------------------------------------------------------------------------


@dataclass
class Splits:
    """A tree of median splits; a node is a component and a threshold, or a leaf's number."""

    nodes: list[tuple[int, float, int, int] | int]

    @staticmethod
    def learn(sample: np.ndarray, leaves: int) -> Splits:
        nodes: list = []
        numbered = 0

        def grow(rows: np.ndarray, wanted: int) -> int:
            nonlocal numbered
            place = len(nodes)
            nodes.append(None)
            spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(1)
            if wanted < 2 or not spread.max() > 0:
                nodes[place] = numbered
                numbered += 1
                return place
            component = int(np.argmax(spread))
            values = np.sort(rows[:, component])
            threshold = float(values[len(rows) * (wanted // 2) // wanted])
            # A value that many share goes to one side as a whole, and to the larger one.
            left = rows[:, component] < threshold
            if not left.any():
                threshold = float(values[values > threshold][0])
                left = rows[:, component] < threshold
            nodes[place] = (
                component,
                threshold,
                grow(rows[left], wanted // 2),
                grow(rows[~left], wanted - wanted // 2),
            )
            return place

        grow(sample, leaves)
        return Splits(nodes)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), np.int32)
        work = [(0, np.arange(len(rows)))]
        while work:
            place, some = work.pop()
            node = self.nodes[place]
            if isinstance(node, int):
                found[some] = node
                continue
            component, threshold, low, high = node
            left = rows[some, component] < threshold
            work += [(low, some[left]), (high, some[~left])]
        return found


def rows_of_a_shard(rows: int, least: int) -> int:
    """`least` rows while that gives few shards, then more, up to `LARGE_ROWS` and beyond."""
    return max(least, min(LARGE_ROWS, -(-rows // SPREAD)), -(-rows // MOST_SHARDS))


def large_widths(rows: DataFrame, shard_rows: int) -> dict[int, int]:
    """Rows of every width that has more of them than a shard; there are no more than shards."""
    large = rows.groupBy("_width").count().where(F.col("count") > shard_rows)
    return {row["_width"]: row["count"] for row in large.collect()}


def learned_splits(
    rows: DataFrame, large: dict[int, int], shard_rows: int, space: Space
) -> dict[int, Splits]:
    splits = {}
    for width, count in large.items():
        wanted = min(SAMPLE_ROWS, max(1000, SAMPLE_BYTES // (8 * width)))
        share = min(1.0, wanted / count)
        drawn = rows.where(F.col("_width") == width).sample(share, SEED).limit(2 * wanted)
        vectors = [row["vector"] for row in drawn.select("vector").collect()]
        if vectors:
            sample = space(np.array(vectors, np.float64))
            if sample.dtype != object:
                splits[width] = Splits.learn(sample, -(-count // shard_rows))
    return splits


def placed_in_shards(
    rows: DataFrame, large: dict[int, int], shard_rows: int, space: Space
) -> DataFrame:
    """The rows with `_leaf`, the end of the splits that they come to, and `_part` of it.

    Widths that are not large have one shard.
    """
    splits = learned_splits(rows, large, shard_rows, space)

    @F.arrow_udf("int")
    def leaf_of(vectors: pa.Array) -> pa.Array:
        found = np.zeros(len(vectors), np.int32)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for width in set(lengths.tolist()) & splits.keys():
            some = np.flatnonzero(lengths == width)
            inside = space(matrix(vectors.take(pa.array(some))))
            if inside.dtype != object:
                found[some] = splits[width].leaf_of(inside)
        return pa.array(found)

    rows = rows.withColumn("_leaf", leaf_of("vector"))
    parts = rows.groupBy("_width", "_leaf").agg(
        F.ceil(F.count(F.lit(1)) / (2 * shard_rows)).cast("int").alias("_parts")
    )
    # One row a shard, and fewer for those that are cut.
    cut = committed(parts.where("_parts > 1"))
    return (
        rows.join(F.broadcast(cut), ["_width", "_leaf"], "left")
        .withColumn(
            "_part",
            F.coalesce(F.pmod(F.xxhash64("number"), F.col("_parts")), F.lit(0)).cast("int"),
        )
        .drop("_parts")
    )


@dataclass(frozen=True)
class Box:
    low: np.ndarray
    high: np.ndarray
    parts: int  # of the leaf


def boxes_of(
    placed: DataFrame, large: dict[int, int], space: Space
) -> dict[int, dict[int, Box]]:
    """By large width and leaf, the box of a leaf's vectors. Tasks send a box a leaf, not vectors."""
    placed = placed.where(F.col("_width").isin(list(large)))
    fields = "_width int, _leaf int, low binary, high binary, parts int"

    def run(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]] = {}
        for batch in batches:
            for key, low, high, parts in read(batch):
                if key in held:
                    low, high = np.minimum(low, held[key][0]), np.maximum(high, held[key][1])
                    parts = max(parts, held[key][2])
                held[key] = low, high, parts
        rows = [(*key, low.tobytes(), high.tobytes(), n) for key, (low, high, n) in held.items()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row[i] for row in rows], kind)
                for i, kind in enumerate(
                    (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32())
                )
            ],
            ["_width", "_leaf", "low", "high", "parts"],
        )

    def vectors(batch: pa.RecordBatch):
        keys = np.stack([batch.column(name).to_numpy() for name in ("_width", "_leaf")], axis=1)
        parts = batch.column("_part").to_numpy()
        for width, leaf in np.unique(keys, axis=0).tolist():
            some = np.flatnonzero((keys == (width, leaf)).all(axis=1))
            rows = space(matrix(batch.column("vector").take(pa.array(some))))
            if rows.dtype == object:
                # No double bounds these: the box is all of the space.
                low, high = np.full(width, -np.inf), np.full(width, np.inf)
            else:
                low, high = rows.min(axis=0), rows.max(axis=0)
            yield (width, leaf), low, high, int(parts[some].max()) + 1

    def boxes(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            low, high = (np.frombuffer(row[name]) for name in ("low", "high"))
            yield (row["_width"], row["_leaf"]), low, high, row["parts"]

    partial = placed.select("_width", "_leaf", "_part", "vector").mapInArrow(
        lambda batches: run(batches, vectors), fields
    )
    whole = partial.repartition("_width", "_leaf").mapInArrow(
        lambda batches: run(batches, boxes), fields
    )
    found: dict[int, dict[int, Box]] = {}
    for row in whole.collect():
        low, high = (np.frombuffer(bytes(row[name])) for name in ("low", "high"))
        found.setdefault(row["_width"], {})[row["_leaf"]] = Box(low, high, row["parts"])
    return found


# --- queries ------------------------------------------------------------------------------------

#: A block of queries on its way to a shard. Its columns hold packed numbers.
BLOCK = (
    "_width int, _leaf int, _part int, numbers binary, ids binary, leasts binary, vectors binary"
)


def block_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    names = [part.split()[0] for part in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names
    )


def sent(asking: DataFrame, targets: Callable) -> DataFrame:
    """Blocks of the queries (number, vec_id, vector, _least, _width, _leaf, _part).

    `targets` gives, for queries of one width, the shards (leaf, part) that get some of them, and
    which: it is told their vectors, least scores, leaves and parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("_width").to_numpy()
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                part = batch.take(pa.array(some))
                vectors = matrix(part.column("vector"))
                numbers, ids, leaves, parts = (
                    part.column(name).to_numpy() for name in ("number", "vec_id", "_leaf", "_part")
                )
                least = part.column("_least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                for leaf, piece, chosen in targets(width, vectors, least, leaves, parts):
                    for start in range(0, len(chosen), QUERY_BLOCK):
                        these = chosen[start : start + QUERY_BLOCK]
                        packed = (numbers, ids, least.astype(np.float64), vectors)
                        yield block_rows(
                            [(width, leaf, piece, *(values[these].tobytes() for values in packed))]
                        )

    columns = ["number", "vec_id", "vector", "_least", "_width", "_leaf", "_part"]
    return asking.select(*columns).mapInArrow(run, BLOCK)


def to_own_shard(width, vectors, least, leaves, parts):
    keys = np.stack([leaves, parts], axis=1)
    for leaf, part in np.unique(keys, axis=0).tolist():
        yield leaf, part, np.flatnonzero((leaves == leaf) & (parts == part))


def to_reaching_shards(boxes: dict[int, dict[int, Box]], space: Space):
    """Every other shard whose box holds a point that scores as high as a query's k-th best."""

    def targets(width, vectors, least, leaves, parts):
        known = boxes.get(width, {})
        inside = space(vectors)
        for leaf, box in known.items():
            if inside.dtype == object or not np.isfinite(box.low).all():
                reaching = np.ones(len(vectors), bool)
            else:
                bound = np.maximum(inside, 0) @ box.high + np.minimum(inside, 0) @ box.low
                # Room for what rounding may take off.
                far = np.maximum(np.abs(box.low), np.abs(box.high))
                reaching = bound + 1e-9 * (np.abs(inside) @ far) + 1e-300 >= least
            for part in range(box.parts):
                chosen = np.flatnonzero(reaching & ((leaves != leaf) | (parts != part)))
                if len(chosen):
                    yield leaf, part, chosen

    return targets


def searched(
    candidates: DataFrame, blocks: DataFrame, k: int, make_index: MakeIndex, kind: str
) -> DataFrame:
    """query (a number), query_id, vec_id, score: what queries find in the shards they are sent to."""
    nothing = [F.lit(None).cast("binary").alias(n) for n in ("numbers", "ids", "leasts", "vectors")]
    asked = blocks.select("_width", "_leaf", "_part").distinct()
    live = candidates.join(asked, ["_width", "_leaf", "_part"], "left_semi")
    together = live.select(
        "_width", "_leaf", "_part", F.lit(0).alias("_asks"), "number", "vec_id", "vector", *nothing
    ).unionByName(
        blocks.select("*", F.lit(1).alias("_asks")), allowMissingColumns=True
    )
    dealt = together.repartition("_width", "_leaf", "_part").sortWithinPartitions(
        "_width", "_leaf", "_part", "_asks", "number"
    )
    score_type = pa.int64() if kind == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index = None, [], None
        names = ("_width", "_leaf", "_part", "_asks")
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in names], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if low == high:
                    continue
                *shard, asks = keys[low].tolist()
                if key != shard:
                    key, held, index = shard, [], None
                part = batch.slice(low, high - low)
                if not asks:
                    held.append(
                        (
                            part.column("vec_id").to_numpy(),
                            part.column("number").to_numpy(),
                            matrix(part.column("vector")),
                        )
                    )
                    continue
                if index is None:
                    if not held:
                        continue
                    index = make_index(*map(np.concatenate, zip(*held, strict=True)))
                    held = []
                for block in part.select(["numbers", "ids", "leasts", "vectors"]).to_pylist():
                    numbers, ids = (np.frombuffer(block[n], np.int64) for n in ("numbers", "ids"))
                    least, vectors = (np.frombuffer(block[n]) for n in ("leasts", "vectors"))
                    queries, asked, found, scores = [], [], [], []
                    for place, best in index.search(
                        numbers, vectors.reshape(len(numbers), -1), least, k
                    ):
                        queries += [numbers[place]] * len(best)
                        asked += [ids[place]] * len(best)
                        found += [name for name, _ in best]
                        scores += [score for _, score in best]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(queries, pa.int64()),
                            pa.array(asked, pa.int64()),
                            pa.array(found, pa.int64()),
                            pa.array(scores, score_type),
                        ],
                        ["query", "query_id", "vec_id", "score"],
                    )

    return dealt.mapInArrow(run, f"query long, query_id long, vec_id long, score {kind}")


def best_k(
    rows: DataFrame,
    k: int,
    every: int,
    shard_rows: int,
    make_index: MakeIndex,
    kind: str,
    space: Space,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query.

    Queries are the rows whose id `every` divides, candidates all rows of the same width but the
    query's own row. Equal scores go by the smaller id. A query without candidates has no row. Rows
    are taken one by one where ids repeat: each is a query with ranks of its own, and each is a
    candidate, also for a query of its id.
    """
    rows = committed(
        rows.select(
            "*", F.monotonically_increasing_id().alias("number"), F.size("vector").alias("_width")
        )
    )
    size = rows_of_a_shard(rows.count(), shard_rows)
    large = large_widths(rows, size)
    placed = committed(placed_in_shards(rows, large, size, space))
    asking = placed.where(F.col("vec_id") % every == 0)
    unbounded = asking.withColumn("_least", F.lit(None).cast("double"))
    at_home = committed(searched(placed, sent(unbounded, to_own_shard), k, make_index, kind))
    best_at_home = at_home.groupBy("query").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("_least")
    )
    bounded = asking.join(best_at_home.withColumnRenamed("query", "number"), "number", "left")
    # Queries of a shard go on together, so that their blocks are full.
    together = bounded.sortWithinPartitions("_width", "_leaf", "_part")
    reaching = to_reaching_shards(boxes_of(placed, large, space), space)
    elsewhere = committed(sent(together, reaching))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        at_home.unionByName(searched(placed, elsewhere, k, make_index, kind))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
