"""The trie of all conversation prefixes, with totals of every subtree, by time-forward processing.

A node is a distinct sequence of first turns. Rows are sorted by conversation and turn over many tasks;
a conversation may lie in several. A prefix is known by a 128-bit fingerprint: the exclusive or of its
turns' hashes, each taken with its place, so that prefixes of one conversation follow from running
values within each task's part and the values of the parts before.

Subtree totals go up from the leaves. The few nodes with very many members are the trie's top; what
hangs below the top are subtrees, dealt to shards. A shard sorts its nodes by falling depth and goes
through them once: totals for a parent wait in a priority queue until the parent's turn comes, and what
does not fit in memory waits in sorted runs on the shared folder. What shards send to the top is added
up, and the top is gone through in the same way.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlake.llm.tables import committed, new_folder

#: Nodes with more members than a share of all rows, and than a few, are the top: fewer than this.
TOP_NODES = 20_000
FEW_MEMBERS = 50

#: Parents that wait in a shard's memory, and rows of a block of a run that is written out.
QUEUE_ROWS, RUN_BLOCK = 1_000_000, 65_536

#: Ids that are joined to one text before the texts of a node meet.
JOINED = 10_000

#: A word, as counted in a turn's text.
WORD = r"[^\x20\x09-\x0D]+"

NO_ENDS = hashlib.sha256().hexdigest()


# --- turns in order -----------------------------------------------------------------------------


def marked_turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, the two hashes of role and text, words; without rows that name no conversation."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    return committed(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv"),
            "turn",
            F.xxhash64(F.lit(1), role, text).alias("m1"),
            F.xxhash64(F.lit(2), role, text).alias("m2"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        )
    )


def in_order(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns in their order, and the pieces in which conversations lie.

    A piece (conv, part) holds `n` turns from place `first`, `before` of `total` turns come before it.
    """
    order = ["conv", "turn", "m1", "m2", "_even"]
    # Equal rows may be more than a task should get, so they are told apart.
    turns = turns.withColumn("_even", F.monotonically_increasing_id())
    rows = committed(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftrightunsigned("place", 33))
        .select("conv", "part", "place", "m1", "m2", "words")
    )
    same = Window.partitionBy("conv")
    pieces = rows.groupBy("conv", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first")
    )
    return rows, pieces.select(
        "*",
        F.coalesce(
            F.sum("n").over(same.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
        F.sum("n").over(same).alias("total"),
    )


def number() -> Column:
    """Number of a turn in its conversation, from 1, in the join of rows and pieces."""
    return F.col("place") - F.col("first") + F.col("before") + 1


def hashed(lane: int, depth: Column, m1: Column, m2: Column) -> Column:
    return F.xxhash64(F.lit(lane), depth.cast("long"), m1, m2)


# --- prefixes -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Graft:
    """Conversations begin with turns of another: of `every` successive ids the first is the stock.

    The first turns of the stock take the place of a conversation's own: as many as the checksum of
    its id leaves when divided by `most`.
    """

    every: int = 20
    most: int = 4


def begun(rows: DataFrame, pieces: DataFrame, graft: Graft | None) -> DataFrame:
    """`pieces` with `cut`, the own turns that go, and `head`, the turns that come in their place."""
    none = F.array().cast("array<struct<m1:bigint,m2:bigint,words:bigint>>")
    if graft is None:
        return pieces.select("*", F.lit(0).cast("long").alias("cut"), none.alias("head"))
    stock = F.col("conv") - F.col("conv") % graft.every
    longest = graft.most - 1
    turn = F.struct(number().alias("at"), F.struct("m1", "m2", "words").alias("turn"))
    first_turns = (
        rows.where(F.col("conv") == stock)
        .join(pieces.where(F.col("before") < longest), ["conv", "part"])
        .where(number() <= longest)
        .groupBy(F.col("conv").alias("stock"))
        .agg(F.array_sort(F.collect_list(turn)).getField("turn").alias("turns"))
    )
    cut = F.crc32(F.col("conv").cast("string").cast("binary")) % graft.most
    return (
        pieces.withColumn("stock", stock)
        .join(first_turns, "stock", "left")
        .select(
            *pieces.columns,
            cut.alias("cut"),
            F.slice(F.coalesce("turns", none), F.lit(1), cut.cast("int")).alias("head"),
        )
    )


def prefixes(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv, depth, words and `ends` of every turn that a conversation has, with two fingerprints:
    k1, k2 of the prefix that ends there, and p1, p2 of the one before.
    """
    lanes = (1, 2)
    grafted = F.size("head")
    length = grafted + F.greatest(F.col("total") - F.col("cut"), F.lit(0))

    def of_head(lane: int, upto: Column) -> Column:
        """Fingerprint of the first turns of the head."""
        some = F.slice("head", F.lit(1), upto.cast("int"))
        every = F.transform(some, lambda t, i: hashed(lane, i + 1, t["m1"], t["m2"]))
        return F.aggregate(every, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))

    # The turns of heads, from the one piece a conversation begins with.
    at = F.col("at")
    heads = (
        pieces.where((F.col("before") == 0) & (grafted > 0))
        .withColumn("at", F.explode(F.sequence(F.lit(1), grafted)))
        .select(
            "conv",
            at.cast("long").alias("depth"),
            F.col("head")[at - 1]["words"].alias("words"),
            (at == length).alias("ends"),
            *[of_head(lane, at).alias(f"k{lane}") for lane in lanes],
            *[of_head(lane, at - 1).alias(f"p{lane}") for lane in lanes],
        )
    )
    own = (
        rows.join(pieces, ["conv", "part"])
        .where(number() > F.col("cut"))
        .select(
            "conv", "part", "place", "words", "m1", "m2",
            (number() - F.col("cut") + grafted).cast("long").alias("depth"),
            length.alias("length"),
            (F.col("n") < F.col("total")).alias("split"),
            *[of_head(lane, grafted).alias(f"h{lane}") for lane in lanes],
        )
        .withColumns(
            {f"f{lane}": hashed(lane, F.col("depth"), F.col("m1"), F.col("m2")) for lane in lanes}
        )
    )
    # What the parts before hold of a conversation that lies in several.
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        own.where("split")
        .groupBy("conv", "part")
        .agg(*[F.bit_xor(f"f{lane}").alias(f"x{lane}") for lane in lanes])
        .select(
            "conv",
            "part",
            *[F.bit_xor(f"x{lane}").over(earlier).alias(f"c{lane}") for lane in lanes],
        )
    )
    so_far = (
        Window.partitionBy("conv", "part")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def running(lane: int) -> Column:
        zero = F.lit(0).cast("long")
        carry = F.coalesce(F.col(f"c{lane}"), zero).bitwiseXOR(F.col(f"h{lane}"))
        return F.bit_xor(f"f{lane}").over(so_far).bitwiseXOR(carry)

    later = own.join(carried, ["conv", "part"], "left").select(
        "conv", "depth", "words", (F.col("depth") == F.col("length")).alias("ends"),
        *[running(lane).alias(f"k{lane}") for lane in lanes],
        *[running(lane).bitwiseXOR(F.col(f"f{lane}")).alias(f"p{lane}") for lane in lanes],
    )
    return heads.unionByName(later)


# --- totals -------------------------------------------------------------------------------------


@dataclass
class Run:
    """Totals for parents of one depth, sorted by parent, read from the front.

    The rows are (id, children, leaves, saved). A run that was written out is read block by block.
    """

    rows: np.ndarray
    blocks: Iterator[np.ndarray] = field(default_factory=lambda: iter(()))
    at: int = 0

    def taken(self, last: int) -> Iterator[np.ndarray]:
        """The rows for parents up to `last`, once."""
        while True:
            end = int(np.searchsorted(self.rows[:, 0], last, "right"))
            if end > self.at:
                yield self.rows[self.at : end]
            self.at = end
            if end < len(self.rows):
                return
            self.rows, self.at = next(self.blocks, self.rows[:0]), 0
            if not len(self.rows):
                return


def added(rows: np.ndarray) -> np.ndarray:
    """One row a parent, sorted by parent, with the sums of its rows."""
    ids, group = np.unique(rows[:, 0], return_inverse=True)
    sums = np.zeros((len(ids), rows.shape[1]), np.int64)
    np.add.at(sums, group, rows)
    sums[:, 0] = ids
    return sums


class Waiting:
    """The priority queue of a shard: totals on their way from a depth to the one above.

    Nodes come by falling depth and rising id, so the queue is a list of sorted runs for each of two
    depths. Beyond `QUEUE_ROWS` parents the rows of a depth become one run in the folder.
    """

    def __init__(self, folder: str):
        self.folder = folder
        self.runs: dict[int, list[Run]] = {}
        self.fresh: dict[int, list[np.ndarray]] = {}
        self.written: list[str] = []

    def push(self, depth: int, rows: np.ndarray) -> None:
        fresh = self.fresh.setdefault(depth, [])
        fresh.append(added(rows))
        if len(fresh) > 32 or sum(map(len, fresh)) > QUEUE_ROWS:
            fresh[:] = [added(np.concatenate(fresh))]
            if len(fresh[0]) > QUEUE_ROWS:
                self.runs.setdefault(depth, []).append(self.write_out(fresh.pop()))

    def pop(self, depth: int, ids: np.ndarray) -> np.ndarray:
        """Sums for these parents of a depth, in rising order; none below them waits any more."""
        if self.fresh.get(depth):
            rows = added(np.concatenate(self.fresh.pop(depth)))
            self.runs.setdefault(depth, []).append(Run(rows))
        sums = np.zeros((len(ids), 3), np.int64)
        for run in self.runs.get(depth, ()):
            for rows in run.taken(int(ids[-1])):
                places = np.searchsorted(ids, rows[:, 0])
                if not np.array_equal(ids[places], rows[:, 0]):
                    raise AssertionError("totals for a node that is not in this shard")
                sums[places] += rows[:, 1:]
        return sums

    def leave(self, depth: int) -> None:
        """All nodes of this depth have been seen."""
        self.runs.pop(depth, None)

    def write_out(self, rows: np.ndarray) -> Run:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(self.folder)
        store.create_dir(folder)
        path = f"{folder}/{uuid.uuid4().hex}"
        self.written.append(path)
        names = ["id", "children", "leaves", "saved"]
        schema = pa.schema([(name, pa.int64()) for name in names])
        with store.open_output_stream(path) as out, pa.ipc.new_file(out, schema) as file:
            for start in range(0, len(rows), RUN_BLOCK):
                block = np.ascontiguousarray(rows[start : start + RUN_BLOCK].T)
                file.write_batch(pa.RecordBatch.from_arrays(list(map(pa.array, block)), names))

        def blocks() -> Iterator[np.ndarray]:
            with store.open_input_file(path) as source:
                file = pa.ipc.open_file(source)
                for number in range(file.num_record_batches):
                    yield np.stack([c.to_numpy() for c in file.get_batch(number).columns], axis=1)

        return Run(rows[:0], blocks())

    def close(self) -> None:
        from pyarrow import fs

        if self.written:
            store, _ = fs.FileSystem.from_uri(self.folder)
            for path in self.written:
                store.delete_file(path)


#: A node on its way through a shard. `sent` marks totals from elsewhere for the node that follows.
NODE = (
    "depth long, conv_id long, sent boolean, leaving boolean, parent_conv_id long, n_convs long, "
    "words long, k1 long, k2 long, n_children long, n_leaves long, saved_tokens long"
)


def gone_through(nodes: DataFrame, folder: str) -> DataFrame:
    """Nodes with the totals of their subtrees, out of partitions sorted by falling depth.

    A parent is in its children's partition, unless they are `leaving`: then rows that are `sent` come
    out, with what the parent gets from this partition's batch of nodes.
    """
    names = [part.split()[0] for part in NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = Waiting(folder)
        level = None
        for batch in batches:
            col = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in names}
            cuts = np.flatnonzero(col["depth"][1:] != col["depth"][:-1]) + 1
            edges = [0, *cuts.tolist(), len(batch)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                depth = int(col["depth"][low])
                if depth != level:
                    if level is not None:
                        waiting.leave(level)
                    level = depth
                here = {name: values[low:high] for name, values in col.items()}
                totals = ["n_children", "n_leaves", "saved_tokens"]
                sent = here["sent"]
                if sent.any():
                    rows = [here[name][sent] for name in ["conv_id", *totals]]
                    waiting.push(depth, np.stack(rows, axis=1).astype(np.int64))
                    here = {name: values[~sent] for name, values in here.items()}
                ids = here["conv_id"]
                if not len(ids):
                    continue
                sums = waiting.pop(depth, ids)
                leaves = np.where(sums[:, 0] == 0, 1, sums[:, 1])
                saved = sums[:, 2] + (here["n_convs"] - 1) * here["words"]
                here |= zip(totals, (sums[:, 0], leaves, saved), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(here[name]) for name in names], names)
                if depth == 0:
                    continue
                ones = np.ones(len(ids), np.int64)
                up = np.stack([here["parent_conv_id"], ones, leaves, saved], axis=1)
                leaving = here["leaving"]
                if not leaving.all():
                    waiting.push(depth - 1, up[~leaving])
                if leaving.any():
                    yield outgoing(depth - 1, added(up[leaving]))
        waiting.close()

    def outgoing(depth: int, rows: np.ndarray) -> pa.RecordBatch:
        size = len(rows)
        zeros, yes = np.zeros(size, np.int64), np.ones(size, bool)
        given = {
            "depth": np.full(size, depth), "conv_id": rows[:, 0], "sent": yes, "leaving": ~yes,
            "n_children": rows[:, 1], "n_leaves": rows[:, 2], "saved_tokens": rows[:, 3],
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(given.get(name, zeros))) for name in names], names
        )

    return nodes.sortWithinPartitions(F.desc("depth"), "conv_id", F.desc("sent")).mapInArrow(
        run, NODE
    )


def with_totals(nodes: DataFrame, rows: DataFrame, root: DataFrame) -> DataFrame:
    """All nodes and the root with their parents and the totals of their subtrees."""
    spark = nodes.sparkSession
    most = max(FEW_MEMBERS, rows.count() // TOP_NODES)
    # The members of all nodes together are the rows, so fewer than TOP_NODES have more than `most`.
    top = committed(nodes.where(F.col("n_convs") > most).unionByName(root))
    key, parent = ["k1", "k2", "depth"], ["p1", "p2", "depth"]
    as_parent = [
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
    ]
    top_parents = F.broadcast(top.select(as_parent))
    below = nodes.where(F.col("n_convs") <= most)
    under_top = below.join(top_parents, parent).withColumn("leaving", F.lit(True))
    deeper = (
        below.join(top_parents, parent, "left_anti")
        .join(below.select(as_parent), parent)
        .withColumn("leaving", F.lit(False))
    )
    # A conversation's path leaves the top once; there the subtree begins that its nodes are in.
    subtree = (
        rows.join(top_parents, parent, "left_semi")
        .join(F.broadcast(top.select(key)), key, "left_anti")
        .select(F.col("conv").alias("conv_id"), F.xxhash64("k1", "k2").alias("_subtree"))
    )
    fields = [part.split()[0] for part in NODE.split(", ")]

    totals = ["n_children", "n_leaves", "saved_tokens"]
    zero = F.lit(0).cast("long")

    def filled(found: DataFrame, **given: Column) -> DataFrame:
        """The fields of a node, 0 where there are none."""
        have = {name: F.col(name) for name in found.columns} | given
        return found.select(*[have.get(name, zero).alias(name) for name in fields])

    folder = new_folder(spark)
    dealt = under_top.unionByName(deeper).join(subtree, "conv_id").repartition("_subtree")
    shards = committed(gone_through(filled(dealt, sent=F.lit(False)), folder))
    sent = shards.where("sent").groupBy("depth", "conv_id")
    sent = sent.agg(*[F.sum(name).alias(name) for name in totals])
    of_top = filled(
        top.join(top_parents, parent, "left"),
        sent=F.lit(False),
        leaving=F.lit(False),
        parent_conv_id=F.coalesce("parent_conv_id", zero),
    )
    both = of_top.unionByName(filled(sent, sent=F.lit(True), leaving=F.lit(False)))
    topmost = gone_through(both.coalesce(1), folder)
    return shards.where(~F.col("sent")).unionByName(topmost)


# --- where conversations end --------------------------------------------------------------------


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the ids (conv) that end at each prefix, ascending and comma-joined.

    Ids are sorted over many tasks and joined to texts there; one task then hashes a prefix's texts,
    one after the other, as the digest asks for.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, ids = (batch.column(name).to_numpy() for name in ("k1", "k2", "conv"))
            if not len(ids):
                continue
            new = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            starts = np.concatenate(([0], new))
            ends = np.concatenate((new, [len(ids)]))
            pieces = [
                (low, min(low + JOINED, high))
                for start, high in zip(starts.tolist(), ends.tolist(), strict=True)
                for low in range(start, high, JOINED)
            ]
            first = np.array([low for low, _ in pieces])
            texts = [",".join(map(str, ids[low:high].tolist())) for low, high in pieces]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[first]), pa.array(k2[first]), pa.array(ids[first]), pa.array(texts)],
                ["k1", "k2", "first", "ids"],
            )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"k1": a, "k2": b, "ends_sha256": sha} for a, b, sha in done],
                pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]),
            )

        for batch in batches:
            done = []
            for a, b, ids in zip(
                *(batch.column(name).to_pylist() for name in ("k1", "k2", "ids")), strict=True
            ):
                if key != (a, b):
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (a, b), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield out(done)
        if key is not None:
            yield out([(*key, digest.hexdigest())])

    by_task = ends.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv")
    texts = by_task.mapInArrow(joined, "k1 long, k2 long, first long, ids string")
    return (
        texts.repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "first")
        .mapInArrow(digested, "k1 long, k2 long, ends_sha256 string")
    )


# --- the trie -----------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, graft: Graft | None = None) -> DataFrame:
    """All nodes of the trie of conversations (conv_id, turn, role, text), with subtree totals.

    Per node: conv_id, its smallest member; depth; parent_conv_id, its parent's conv_id (NULL for the
    root); n_convs, its members: the conversations that begin with it; n_children; n_leaves of its
    subtree; saved_tokens, the words of its subtree's last turns, each times the members but one;
    ends_sha256, the digest of the members that end with it, by rising id.

    Turns go by `turn`, NULL first, and equal ones by the fingerprint of role and text. A NULL role or
    text counts as empty; repeated rows are turns of their own. Rows with a NULL conv_id are of no
    conversation and left out. No conversations give no nodes, not even a root. Other columns are not
    read. One conversation's own nodes are gone through by one task, in bounded memory.
    """
    rows, pieces = in_order(marked_turns(conversations))
    pieces = committed(begun(rows, pieces, graft))
    path = committed(prefixes(rows, pieces))
    nodes = committed(
        path.groupBy("k1", "k2", "depth").agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv").alias("conv_id"),
            F.min("words").alias("words"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
        )
    )
    begins = pieces.where("before = 0")
    zero = F.lit(0).cast("long")
    root = (
        begins.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"))
        .where("n_convs > 0")
        .select(
            *[zero.alias(name) for name in ("k1", "k2", "depth", "words")],
            "n_convs",
            "conv_id",
            *[F.lit(None).cast("long").alias(name) for name in ("p1", "p2")],
        )
    )
    turnless = (F.size("head") == 0) & (F.col("total") <= F.col("cut"))
    ends = (
        path.where("ends")
        .select("k1", "k2", "conv")
        .unionByName(begins.where(turnless).select(zero.alias("k1"), zero.alias("k2"), "conv"))
    )
    return (
        with_totals(nodes, path, root)
        .join(end_digests(ends), ["k1", "k2"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations, each begun with turns of its twenty's first."""
    return prefix_trie(conversations, Graft())
