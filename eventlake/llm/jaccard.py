"""N-gram Jaccard join by T-occurrence search.

A document is the set of its distinct word n-grams, each hashed to 64 bits. Documents of one set are
one class, named by its smallest document. Two sets that reach the similarity have some n-grams in
common among the first of each, in whatever order all sets agree on (the prefix filter): prefixes that
are `more` longer than one common n-gram takes have `more` in common. N-grams that are known to be
frequent come last here, and a passage that many documents share seldom makes up enough of a prefix,
so it hardly ever leads two documents to each other.

1. One pass over all texts gives each document its set's size and fingerprint, and n-grams that are
   frequent somewhere. The most frequent ones are kept in a table of bounded size that only decides
   the order: any order finds the same links.
2. A second pass sends each class's prefix, as packed postings, to a bucket of the n-gram. What meets
   no set of a fitting size there is dropped, and then classes of which too little is left.
3. A class lives in the shard of its most shared n-gram; a shard with many classes is split. It asks
   every shard to whose classes enough n-grams of its prefix lead.
4. In a shard, inverted lists over the whole sets of its classes answer each question by DivideSkip:
   with T n-grams required, the longest L lists are set aside, the short ones are merged through a
   heap that skips, and what occurs T - L times is looked up in the long lists by binary search.
   Classes that are known to be connected are not compared again, so a shard returns a forest of
   links. Questions that could only confirm what is known are not sent: first every shard joins its
   own classes, then one class of each component asks, then all whose component is not yet the
   shard's only one.

Memory is bounded by the rows of a shard or bucket; frequent n-grams are dealt by class instead.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.arrays import lean, ragged, slices, text_array, words_of
from eventlake.llm.components import connected_components
from eventlake.llm.tables import committed

POSTING = np.dtype([("token", "<i8"), ("high", "<u8"), ("low", "<u8"), ("size", "<i4")])
#: N-grams that are counted at once in a task.
COUNTED = 1 << 21
#: Postings that a task holds back before it sends them.
HELD = 1 << 19
#: How DivideSkip weighs merging against looking up.
DIVIDE = 0.01


@dataclass(frozen=True)
class Settings:
    words: int = 5  # of an n-gram
    percent: int = 80  # of the union that two linked sets share at least
    more: int = 8  # per cent of a set by which its prefix is longer; decides speed only
    frequent: int = 3  # documents of a task's share from which on an n-gram is frequent
    ordered: int = 1 << 17  # frequent n-grams that the order knows; decides speed only
    bucket_postings: int = 400_000  # of a bucket, about
    shard_sets: int = 800  # classes of a shard, about
    askers: int = 600  # questions that one task puts to a shard, about


def combined(words: list[np.ndarray], seed: int) -> np.ndarray:
    """One hash of several words' hashes, in order."""
    mixed = np.full(len(words[0]), seed, np.uint64)
    for word in words:
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + word
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(29)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams of words, A-Z in lower case.

    With fewer words than an n-gram has, the whole sequence is the only one; without any there is
    none.
    """
    import xxhash

    vocabulary, index, bounds = words_of(pc.ascii_lower(texts))
    known = vocabulary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    flat = hashes[index]
    grams = np.zeros(0, np.uint64)
    if len(flat) >= words:
        last = len(flat) - words + 1
        grams = combined([flat[i : i + last] for i in range(words)], words)
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= words:
            found = np.sort(grams[start : end - words + 1])
            found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif end > start:
            found = combined([flat[i : i + 1] for i in range(start, end)], end - start)
        else:
            found = grams[:0]
        sets.append(found.view(np.int64))
    return sets


def fingerprint(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes())


def least_share(size: np.ndarray | int, settings: Settings):
    """Members that a set of this size has in common with any set that it links to, at least."""
    return -(-settings.percent * size // 100)


def least_common(size, settings: Settings):
    """N-grams that the prefix of a set this large has in common with any that it links to.

    A linked set may be smaller, and the smaller prefix of the two decides.
    """
    return np.maximum(1, least_share(size, settings) * settings.more // 100)


def prefix_length(size, settings: Settings):
    return np.minimum(
        size, size - least_share(size, settings) + np.maximum(1, size * settings.more // 100)
    )


def least_overlap(one, other, settings: Settings):
    """Common members that sets of these sizes need."""
    return -(-settings.percent * (one + other) // (100 + settings.percent))


def sets_of(batches: Iterator[pa.RecordBatch], words: int, most: int = 1 << 21):
    """Per slice of the batches: the batch's slice and its texts' sets."""
    for batch in batches:
        whole = text_array(batch.column("text"))
        for start, end in slices(whole, most):
            yield batch.slice(start, end - start), shingle_sets(
                whole.slice(start, end - start), words
            )


def summarise(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, key, size and set (NULL for size 0) of every document; frequent n-grams: token, seen.

    A set that a task has met before does not count again.
    """
    schema = "doc_id long, key long, size long, set binary, token long, seen long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held, count = set(), [], 0

        def row_batch(*columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                list(columns), ["doc_id", "key", "size", "set", "token", "seen"]
            )

        def frequent() -> pa.RecordBatch:
            tokens, seen = np.unique(np.concatenate(held), return_counts=True)
            often = seen >= settings.frequent
            size = int(often.sum())
            none = pa.nulls(size, pa.int64())
            return row_batch(
                none, none, none, pa.nulls(size, pa.binary()),
                pa.array(tokens[often]), pa.array(seen[often]),
            )

        for part, sets in sets_of(batches, settings.words):
            prints = [fingerprint(found) if len(found) else None for found in sets]
            for name, found in zip(prints, sets, strict=True):
                if name is not None and name not in met:
                    met.add(name)
                    held.append(found)
                    count += len(found)
            none = pa.nulls(len(part), pa.int64())
            yield row_batch(
                part.column("doc_id"), part.column("key"),
                pa.array([len(found) for found in sets], pa.int64()),
                pa.array(prints, pa.binary()), none, none,
            )
            if count >= COUNTED:
                yield frequent()
                met, held, count = set(), [], 0
        if held:
            yield frequent()

    return committed(documents.mapInArrow(lean(run), schema))


def prefixes(sets: list[np.ndarray], order: np.ndarray, often: np.ndarray, settings: Settings):
    """The first n-grams of each set as postings without their set, and the owner of each.

    `order` holds the frequent n-grams, sorted, and `often` how frequent each is. Others come
    before them, by hash.
    """
    sizes = np.array([len(found) for found in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    heavy = np.zeros(len(flat), bool)
    if len(order):
        at = np.minimum(np.searchsorted(order, flat), len(order) - 1)
        heavy = order[at] == flat
    light = np.concatenate(([0], np.cumsum(~heavy)))
    starts = np.cumsum(sizes) - sizes
    place = light[:-1] - light[starts][owner]
    rows = np.flatnonzero(heavy)
    if len(rows):
        rows = rows[np.lexsort((flat[rows], often[at[rows]], owner[rows]))]
        heavies = np.bincount(owner[rows], minlength=len(sets))
        first = np.cumsum(heavies) - heavies
        place[rows] = (
            (sizes - heavies)[owner[rows]] + np.arange(len(rows)) - first[owner[rows]]
        )
    kept = place < prefix_length(sizes, settings)[owner]
    found = np.zeros(int(kept.sum()), POSTING)
    found["token"], found["size"] = flat[kept], sizes[owner[kept]]
    return found, owner[kept]


def live_postings(
    documents: DataFrame, order: np.ndarray, often: np.ndarray, buckets: int, settings: Settings
) -> DataFrame:
    """token, set, size and shared (how many sets have the n-gram) of what others' prefixes share."""

    def is_frequent(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(order):
            return np.zeros(len(tokens), bool), np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(order, tokens), len(order) - 1)
        return order[at] == tokens, often[at]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held, count = set(), [], 0

        def packed() -> pa.RecordBatch:
            rows = np.concatenate(held)
            # Frequent n-grams are dealt by set: they need not meet to be known as shared.
            heavy, _ = is_frequent(rows["token"])
            by_token = rows["token"].astype(np.uint64) >> np.uint64(32)
            bucket = np.where(heavy, rows["low"], by_token) % np.uint64(buckets)
            by_bucket = np.argsort(bucket, kind="stable")
            rows, bucket = rows[by_bucket], bucket[by_bucket]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            parts = [part.tobytes() for part in np.split(rows, cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts].astype(np.int32)), pa.array(parts, pa.binary())],
                ["bucket", "postings"],
            )

        for _, sets in sets_of(batches, settings.words):
            new, names = [], []
            for found in sets:
                if len(found) and (name := fingerprint(found)) not in met:
                    met.add(name)
                    new.append(found)
                    names.append(name)
            rows, owner = prefixes(new, order, often, settings)
            if len(rows):
                halves = np.frombuffer(b"".join(names), "<u8").reshape(-1, 2)
                rows["high"], rows["low"] = halves[owner].T
                held.append(rows)
                count += len(rows)
            if count >= HELD:
                yield packed()
                held, count = [], 0
        if held:
            yield packed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for name, data in zip(
                batch.column("bucket").to_pylist(), batch.column("postings"), strict=True
            ):
                if name != bucket and parts:
                    yield met_postings(np.concatenate(parts))
                    parts = []
                bucket = name
                parts.append(np.frombuffer(data.as_buffer(), POSTING))
        if parts:
            yield met_postings(np.concatenate(parts))

    def met_postings(rows: np.ndarray) -> pa.RecordBatch:
        rows = rows[np.lexsort((rows["low"], rows["high"], rows["size"], rows["token"]))]
        same = rows["token"][1:] == rows["token"][:-1]
        twin = same & (rows["high"][1:] == rows["high"][:-1])
        twin &= rows["low"][1:] == rows["low"][:-1]
        rows = rows[np.append(True, ~twin)]
        same = rows["token"][1:] == rows["token"][:-1]
        starts = np.flatnonzero(np.append(True, ~same))
        lengths = np.diff(np.append(starts, len(rows)))
        heavy, seen = is_frequent(rows["token"])
        # The nearest size above or below fits if any does.
        size = rows["size"].astype(np.int64)
        fits = same & (100 * size[:-1] >= settings.percent * size[1:])
        keep = heavy | np.append(fits, False) | np.append(False, fits)
        shared = np.where(heavy, seen, np.repeat(lengths, lengths))[keep]
        rows = rows[keep]
        halves = np.stack([rows["high"], rows["low"]], axis=1)
        ends = (np.arange(len(rows) + 1) * 16).astype(np.int32)
        names = pa.Array.from_buffers(
            pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(halves.tobytes())]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows["token"]),
                names,
                pa.array(rows["size"]),
                pa.array(shared.astype(np.int64)),
            ],
            ["token", "set", "size", "shared"],
        )

    sent = documents.select("text").mapInArrow(lean(send), "bucket int, postings binary")
    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return committed(dealt.mapInArrow(lean(meet), "token long, set binary, size int, shared long"))


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """Numbers that occur in `need` of the sorted lists, with their occurrences, by a heap.

    Lists whose heads come too late in number jump to the first head that can still make it.
    """
    heap = [(numbers[0], place, 0) for place, numbers in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= need:
        least, taken = heap[0][0], []
        while heap and heap[0][0] == least:
            taken.append(heapq.heappop(heap))
        if len(taken) >= need:
            yield least, len(taken)
            target = least + 1
        else:
            while heap and len(taken) < need - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                return
            target = max(heap[0][0], least + 1)
        for _, place, at in taken:
            numbers = lists[place]
            at = bisect_left(numbers, target, at)
            if at < len(numbers):
                heapq.heappush(heap, (numbers[at], place, at))


class Shard:
    """Inverted lists over the sets of a shard, and which of them are known to be connected."""

    def __init__(self, sets: list[np.ndarray], labels: list[int], settings: Settings):
        self.settings = settings
        self.sizes = np.array([len(found) for found in sets], np.int64)
        self.labels = np.array(labels, np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owners, flat = owner[order], flat[order]
        starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        self.tokens, self.starts = flat[starts], starts
        self.ends = np.append(starts[1:], len(flat))
        rank = np.repeat(np.arange(len(starts)), self.ends - starts)
        self.keys = rank * len(sets) + self.owners

    def partners(self, asked: np.ndarray, label: int) -> Iterator[int]:
        """Sets linked to the asked one, one at least of each component that has any."""
        size, settings = len(asked), self.settings
        at = np.minimum(np.searchsorted(self.tokens, asked), len(self.tokens) - 1)
        at = at[self.tokens[at] == asked]
        need = int(least_share(size, settings))
        if len(at) < need:
            return
        length = self.ends[at] - self.starts[at]
        by_length = np.argsort(-length, kind="stable")
        at, length = at[by_length], length[by_length]
        # Members that no list holds cannot be found: the lists fall short of the size by them.
        set_aside = min(need - 1, int(need / (DIVIDE * np.log2(length[0] + 1) + 1)))
        far, near = at[:set_aside], at[set_aside:]
        counts = length[set_aside:]
        entries = self.owners[ragged(self.starts[near], counts)]
        sizes = self.sizes[entries]
        open_ = (
            (self.labels[entries] != label)
            & (100 * sizes >= settings.percent * size)
            & (100 * size >= settings.percent * sizes)
        )
        if not open_.any():
            return
        left = np.add.reduceat(open_, np.cumsum(counts) - counts)
        bounds = np.cumsum(left[left > 0])
        numbers = entries[open_].tolist()
        lists = [
            numbers[start:end]
            for start, end in zip([0, *bounds.tolist()], bounds.tolist(), strict=False)
        ]
        for other, seen in merge_skip(lists, need - set_aside):
            if self.labels[other] == label:
                continue
            probe = far * len(self.sizes) + other
            found = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            seen += int((self.keys[found] == probe).sum())
            if seen >= least_overlap(size, int(self.sizes[other]), settings):
                yield other

    def join(self, one: int, other: int) -> None:
        self.labels[self.labels == one] = other


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Runs of rows of one shard, slice and role; the input is sorted by them."""
    names = ("home", "part", "slice", "asks")
    for batch in batches:
        keys = np.stack([batch.column(name).to_numpy() for name in names], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if end > start:
                *shard, asks = keys[start].tolist()
                yield tuple(shard), asks, batch.slice(start, end - start)


class Links:
    """The links that one shard finds, at most one for each two labels that it joins."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.sets: list[np.ndarray] = []
        self.labels: list[int] = []
        self.shard: Shard | None = None
        self.met: set[bytes] = set()
        self.now: dict[int, int] = {}  # labels that were joined, and to which

    def checked(self, part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int]]:
        """Sets and labels; a row whose text is not the set's, or that came before, goes."""
        names = part.column("set").to_pylist()
        own = part.column("label").to_pylist()
        done = 0
        for piece, found in sets_of(iter([part]), self.settings.words):
            for one, name, label in zip(found, names[done:], own[done:], strict=False):
                if name not in self.met and len(one) and fingerprint(one) == name:
                    self.met.add(name)
                    yield one, label
            done += len(piece)

    def live(self, part: pa.RecordBatch) -> None:
        for one, label in self.checked(part):
            self.sets.append(one)
            self.labels.append(label)

    def ask(self, asking) -> Iterator[tuple[int, int]]:
        if self.shard is None and self.sets:
            self.shard = Shard(self.sets, self.labels, self.settings)
        for one, label in asking if self.shard else ():
            own = label
            while own in self.now:
                own = self.now[own]
            for other in self.shard.partners(one, own):
                theirs = int(self.shard.labels[other])
                if theirs != own:
                    yield label, self.labels[other]
                    self.now[theirs] = own
                    self.shard.join(theirs, own)

    def ask_all(self, part: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        if self.shard is None:
            self.met = set()
        yield from self.ask(self.checked(part))

    def ask_each_other(self) -> Iterator[tuple[int, int]]:
        yield from self.ask(zip(self.sets, self.labels, strict=True))


def searched(rows: DataFrame, settings: Settings, each_other: bool) -> DataFrame:
    """Links that the shards find: a and b, the labels that two linked sets came with.

    `rows` are home, part, slice, asks (0: lives there, 1: asks), set, label and text. With
    `each_other` what lives in a shard asks there, too. Slices of a shard hold all that lives there,
    and some of what asks.
    """

    def link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([link[side] for link in links], pa.int64()) for side in (0, 1)], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, links = None, Links(settings)
        for now, asks, part in by_shard(batches):
            if key != now:
                if each_other:
                    yield link_batch(list(links.ask_each_other()))
                key, links = now, Links(settings)
            if asks:
                yield link_batch(list(links.ask_all(part)))
            else:
                links.live(part)
        if each_other:
            yield link_batch(list(links.ask_each_other()))

    shard = ["home", "part", "slice"]
    dealt = rows.repartition(*shard).sortWithinPartitions(*shard, "asks", "set")
    return dealt.select(*shard, "asks", "set", "label", "text").mapInArrow(lean(run), "a long, b long")


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node and label with linked labels joined."""
    roots = connected_components(links).withColumnRenamed("node", "label")
    return committed(
        labels.join(roots, "label", "left").select(
            "node", F.coalesce("root", "label").alias("label")
        )
    )


def joined_labels(
    shared: DataFrame, documents: DataFrame, classes: DataFrame, settings: Settings
) -> DataFrame:
    """node and label of classes: equal labels for connected ones.

    `shared` holds token, node, size and shared of what classes share; a class that is not in the
    result is not linked. `classes` holds node, set, and doc_id and key of a document with that set.
    """
    size = F.col("size").cast("long")
    smaller = F.ceil(size * settings.percent / 100)
    needed = F.greatest(F.lit(1).cast("long"), F.floor(smaller * settings.more / 100))
    homes = (
        shared.groupBy("node")
        .agg(
            F.max(F.struct("shared", "token")).alias("best"),
            F.count(F.lit(1)).alias("left"),
            F.max("size").alias("size"),
        )
        .where(F.col("left") >= needed)
        .select("node", F.col("best.token").alias("home"), needed.alias("needed"))
    )
    homes = committed(homes)
    known = committed(shared.join(homes, "node").select("token", "node", "home", "needed"))
    # To whose homes the n-grams lead: to a class's own only if another lives there.
    leads = known.groupBy("token", F.col("home").alias("to")).agg(
        F.count(F.lit(1)).alias("living")
    )
    routes = committed(
        known.join(leads, "token")
        .where((F.col("to") != F.col("home")) | (F.col("living") > 1))
        .groupBy("node", "to", "needed")
        .count()
        .where(F.col("count") >= F.col("needed"))
        .select("node", F.col("to").alias("home"))
    )
    # What is linked has a route to its partner's home, so what has no route is not linked.
    homes = homes.join(routes.select("node").distinct(), "node", "left_semi").select("node", "home")
    parts = homes.groupBy("home").agg(
        F.ceil(F.count(F.lit(1)) / settings.shard_sets).cast("int").alias("parts")
    )
    placed = committed(
        homes.join(parts, "home").select(
            "node", "home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
        )
    )
    # Only now texts move, and only those of classes that may be linked.
    wanted = classes.join(placed.select("node"), "node", "left_semi")
    same = F.col("d.key") == F.col("w.key")
    same &= F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    texts = committed(
        documents.alias("d").join(wanted.alias("w"), same).select("node", "set", "text")
    )
    # Every shard joins the classes that live there.
    living = placed.join(routes, ["node", "home"], "left_semi")
    first = living.join(texts, "node").select(
        "home",
        "part",
        F.lit(0).alias("slice"),
        F.lit(0).alias("asks"),
        "set",
        F.col("node").alias("label"),
        "text",
    )
    labels = relabelled(
        placed.select("node", F.col("node").alias("label")),
        committed(searched(first, settings, each_other=True)),
    )
    # Then the other shards are asked: first by one class of each component.
    for one_of_each in (True, False):
        there = placed.join(labels, "node")
        shards = there.groupBy("home", "part").agg(
            F.min("label").alias("low"), F.max("label").alias("high")
        )
        asking = (
            routes.join(labels, "node")
            .join(shards, "home")
            .where((F.col("label") != F.col("low")) | (F.col("label") != F.col("high")))
            .join(placed, ["node", "home", "part"], "left_anti")
            .select("node", "label", "home", "part")
        )
        if one_of_each:
            asking = asking.groupBy("label", "home", "part").agg(F.min("node").alias("node"))
        asking = committed(asking.select("home", "part", F.lit(1).alias("asks"), "node", "label"))
        if asking.isEmpty():
            break
        # What many ask is copied, so that each copy has few questions to answer.
        slices = committed(
            asking.groupBy("home", "part").agg(
                F.ceil(F.count(F.lit(1)) / settings.askers).cast("int").alias("slices")
            )
        )
        living = there.join(slices, ["home", "part"]).select(
            "home",
            "part",
            F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
            F.lit(0).alias("asks"),
            "node",
            "label",
        )
        sliced = asking.join(slices, ["home", "part"]).select(
            "home",
            "part",
            F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice"),
            "asks",
            "node",
            "label",
        )
        rows = living.unionByName(sliced).join(texts, "node")
        links = committed(searched(rows, settings, each_other=False))
        labels = relabelled(labels, links)
    return labels


def with_shared_ids(sets: DataFrame, members: DataFrame) -> DataFrame:
    """`members` (set, component_id) with components joined that rows of one id are in."""
    named = sets.join(members, "set").where("doc_id IS NOT NULL").groupBy("doc_id")
    ends = named.agg(F.min("component_id").alias("b"), F.max("component_id").alias("a"))
    split = committed(ends.where("a > b").select("doc_id", "b"))
    if split.isEmpty():
        return members
    links = sets.join(members, "set").join(split, "doc_id").select(
        F.col("component_id").alias("a"), "b"
    )
    roots = connected_components(links).withColumnRenamed("node", "component_id")
    return members.join(roots, "component_id", "left").select(
        "set", F.coalesce("root", "component_id").alias("component_id")
    )


def similar_groups(
    documents: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per document.

    component_id is the smallest id that is reachable by links, the document's own included.
    Documents without words (NULL, empty or white space) have 0 n-grams and link to nothing. Equal
    texts are linked. Rows of one id count as one document in links. Rows without an id are documents
    of their own, which link like others; a component is NULL if none of its rows has an id. An empty
    table gives an empty one.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("key"),
        F.col(text).alias("text"),
    )
    summary = summarise(rows, settings)
    sets = summary.where("token IS NULL").select("doc_id", "key", "size", "set")
    frequent = (
        summary.where("token IS NOT NULL")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "token")
        .limit(settings.ordered)
        .collect()
    )
    order = np.array([row["token"] for row in frequent], np.int64)
    often = np.array([row["seen"] for row in frequent], np.int64)
    often, order = often[np.argsort(order)], np.sort(order)
    size = F.col("size")
    posted = sets.agg(F.sum(size)).first()[0] or 0
    posted = posted * (100 - settings.percent + settings.more) // 100
    buckets = max(64, posted // settings.bucket_postings)
    live = live_postings(rows, order, often, buckets, settings)
    # A class goes by its smallest document, or by a number if that is no name of one class alone.
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    classes = committed(
        sets.where(size > 0)
        .groupBy("set")
        .agg(F.min(first).alias("first"))
        .select("set", "first.doc_id", "first.key")
    )
    by_id = classes.groupBy("doc_id").count()
    numbered = not by_id.where("doc_id IS NULL OR count > 1").isEmpty()
    if numbered:
        classes = committed(classes.withColumn("node", F.monotonically_increasing_id()))
    else:
        classes = classes.withColumn("node", F.col("doc_id"))
    shared = committed(live.join(classes, "set").select("token", "node", "size", "shared"))
    labels = joined_labels(shared, rows, classes, settings)
    members = classes.join(labels, "node", "left").select(
        "set", "doc_id", F.coalesce("label", "node").alias("component_id")
    )
    if numbered:
        least = members.groupBy("component_id").agg(F.min("doc_id").alias("least"))
        members = members.join(least, "component_id", "left").select(
            "set", F.col("least").alias("component_id")
        )
    members = members.select("set", "component_id")
    members = with_shared_ids(sets.where(size > 0), members)
    # Labels are the smallest documents of their components.
    return sets.join(members, "set", "left").select(
        "doc_id",
        size.alias("n_shingles"),
        F.when(size > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
