"""Spelling variants of a corpus's words, by sorted rotations (a permuterm index).

A word is marked with a terminator at its end, and all rotations of that are sorted. In a rotation that
starts behind the k-th character, this character comes last, so words that differ in it share all the
rest: a prefix of the rotation. A word that lacks the character has exactly this prefix as one of its
own rotations. Hence one group of equal prefixes holds all replacements at one place and the word
without that character. A group has at most as many members as there are characters, and one; a scan
tells each member how many neighbours it has there and which of them is the most frequent, so pairs
are never written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tables import committed

#: Letters of a word.
RUN = re.compile("[A-Za-zÀ-ÿ]+")

#: Marks the end of a word; words do not hold it.
END = "\0"

#: Rotations of more characters are sorted by a 127-bit fingerprint of theirs, else the rotations of
#: one word of n letters would take n * n bytes.
LONGEST = 64
PRIME, BASE = (1 << 127) - 1, 0x6D2B79F5_1B873593_85EBCA6B_C2B2AE35 % ((1 << 127) - 1)

#: Distinct words that a task counts before it hands the counts on.
HELD = 200_000

#: Rows of an Arrow batch that a task writes.
BATCH = 50_000


@dataclass(frozen=True)
class Settings:
    #: Words have at least so many code points,
    least_length: int = 6
    #: and occur at least so often.
    least_count: int = 5
    #: A word is a variant of a near one that occurs so many times as often.
    factor: int = 5
    #: If set, one in so many words of a document loses a letter, chosen by a checksum: a known
    #: amount of misspelling to measure with.
    misspell: int | None = None


# --- words --------------------------------------------------------------------------------------


def misspelled(word: str, start: int, one_in: int) -> str:
    """The word, or the word without a letter if `one_in` divides its checksum, begun with `start`."""
    checksum = zlib.crc32(word.encode(), start)
    if checksum % one_in:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def counted(doc_id: str | None, text: str, settings: Settings) -> Iterator[tuple[str, int]]:
    """Words of one text that are long enough, and how often each occurs, in any order."""
    # Bytes are lower-cased from A to Z only.
    lowered = text.encode().lower().decode()
    if len(lowered) < 1 << 20:
        runs = Counter(RUN.findall(lowered))
    else:
        # The same without a list of all occurrences.
        runs = Counter(match[0] for match in RUN.finditer(lowered))
    start = zlib.crc32(f"{doc_id or ''}:".encode())
    for word, n in runs.items():
        if len(word) >= settings.least_length:
            if settings.misspell:
                word = misspelled(word, start, settings.misspell)
                if len(word) < settings.least_length:
                    continue
            yield word, n


def count_words(
    documents: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """word, n: all words that are long and frequent enough, lower-cased from A to Z.

    NULL and empty texts have no words, a NULL id counts as an empty one (it only matters to
    `misspell`), repeated rows count as often as they are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                ["word", "n"],
            )

        for batch in batches:
            for name, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                for word, n in counted(name.as_py(), text.as_py(), settings):
                    held[word] += n
                    if len(held) >= HELD:
                        yield out()
                        held.clear()
        yield out()

    texts = documents.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    counts = texts.mapInArrow(run, "word string, n long").groupBy("word")
    return counts.agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)


# --- rotations ----------------------------------------------------------------------------------

#: What a row is in its group: the word that the prefix spells, a word with one more character, and
#: such a word if the character is the first of a run of equal ones. Removing any character of a run
#: gives the same word, so only the first counts.
WHOLE, SKIPS, SKIPS_FIRST = 0, 1, 2


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """The prefixes by which the word is sorted, and its role at each."""
    size = len(word)
    if size < LONGEST:
        around = word + END + word
        for at in range(size + 1):
            yield around[at : at + size + 1], WHOLE
        for at in range(size):
            first = at == 0 or word[at] != word[at - 1]
            yield around[at + 1 : at + 1 + size], SKIPS_FIRST if first else SKIPS
        return
    # Fingerprints roll from one rotation to the next, so a long word takes no more memory than itself.
    marked = word + END
    mark = 0
    for letter in marked:
        mark = (mark * BASE + ord(letter) + 1) % PRIME
    top, back = pow(BASE, size, PRIME), pow(BASE, -1, PRIME)
    for at, letter in enumerate(marked):
        yield fingerprint(mark, size + 1, size - at), WHOLE
        code = ord(letter) + 1
        mark = ((mark - code * top) * BASE + code) % PRIME
        if at < size:
            first = at == 0 or letter != word[at - 1]
            rest = (mark - code) * back % PRIME
            if size > LONGEST:
                key = fingerprint(rest, size, size - at - 1)
            else:
                key = word[at + 1 :] + END + word[:at]
            yield key, SKIPS_FIRST if first else SKIPS


def fingerprint(mark: int, size: int, end: int) -> str:
    """Stands for a rotation of this size that has its terminator here."""
    return f"{END}{END}{mark:x}:{size}:{end}"


def sorted_rotations(words: DataFrame) -> DataFrame:
    """key, id, n, role of every rotation of words (id, word, n), sorted by key, n and id."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
        for name, word, n in zip(
            *(batch.column(field).to_pylist() for field in ("id", "word", "n")), strict=True
        ):
            for key, role in rotations(word):
                yield key, name, n, role

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.int64(), pa.int8())
        for batch in batches:
            for some in chunks(rows(batch), BATCH):
                columns = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["key", "id", "n", "role"],
                )

    every = words.select("id", "word", "n").mapInArrow(
        run, "key string, id long, n long, role tinyint"
    )
    return every.repartition("key").sortWithinPartitions("key", F.desc("n"), "id")


def chunks(rows: Iterable, size: int) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


# --- neighbours ---------------------------------------------------------------------------------


def scanned(groups: pa.Table) -> pa.RecordBatch:
    """id, near, best_n, best_id of members with neighbours, out of whole groups of sorted rows.

    Rows of a group come by falling n and rising id, so of two neighbours the earlier is better.
    """
    keys = groups.column("key").combine_chunks()
    ids, ns, roles = (groups.column(name).to_numpy() for name in ("id", "n", "role"))
    size = len(ids)
    new = np.ones(size, bool)
    new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, size - 1)).to_numpy(zero_copy_only=False)
    group = np.cumsum(new) - 1
    total = int(group[-1]) + 1

    def earliest(chosen: np.ndarray, rank: int = 0) -> np.ndarray:
        """Row of each group's first (or next) chosen member, or `size`."""
        places = np.flatnonzero(chosen)
        at = group[places]
        head = np.ones(len(at), bool)
        head[1:] = at[1:] != at[:-1]
        if rank:
            # The second follows the first.
            head = np.concatenate(([False], head[:-1])) & ~head
        found = np.full(total, size)
        found[at[head]] = places[head]
        return found

    skips, first_skips, whole = roles != WHOLE, roles == SKIPS_FIRST, roles == WHOLE
    n_skips = np.bincount(group[skips], minlength=total)
    n_first = np.bincount(group[first_skips], minlength=total)
    best, second, best_first = earliest(skips), earliest(skips, 1), earliest(first_skips)
    short = earliest(whole)
    here = np.arange(size)
    # Other words with one more character are near by a replacement, the word itself by an indel.
    other = np.where(best[group] == here, second[group], best[group])
    lacking = np.where(first_skips, short[group], size)
    near = np.where(whole, n_first[group], n_skips[group] - 1 + (lacking < size))
    choice = np.where(whole, best_first[group], np.minimum(other, lacking))
    out = np.flatnonzero(near)
    choice = choice[out]
    return pa.RecordBatch.from_arrays(
        [pa.array(column) for column in (ids[out], near[out], ns[choice], ids[choice])],
        ["id", "near", "best_n", "best_id"],
    )


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best_n, best_id of the words (id, word, n) that have a near word.

    The best near word is the most frequent one, of equally frequent ones that with the least id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            # The last group may go on in the next batch.
            keys = held.column("key")
            last = pc.index(keys, keys[-1]).as_py()
            if last:
                yield scanned(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield scanned(held)

    found = sorted_rotations(words).mapInArrow(
        run, "id long, near long, best_n long, best_id long"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best_id"))
    return (
        found.groupBy("id")
        .agg(F.sum("near").alias("n_near"), best.alias("best"))
        .select("id", "n_near", (-F.col("best.less")).alias("best_n"), "best.best_id")
    )


def followed(links: DataFrame) -> DataFrame:
    """id and root, where its link, that one's link and so on end; for every row (id, to).

    Each round follows twice as many links as the one before.
    """
    links = committed(links.select("id", F.col("to").alias("root")))
    while True:
        further = links.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        moved = committed(
            links.join(further, "root", "left").select(
                "id",
                F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("moved"),
            )
        )
        links = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return links


def variants(counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words (word, n), each of which is there once.

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form
    is its most frequent near word (of equally frequent ones the first in code-point order), if that
    occurs `factor` times as often, else NULL; its root is where forms of forms end, or the word
    itself. NULL words and words with U+0000 must not be there. No words give no rows.
    """
    # Ids in the order of words, so that ties go by id.
    words = committed(
        committed(counts.select("word", "n"))
        .orderBy("word")
        .select(F.monotonically_increasing_id().alias("id"), "word", "n")
    )
    often = F.col("best_n") >= settings.factor * F.col("n")
    told = committed(
        words.join(neighbours(words), "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, F.col("best_id")).alias("form_id"),
            F.when(often, F.col("best_n")).alias("form_n"),
        )
    )

    def spelled(name: str, as_id: Column | str) -> DataFrame:
        return words.select(F.col("id").alias(as_id), F.col("word").alias(name))

    formed = told.where(F.col("form_id").isNotNull())
    roots = followed(formed.select("id", F.col("form_id").alias("to")))
    resolved = (
        formed.join(roots.withColumnRenamed("root", "root_id"), "id")
        .join(spelled("form", "form_id"), "form_id")
        .join(spelled("root", "root_id"), "root_id")
    )
    unlinked = told.where(F.col("form_id").isNull()).select(
        "*", F.lit(None).cast("string").alias("form"), F.col("word").alias("root")
    )
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return resolved.select(columns).unionByName(unlinked.select(columns))


def spelling_report(documents: DataFrame, settings: Settings = Settings(misspell=199)) -> DataFrame:
    """The variants of all words of the documents, a fixed share of which loses a letter first."""
    return variants(count_words(documents, settings), settings)
