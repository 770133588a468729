"""What the operators share inside tasks: Arrow columns as NumPy arrays."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def worker_cache(name: str) -> dict:
    """A dict that lives as long as this Python worker, so that tasks can share what is costly."""
    holder = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker"))
    return holder.__dict__.setdefault(name, {})


def release_memory() -> None:
    """Give what was freed back to the system, which Arrow and the C library else keep."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


#: Bytes of batches after which a task gives freed memory back.
RELEASED = 1 << 22


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run`, for `mapInArrow`, with freed memory given back on its way and when it is done.

    A worker outlives its tasks, so what it keeps would add up with what the next step takes.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            yield batch
            held += batch.nbytes
            if held >= RELEASED:
                release_memory()
                held = 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(released(batches))
        release_memory()

    return task


def text_array(column: pa.Array) -> pa.Array:
    """The column as one string array with 32-bit offsets, NULL as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a `text_array` as one array, and the offset of each text (and the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes of text each, or of one row."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > start and held + length > most:
            yield start, row
            start, held = row, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths)


def blocks_of(
    flat: np.ndarray, most: int, cuts: Callable[[np.ndarray], np.ndarray]
) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` bytes of one text, each ending where `cuts` allows, or with the text.

    `cuts` tells of each byte whether a range may begin with it.
    """
    start = 0
    while start < len(flat):
        end = start + most
        while end < len(flat):
            window = np.flatnonzero(cuts(flat[end : end + 4096]))
            if len(window):
                end += int(window[0])
                break
            end += 4096
        end = min(end, len(flat))
        yield start, end
        start = end


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of a `text_array`.

    Returns the distinct words, the index of each word in them, and the offset of each text's
    first word (and the end).
    """
    parts = pc.ascii_split_whitespace(column)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    # A text that starts or ends in white space has an empty part there.
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    offsets = offsets - offsets[0]
    if empty >= 0:
        real = index != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        index = index[real]
    return coded.dictionary, index, offsets


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1 … of every run, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    size = int(ends[-1]) if len(ends) else 0
    small = size < 1 << 31 and int(starts.max(initial=0)) + size < 1 << 31
    kind = np.int32 if small else np.int64
    positions = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    positions += np.arange(size, dtype=kind)
    return positions


def ragged_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between each two offsets; 0 where there are none."""
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def add_columns(
    rows: DataFrame,
    fields: str,
    make: Callable[[pa.Array], list[pa.Array]],
    text: str,
    most: int = 1 << 19,
) -> DataFrame:
    """`rows` and the columns that `make` gives for their texts; columns of the same names go.

    `make` gets at most `most` bytes of text at a time, or one row, and its results go on at once,
    so a worker's memory does not grow with Spark's batches.
    """
    new = T.StructType.fromDDL(fields)
    taken = {field.name.lower() for field in new}
    kept = [name for name in rows.columns if name.lower() not in taken]
    source = F.col(text) if text in kept else F.col(text).alias("_text")
    asked = rows if text in kept else rows.select(*kept, source)
    read_as = text if text in kept else "_text"
    names = [field.name for field in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = text_array(batch.column(read_as))
            for start, end in slices(whole, most):
                part = batch.slice(start, end - start)
                made = make(whole.slice(start, end - start))
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in kept] + made, kept + names
                )

    schema = T.StructType([field for field in rows.schema if field.name in kept] + new.fields)
    return asked.select(*dict.fromkeys([*kept, read_as])).mapInArrow(lean(run), schema)


class Memo:
    """Token ids of pieces of text, kept until there are too many of them.

    `encode` gives the ids of a list of new pieces, one after the other, and how many each has.
    """

    def __init__(self, encode, most: int = 200_000):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def find(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in `flat` of each of these distinct pieces."""
        new = [piece for piece in pieces if piece not in self.place]
        if self.place and (
            len(self.place) + len(new) > self.most or len(self.flat) > 16 * self.most
        ):
            self.forget()
            new = pieces
        if new:
            ids, lengths = self.encode(new)
            first = len(self.place)
            self.place.update(zip(new, range(first, first + len(new)), strict=True))
            starts = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
            self.starts = np.concatenate((self.starts, starts))
            self.lengths = np.concatenate((self.lengths, lengths))
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        return self.starts[at], self.lengths[at]
