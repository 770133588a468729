"""The Iceberg bucket transform as a column function.

The public Iceberg table spec buckets a string by 32-bit Murmur3 (x86 variant, seed 0) of its
UTF-8 bytes. Spark's own `hash` uses another seed and another tail, so it cannot stand in.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's functions inside the UDF, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def murmur3(values: pa.Array) -> np.ndarray:
    """32-bit Murmur3 (x86, seed 0) of each string; the slots of NULLs hold any number.

    All strings of the batch advance together, four bytes per step.
    """
    count = len(values)
    if count == 0:
        return np.empty(0, np.uint32)
    packed = values.cast(pa.large_binary())
    _, offset_buffer, byte_buffer = packed.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[packed.offset : packed.offset + count + 1]
    raw = np.frombuffer(byte_buffer, np.uint8) if byte_buffer else np.empty(0, np.uint8)
    # `words[i]` is the little-endian word at byte i; the padding keeps the last tails readable.
    padded = np.concatenate([raw[: offsets[-1]], np.zeros(4, np.uint8)])
    words = np.ndarray(len(padded) - 3, "<u4", padded, strides=(1,))

    def rotate(x, bits):
        return (x << np.uint32(bits)) | (x >> np.uint32(32 - bits))

    def scramble(word):
        return rotate(word * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    starts, lengths = offsets[:-1], np.diff(offsets)
    hashes = np.zeros(count, np.uint32)
    at, step = np.flatnonzero(lengths >= 4), 0
    while len(at):
        mixed = hashes[at] ^ scramble(words[starts[at] + 4 * step])
        hashes[at] = rotate(mixed, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        step += 1
        at = at[lengths[at] >= 4 * (step + 1)]

    rest = lengths % 4
    tails = words[np.minimum(offsets[1:] - rest, len(words) - 1)]
    tails = tails & ((np.uint32(1) << (8 * rest).astype(np.uint32)) - np.uint32(1))
    hashes ^= np.where(rest > 0, scramble(tails), np.uint32(0))

    hashes ^= lengths.astype(np.uint32)
    hashes = (hashes ^ (hashes >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    hashes = (hashes ^ (hashes >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return hashes ^ (hashes >> np.uint32(16))


def bucket_ids(buckets: int, values: pa.Array) -> pa.Array:
    """Bucket number of each string, NULL for NULL; equal strings are hashed once."""
    coded = values.dictionary_encode()
    numbers = (murmur3(coded.dictionary) & np.uint32(0x7FFFFFFF)) % np.uint32(buckets)
    return pa.array(numbers.astype(np.int32)).take(coded.indices)


def iceberg_bucket(buckets: int, text: Column | str) -> Column:
    """`bucket(buckets, text)` as Iceberg defines it for strings."""

    @F.arrow_udf("int")
    def bucket(values: pa.Array) -> pa.Array:
        return bucket_ids(buckets, values)

    return bucket(text)


def bucket_of(buckets: int, text: str | None) -> int | None:
    """The same for one constant, on the driver; used to prune a read."""
    return bucket_ids(buckets, pa.array([text], pa.string()))[0].as_py()
