"""Approximate nearest neighbours by cosine from randomly rotated one-bit codes.

All unit vectors are turned by one random rotation. A vector's code keeps the sign of each component,
packed 64 to a word, and one correction: the inner product of the turned vector with its sign vector.
A query's inner product with all sign vectors comes from population counts of the packed words and
the bit planes of the query, quantised to eight bits; divided by the correction it estimates the
cosine. The estimate's error is below a known bound with high probability (`SIGMAS` standard
deviations, and what quantising the query adds for certain). Vectors whose estimate plus bound does
not reach the k-th best cosine known so far are skipped, the others are reranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from eventlake.llm.vectors import best_k, taking_part

SHARD_ROWS = 4096
#: Standard deviations that the error bound covers.
SIGMAS = 3.0
PLANES = 8
SEED = 29


def rotation(width: int) -> np.ndarray:
    """The same random rotation in every task."""
    draw = np.random.default_rng([SEED, width])
    turned, triangle = np.linalg.qr(draw.standard_normal((width, width)))
    return turned * np.sign(np.diag(triangle))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that keep their squares in range; no cosine changes."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / norms(vectors)[:, None]


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits packed into rows of 64-bit words."""
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Codes:
    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: np.ndarray):
        self.ids, self.numbers, self.vectors = ids, numbers, scaled(vectors)
        self.norms = norms(self.vectors)
        self.width = vectors.shape[1]
        self.rotation = rotation(self.width)
        turned = self.vectors @ self.rotation / self.norms[:, None]
        self.codes = words(turned > 0)
        self.ones = np.bitwise_count(self.codes).sum(axis=1).astype(np.int64)
        self.correction = np.abs(turned).sum(axis=1) / np.sqrt(self.width)
        spread = np.sqrt(np.maximum(0, 1 - self.correction**2)) / self.correction
        self.error = SIGMAS * spread / np.sqrt(max(1, self.width - 1))

    def estimates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosine of each unit query with each vector, and its error bound."""
        turned = queries @ self.rotation
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-300)
        levels = np.rint((turned - low) / step).astype(np.uint8)
        off = np.sqrt(((turned - low - levels * step) ** 2).sum(axis=1, keepdims=True))
        counted = np.zeros((len(queries), len(self.ids)), np.int64)
        for plane in range(PLANES):
            bits = words(levels >> plane & 1 != 0)
            for word in range(self.codes.shape[1]):
                met = np.bitwise_count(bits[:, word, None] & self.codes[None, :, word])
                counted += met.astype(np.int64) << plane
        # The sign vector is twice the bits less one, over the root of the width.
        total = levels.sum(axis=1, dtype=np.int64)[:, None]
        product = step * (2 * counted - total) + low * (2 * self.ones - self.width)
        product /= np.sqrt(self.width)
        return product / self.correction, self.error + off / self.correction

    def cosines(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact cosines, each row summed the same way, so equal vectors score alike."""
        length = np.sqrt((query * query).sum())
        return (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * length)

    def search(
        self, numbers: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
    ) -> Iterator[tuple[int, list[tuple[int, float]]]]:
        queries = scaled(queries)
        for start in range(0, len(numbers), 32):
            some = queries[start : start + 32]
            estimate, error = self.estimates(some / norms(some)[:, None])
            for place, query in enumerate(some):
                yield (
                    start + place,
                    self.best(
                        numbers[start + place], query, estimate[place], error[place],
                        least[start + place], k,
                    ),
                )

    def best(self, own, query, estimate, error, least: float, k: int) -> list[tuple[int, float]]:
        other = self.numbers != own
        reach = np.where(other, estimate + error, -np.inf)
        # The likeliest rows first: their k-th cosine is one to beat.
        first = np.argsort(-np.where(other, estimate, -np.inf), kind="stable")[: 4 * k]
        first = first[other[first]]
        known = self.cosines(query, first)
        if len(known) >= k:
            least = max(least, np.partition(known, -k)[-k])
        rows = np.union1d(np.flatnonzero((reach >= least) & other), first)
        score = self.cosines(query, rows)
        rows, score = rows[score >= least], score[score >= least]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(self.ids[rows[i]]), float(score[i])) for i in order]


def nearest(
    table: DataFrame,
    k: int = 5,
    every: int = 50,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest cosines found per query, exactly computed.

    Queries are the rows whose id `every` divides, candidates all others of the same width. Zero
    vectors take no part; see `taking_part` for other rows that do not, `best_k` for ties and empty
    tables.
    """
    rows = taking_part(table, vec_id, vector, zero=False)
    return best_k(rows, k, every, shard_rows, Codes, "double", unit)
