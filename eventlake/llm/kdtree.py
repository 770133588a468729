"""Exact top-k search by integer inner product with a KD-tree per shard.

Each shard's tree splits its vectors at the median of the component that spreads most, and every
node keeps the tight bounding box of its vectors. The largest inner product that a box allows is
reached, component by component, at one of its sides; nodes are visited best first by that bound and
not at all once it is below the k-th score so far, which starts with what the query found before.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from eventlake.llm.vectors import best_k, taking_part

LEAF_ROWS = 64
SHARD_ROWS = 4096
LONG = np.iinfo(np.int64)  # range of a score


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of every component: as doubles if all products are exact so, else as ints."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * 256.0)
        largest = np.abs(scaled).max(initial=0) ** 2 * vectors.shape[1]
    if largest < 2.0**52:
        return scaled
    # Components this large have no fraction.
    exact = [
        int(x) * 256 if abs(x) > 2.0**60 else int(np.floor(x * 256)) for x in vectors.ravel()
    ]
    return np.array(exact, object).reshape(vectors.shape)


def in_range(scores: np.ndarray) -> np.ndarray:
    """Scores beyond the range of a long count as its end. Doubles here are far inside it."""
    return scores if scores.dtype != object else np.clip(scores, LONG.min, LONG.max)


class Tree:
    def __init__(
        self,
        ids: np.ndarray,
        numbers: np.ndarray,
        vectors: np.ndarray,
        leaf_rows: int = LEAF_ROWS,
    ):
        order = np.arange(len(ids))
        self.vectors = whole_numbers(vectors)
        lows, highs = [], []
        self.children: list[tuple[int, int] | None] = []
        self.ranges: list[tuple[int, int]] = []
        work = [(0, len(ids), -1, 0)]
        while work:
            start, end, parent, side = work.pop()
            node = len(self.children)
            if parent >= 0:
                pair = self.children[parent]
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            rows = self.vectors[order[start:end]]
            low, high = rows.min(axis=0), rows.max(axis=0)
            lows.append(low)
            highs.append(high)
            self.ranges.append((start, end))
            self.children.append(None)
            if end - start > leaf_rows:
                spread = int(np.argmax(high - low))
                middle = (end - start) // 2
                split = np.argsort(rows[:, spread], kind="stable")
                order[start:end] = order[start:end][split]
                self.children[node] = (-1, -1)
                work.append((start + middle, end, node, 1))
                work.append((start, start + middle, node, 0))
        self.lows, self.highs = np.array(lows), np.array(highs)
        self.ids, self.numbers, self.vectors = ids[order], numbers[order], self.vectors[order]
        self.least_id = [int(self.ids[start:end].min()) for start, end in self.ranges]

    def search(
        self, numbers: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
    ) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        asked = whole_numbers(queries)
        if asked.dtype != self.vectors.dtype or asked.dtype == object:
            asked = asked.astype(object)
        elif (
            np.abs(asked).max(initial=0) * np.abs(self.vectors).max(initial=0) * asked.shape[1]
            >= 2.0**52
        ):
            asked = np.vectorize(int, otypes=[object])(asked)
        bounds = np.maximum(asked, 0) @ self.highs.T + np.minimum(asked, 0) @ self.lows.T
        bounds = in_range(bounds)
        # A score that is no double was rounded on its way here.
        least = np.where(np.abs(least) < 2.0**53, least, np.nextafter(least, -np.inf)).tolist()
        for place, query in enumerate(asked):
            yield place, self.best(int(numbers[place]), query, bounds[place], least[place], k)

    def best(self, own: int, query, bounds, least: float, k: int) -> list[tuple[int, int]]:
        """The k best by score, then by smaller id; `kept` is a heap whose first is the worst."""
        kept: list[tuple[int, int]] = []  # score, minus id
        work = [(-bounds[0], 0)]
        while work:
            bound, node = heapq.heappop(work)
            bound = -bound
            if bound < least or len(kept) == k and bound < kept[0][0]:
                break
            if len(kept) == k and (bound, -self.least_id[node]) <= kept[0]:
                continue
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(work, (-bounds[child], child))
                continue
            start, end = self.ranges[node]
            scores = in_range(self.vectors[start:end] @ query)
            floor = max(least, kept[0][0]) if len(kept) == k else least
            for row in np.flatnonzero(scores >= floor).tolist():
                if self.numbers[start + row] == own:
                    continue
                entry = (int(scores[row]), -int(self.ids[start + row]))
                if len(kept) < k:
                    heapq.heappush(kept, entry)
                elif entry > kept[0]:
                    heapq.heapreplace(kept, entry)
        return [(-name, score) for score, name in sorted(kept, reverse=True)]


def top_products(
    table: DataFrame,
    k: int = 5,
    every: int = 50,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of floor(256 x) per query.

    Queries are the rows whose id `every` divides, candidates all others of the same width. See
    `taking_part` for rows that take no part, `best_k` for ties and empty tables.
    """
    rows = taking_part(table, vec_id, vector, zero=True)
    tree = partial(Tree, leaf_rows=leaf_rows)
    return best_k(rows, k, every, shard_rows, tree, "long", whole_numbers)
