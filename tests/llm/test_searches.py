"""Both vector searches against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import kdtree, onebit, vectors
from eventlake.llm.queries import ORACLE_SQL, QUERIES

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, measure, k=5, every=50):
    out = []
    for own, (one, query) in enumerate(rows):
        if one % every:
            continue
        scored = [
            (-measure(query, vector), other)
            for place, (other, vector) in enumerate(rows)
            if place != own and len(vector) == len(query)
        ]
        out += [
            (one, rank, other, -score)
            for rank, (score, other) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(out)


def product(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def random_rows(kind, size, width, seed=0):
    draw = np.random.default_rng(seed)
    vectors = draw.standard_normal((size, width))
    if kind == "clusters":
        vectors = draw.standard_normal((8, width))[draw.integers(0, 8, size)] + 0.1 * vectors
    if kind == "copies":
        vectors[draw.random(size) < 0.4] = vectors[0]
    if kind == "grid":
        vectors = np.round(vectors)
        vectors[(vectors == 0).all(axis=1)] = 1
    return list(zip(range(0, size * 5, 5), vectors.tolist(), strict=True))


@pytest.mark.parametrize("kind", ["normal", "clusters", "copies", "grid"])
@pytest.mark.parametrize(("size", "width", "shard_rows"), [(400, 6, 4096), (400, 3, 70), (150, 70, 40)])
def test_exact_search(spark, kind, size, width, shard_rows):
    rows = random_rows(kind, size, width)
    found = kdtree.top_products(
        spark.createDataFrame(rows, VECTORS), shard_rows=shard_rows, leaf_rows=8
    )
    assert sorted(map(tuple, found.collect())) == brute(rows, product)


@pytest.mark.parametrize("kind", ["normal", "clusters", "copies", "grid"])
@pytest.mark.parametrize(("size", "width", "shard_rows"), [(400, 6, 4096), (400, 64, 70), (150, 130, 40)])
def test_approximate_search(spark, kind, size, width, shard_rows):
    rows = random_rows(kind, size, width)
    found = onebit.nearest(spark.createDataFrame(rows, VECTORS), shard_rows=shard_rows).collect()
    want = brute(rows, cosine)
    assert [(r.query_id, r.rank) for r in sorted(found)] == [row[:2] for row in want]
    got = {(r.query_id, r.vec_id): r.score for r in found}
    best = {(one, other) for one, _, other, _ in want}
    # Among equal scores any choice is as near.
    least = {one: score for one, rank, _, score in want if rank == 5}
    near = sum(pair in best or got[pair] >= least[pair[0]] - 1e-12 for pair in got)
    assert near >= 0.9 * len(want)
    vectors = dict(rows)
    for (one, other), score in got.items():
        assert score == pytest.approx(cosine(vectors[one], vectors[other]), abs=1e-12)


def test_best_first_search_skips_boxes():
    draw = np.random.default_rng(1)
    vectors = np.sort(draw.standard_normal((4000, 2)), axis=0)
    tree = kdtree.Tree(np.arange(4000), np.arange(4000), vectors, leaf_rows=16)
    met = []
    tree.ranges = [tuple(r) for r in tree.ranges]

    class Counted(list):
        def __getitem__(self, node):
            met.append(node)
            return super().__getitem__(node)

    tree.ranges = Counted(tree.ranges)
    list(tree.search(np.array([-1]), vectors[:1] * 10, np.array([-np.inf]), 5))
    assert len(met) < 20


def test_ties_go_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 120)]
    docs = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = [(q, r + 1, v) for q in (0, 50, 100) for r, v in enumerate([v for v in range(7) if v != q][:5])]
    for found in (kdtree.top_products(docs, shard_rows=16), onebit.nearest(docs, shard_rows=16)):
        assert sorted(tuple(r)[:3] for r in found.collect()) == want


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [2.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]),
            (4, [0.0, 0.0]), (5, [None, 1.0]), (6, []), (None, [9.0, 9.0]), (8, [-inf, 1.0]),
            (100, [1.0]), (150, [0.0, 0.0])]
    docs = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x"))
    docs = docs.withColumns({"_shard": F.lit(1), "vector": F.lit(2), "number": F.lit(0)})
    left = [(0, [1.0, 2.0]), (50, [2.0, 2.0]), (1, [1.0, 2.0])]
    exact = [*left, (4, [0.0, 0.0]), (100, [1.0]), (150, [0.0, 0.0])]
    assert sorted(map(tuple, kdtree.top_products(docs).collect())) == brute(exact, product)
    near = sorted(map(tuple, onebit.nearest(docs).collect()))
    assert [r[:3] for r in near] == [r[:3] for r in brute(left, cosine)]
    for found in (kdtree.top_products, onebit.nearest):
        assert found(docs.where("vec_id = 77")).collect() == []
        assert found(docs.where("vec_id = 100")).collect() == []


@pytest.mark.parametrize("shard_rows", [3, 4096])
def test_every_row_of_a_repeated_id(spark, shard_rows):
    """Rows of one id are queries and candidates each, also of one another; equal rows, too."""
    rows = [(0, [1.0, 0.0]), (7, [0.5, 0.1]), (7, [2.0, 0.3]), (7, [2.0, 0.3]), (0, [1.5, 1.0]),
            (50, [1.0, 0.5]), (50, [1.0, 0.5]), (9, [-1.0, 3.0])]
    docs = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = sorted(map(tuple, kdtree.top_products(docs, k=3, shard_rows=shard_rows).collect()))
    assert found == brute(rows, product, k=3)
    assert (0, 1, 7, 131072) in found and len(found) == 12
    near = sorted(tuple(r)[:3] for r in onebit.nearest(docs, k=9, shard_rows=shard_rows).collect())
    assert near == [r[:3] for r in brute(rows, cosine, k=9)]
    con = duckdb.connect()
    con.sql("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    wanted = con.sql(ORACLE_SQL["op2_top_products"]).fetchall()
    assert sorted(wanted) == sorted(map(tuple, kdtree.top_products(docs, shard_rows=shard_rows).collect()))


def test_recall_over_many_shards(spark):
    rows = [(i, v) for i, (_, v) in enumerate(random_rows("normal", 3000, 48, seed=4))]
    want = {(one, other) for one, _, other, _ in brute(rows, cosine)}
    docs = spark.createDataFrame(rows, VECTORS)
    found = {(r.query_id, r.vec_id) for r in onebit.nearest(docs, shard_rows=400).collect()}
    assert len(found & want) >= 0.9 * len(want)


def test_extreme_components(spark):
    rows = [(0, [1e300, -1e300]), (50, [1e300, 1e300]), (1, [1e-300, 2e-300]), (2, [1e10, 3e9]),
            (3, [-5e9, 1.5]), (100, [3.25, -1.5])]
    docs = spark.createDataFrame(rows, VECTORS)
    low, high = -(1 << 63), (1 << 63) - 1
    want = brute(rows, lambda a, b: min(max(product(a, b), low), high))
    assert sorted(map(tuple, kdtree.top_products(docs).collect())) == want
    near = onebit.nearest(docs).collect()
    assert len(near) == 15 and all(abs(r.score) <= 1 + 1e-9 for r in near)


def test_queries(spark, tables):
    rows = [
        (r.vec_id, r.embedding)
        for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()
    ]
    got = sorted(map(tuple, QUERIES["op2_top_products"](spark, tables).collect()))
    assert got == brute(rows, product)
    want = brute(rows, cosine)
    found = sorted(map(tuple, QUERIES["op10_nearest"](spark, tables).collect()))
    assert len(found) == len(want)
    both = {(r[0], r[2]) for r in found} & {(r[0], r[2]) for r in want}
    assert len(both) >= 0.9 * len(want)


def clustered(size, width, groups, seed=5):
    draw = np.random.default_rng(seed)
    centers = draw.standard_normal((groups, width)) * 4
    vectors = centers[draw.integers(0, groups, size)] + 0.02 * draw.standard_normal((size, width))
    return list(enumerate(vectors.tolist()))


@pytest.mark.parametrize("search", ["exact", "codes"])
def test_queries_go_to_the_shards_that_they_need(spark, search, monkeypatch):
    """On clustered vectors far fewer blocks of queries travel than queries times shards."""
    monkeypatch.setattr(vectors, "SPREAD", 10**9)
    rows = clustered(3000, 8, 30)
    docs = spark.createDataFrame(rows, VECTORS).repartition(4)
    space = kdtree.whole_numbers if search == "exact" else onebit.unit
    blocks, plain = [], vectors.sent

    def counting(asking, targets):
        found = plain(asking, targets)
        blocks.append(found)
        return found

    monkeypatch.setattr(vectors, "sent", counting)
    if search == "exact":
        found = sorted(map(tuple, kdtree.top_products(docs, shard_rows=100).collect()))
        assert found == brute(rows, product)
    else:
        found = {(r.query_id, r.vec_id) for r in onebit.nearest(docs, shard_rows=100).collect()}
        want = {(one, other) for one, _, other, _ in brute(rows, cosine)}
        assert len(found & want) >= 0.9 * len(want)
    home, elsewhere = blocks
    asked = elsewhere.select((F.octet_length("numbers") / 8).alias("n"))
    queries, shards = 60, 30
    assert home.agg(F.sum(F.octet_length("numbers") / 8)).first()[0] == queries
    moved = asked.agg(F.count("n"), F.sum("n")).first()
    assert moved[1] < queries * shards / 2 and moved[0] < moved[1]
    assert space(np.ones((1, 2))).shape == (1, 2)


def test_shards_of_equal_vectors_are_cut(spark):
    rows = [(i, [1.0, 2.0]) for i in range(600)] + [(1000 + i, [float(i), -1.0]) for i in range(300)]
    docs = spark.createDataFrame(rows, VECTORS)
    numbered = vectors.taking_part(docs, "vec_id", "embedding", True).withColumns(
        {"number": F.col("vec_id"), "_width": F.size("vector")}
    )
    large = vectors.large_widths(numbered, 50)
    assert large == {2: 900}
    placed = vectors.placed_in_shards(numbered, large, 50, kdtree.whole_numbers)
    sizes = [r["count"] for r in placed.groupBy("_leaf", "_part").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 150
    found = sorted(map(tuple, kdtree.top_products(docs, shard_rows=50).collect()))
    assert found == brute(rows, product)


def test_median_splits():
    draw = np.random.default_rng(0)
    rows = draw.standard_normal((5000, 3))
    leaves = vectors.Splits.learn(rows, 16).leaf_of(rows)
    assert np.bincount(leaves).min() > 250 and len(np.bincount(leaves)) == 16
    same = np.ones((100, 2))
    assert set(vectors.Splits.learn(same, 8).leaf_of(same).tolist()) == {0}
    assert set(vectors.Splits.learn(np.zeros((0, 2)), 4).leaf_of(same).tolist()) == {0}


def test_shards_grow_with_the_table():
    assert vectors.rows_of_a_shard(10_000, 4096) == 4096
    assert vectors.rows_of_a_shard(10_000_000, 4096) == 39_063
    assert vectors.rows_of_a_shard(100_000_000, 4096) == 65_536
    assert -(-10**10 // vectors.rows_of_a_shard(10**10, 4096)) <= vectors.MOST_SHARDS
