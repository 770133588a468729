"""Exact shard sizes, and the laws of the draws."""

import zlib
from collections import Counter
from math import comb, sqrt

import pytest
from pyspark.sql import functions as F

from eventlake.llm import sharding
from eventlake.llm.queries import QUERIES


def slots_are_gapless(rows):
    by_shard = {}
    for row in rows:
        by_shard.setdefault(row["shard"], []).append(row["slot"])
    return all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


@pytest.mark.parametrize("size", [0, 1, 3, 40, 41, 999])
@pytest.mark.parametrize("block_rows", [7, 20_000])
def test_sizes(spark, size, block_rows):
    rows = spark.range(size).repartition(5)
    got = sharding.shuffle_into_shards(rows, 40, block_rows=block_rows).collect()
    assert sorted(row["id"] for row in got) == list(range(size))
    counts = Counter(row["shard"] for row in got)
    assert all(size // 40 <= counts[shard] <= -(-size // 40) for shard in range(40))
    assert slots_are_gapless(got)


@pytest.mark.parametrize(("total", "marked", "drawn"), [(50, 20, 12), (9, 9, 4), (30, 1, 29), (7, 0, 3)])
def test_draws_follow_the_law(spark, total, marked, drawn):
    tries = 20_000
    column = sharding.hypergeometric(
        F.lit(total), F.lit(marked), F.lit(drawn), sharding.uniform(F.lit(3), F.col("id"))
    )
    found = dict(spark.range(tries).groupBy(column.alias("k")).count().collect())
    for k in range(min(marked, drawn) + 1):
        if drawn - k > total - marked:
            assert k not in found
            continue
        chance = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
        spread = sqrt(tries * chance * (1 - chance))
        assert abs(found.get(k, 0) - tries * chance) <= 5 * spread + 1


def test_large_draws(spark):
    column = sharding.hypergeometric(
        F.lit(10**7), F.lit(10**7 // 40), F.lit(10**7 // 2), sharding.uniform(F.col("id"))
    )
    row = spark.range(1000).agg(F.mean(column), F.stddev(column)).first()
    spread = sqrt(10**7 / 2 / 40 * (39 / 40) / 2)
    assert abs(row[0] - 10**7 / 80) < 5 * spread / sqrt(1000)
    assert abs(row[1] / spread - 1) < 0.12


def test_matrix_has_both_margins(spark):
    sizes = spark.createDataFrame([(i, 13 * i % 50) for i in range(23)], "part int, n long")
    rows = sharding.communication_matrix(sizes, 7, seed=1).collect()
    total = sum(13 * i % 50 for i in range(23))
    assert {r["part"]: sum(r["counts"]) for r in rows} == {i: 13 * i % 50 for i in range(23)}
    columns = [sum(column) for column in zip(*(r["counts"] for r in rows), strict=True)]
    assert columns == [total // 7 + (i < total % 7) for i in range(7)]


def test_the_matrix_is_drawn_by_many_tasks(spark):
    """Ranges are dealt out every few levels; lost or repeated draws come out the same."""
    sizes = spark.createDataFrame([(i, 50 + 13 * i % 50) for i in range(1000)], "part int, n long")
    matrix = sharding.communication_matrix(sizes, 3, seed=1)
    drawn = matrix.withColumn("task", F.spark_partition_id())
    tasks = [r["count"] for r in drawn.groupBy("task").count().collect()]
    assert len(tasks) == 256 and max(tasks) <= 2 * sorted(tasks)[len(tasks) // 2]
    rows = {r["part"]: r["counts"] for r in matrix.collect()}
    assert rows == {r["part"]: r["counts"] for r in matrix.collect()}
    assert all(sum(rows[i]) == 50 + 13 * i % 50 for i in range(1000))
    total = sum(map(sum, rows.values()))
    assert [sum(c) for c in zip(*rows.values(), strict=True)] == [total // 3 + (i < total % 3) for i in range(3)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_sizes_with_and_without_a_broadcast(spark, monkeypatch, broadcast):
    monkeypatch.setattr(sharding, "BROADCAST_BYTES", 1 << 20 if broadcast else 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = sharding.shuffle_into_shards(spark.range(500).repartition(20), 7, block_rows=20).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(row["id"] for row in got) == list(range(500)) and slots_are_gapless(got)


def test_every_slot_is_equally_likely(spark):
    """Rows of each partition fall to each shard and half of it alike."""
    rows = spark.range(3000).repartition(3).withColumn("part", F.spark_partition_id())
    seen = Counter()
    for seed in range(3):
        for row in sharding.shuffle_into_shards(rows, 3, seed=seed, block_rows=300).collect():
            seen[row["part"], row["shard"], row["slot"] // 500] += 1
    # 9000 rows are dealt to 18 cells.
    assert len(seen) == 18
    assert all(abs(count - 500) < 100 for count in seen.values())


def test_rows_stay_as_they_are(documents):
    rows = [(1, None), (1, None), (None, ""), (2, "a" * 100_000), (3, "b")]
    docs = documents(rows).withColumn("Shard", F.lit("x")).withColumn("_row", F.lit(1))
    docs = docs.withColumn("part", F.lit(2))
    out = sharding.shuffle_into_shards(docs, 2)
    assert out.columns == [*docs.drop("Shard").columns, "shard", "slot"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(rows)


def test_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_shards"](spark, tables).collect()
    want = {r.doc_id: (len(r.text.encode()) + 16, zlib.crc32(r.text.encode())) for r in rows}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want
    counts = Counter(r["shard"] for r in got)
    assert len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1
    assert slots_are_gapless(got)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
